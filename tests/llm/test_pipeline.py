"""The five stages against their operators, and the registration of the queries."""

from collections import Counter

from tillcast.llm import linedup, mixing, quality_pu, simhash
from tillcast.llm.common import read_table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    import corpus_pipeline as p

    docs = read_table(spark, SF, "documents")
    columns = docs.dtypes
    names = [n for n, _ in p.STAGES]
    assert names == ["quality", "line_dedup", "near_dedup", "mix", "pack"]
    seen = []
    for name, stage in p.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF).cache()
        assert docs.dtypes == columns
        seen.append((before, docs))
    rows = lambda df: Counter(map(tuple, df.collect()))
    labels = read_table(spark, SF, "labels")
    assert rows(seen[0][1]) == rows(quality_pu.keep_good(seen[0][0], labels)) and seen[0][1].count() < seen[0][0].count()
    assert rows(seen[1][1]) == rows(linedup.dedupe(seen[1][0])) and seen[1][1].count() == seen[1][0].count()
    assert rows(seen[2][1]) == rows(simhash.dedupe(seen[2][0]))
    assert rows(seen[3][1]) == rows(mixing.mix(seen[3][0]))
    packed = p.STAGES[-1][1](spark, docs, SF).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(r.doc_id for r in docs.collect())


def test_pipeline_query(spark):
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n[2].isdigit()) == list(range(1, 14))
    out = entry.queries()["pipeline"](spark, SF)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0
