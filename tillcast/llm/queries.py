"""Queries that apply the corpus operators to the driver tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm import bpe, collocations, divergence, html_text, langid, linedup, mixing, packing, quality_pu, quality_rules, sharding, simhash, topk
from tillcast.llm.common import held_out, read_table, word_count
from tillcast.llm.oracle import ORACLES

#: Documents in one Arrow batch; bounds a Python worker's memory where texts are long.
BATCH_ROWS = "512"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = read_table(spark, sf_dir, "documents")
    model = quality_pu.learn(docs, read_table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), quality_pu.score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality_pu.CUT).cast("int"))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, sf_dir, "embeddings")
    vectors = table.select("vec_id", topk.integer_vector(F.col("embedding")).alias("v"))
    return topk.top_k(vectors, F.col("vec_id") % 20 == 0, 20)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    found = packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), 4096)
    return found.select(*packing.DIGEST)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = read_table(spark, sf_dir, "documents")
    model = langid.learn(docs, tokenizer_path("piece_bpe_32k.model"))
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), langid.predict(model, F.col("text")).alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")


def op5_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of 20 or more characters with the first occurrence of its class (lines joined by chains of one edit)."""
    found = linedup.line_classes(read_table(spark, sf_dir, "documents"))
    class_doc, class_line = linedup.occurrence(F.col("class_place"))
    return found.select(
        "doc_id", F.col("line_no").cast("long").alias("line_no"), class_doc.alias("class_doc_id"),
        class_line.cast("long").alias("class_line_no"), "kept",
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of at most 1 MiB, all columns counted."""
    found = sharding.write_shards(read_table(spark, sf_dir, "documents"), limit=1 << 20)
    return found.select("doc_id", "bytes", "shard", "part", "shard_bytes", "shard_rows")


def op7_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read_table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    queued = mixing.queue(read_table(spark, sf_dir, "documents"), word_count(F.col("text")))
    return queued.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    found = simhash.components(read_table(spark, sf_dir, "documents"), shingle=3, max_distance=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    pages = read_table(spark, sf_dir, "pages")
    found = pages.select("page_id", "url", html_text.extract(F.col("html")).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    found = collocations.collocations(read_table(spark, sf_dir, "documents"), min_count=100, longest=5)
    return collocations.best(found, 2000).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    path = tokenizer_path("byte_bpe_50k.json")
    found = bpe.encode(read_table(spark, sf_dir, "documents"), path)
    decoded = F.sha2(bpe.decode(F.col("ids"), path).cast("binary"), 256)
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), decoded.alias("decoded_sha256"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return divergence.audit(read_table(spark, sf_dir, "documents"), min_docs=3, top_terms=200)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir).select(*packing.DIGEST)


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality, op2_topk, op3_packing, op4_language, op5_linededup, op6_sharding, op7_rules, op8_mixing, op9_simhash,
        op10_html, op11_collocations, op12_bpe, op13_divergence, pipeline,
    )
}


def queries():
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
