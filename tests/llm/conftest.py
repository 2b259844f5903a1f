import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, size int, key string, count long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents table from ``(doc_id, text, lang, source)`` rows, with further columns whose names clash."""

    def make(rows):
        full = [(i, t, lang, s, None if t is None else len(t), "x", 1, "k", 5) for i, t, lang, s in rows]
        return spark.createDataFrame(full, DOC_SCHEMA)

    return make


@pytest.fixture(scope="session")
def read_rows(spark):
    def read(name, scale="sf0.001"):
        return [r.asDict() for r in spark.read.parquet(f"/root/testdata/{scale}/{name}.parquet").collect()]

    return read
