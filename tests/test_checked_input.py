import tempfile

import pytest
from pyspark.sql import functions as F

from tillcast.operators import quality
from tillcast.sources import files


def _csv(text):
    path = tempfile.mkdtemp(prefix="tillcast-csv-") + "/h.csv"
    with open(path, "w") as out:
        out.write(text)
    return path


def test_bad_lines_are_listed_and_good_ones_kept(spark):
    path = _csv("date,total_revenue,store_id\n2021-01-01,5.5,a\nsoon,7,a\n2021-01-02,many,b\n2021-02-30,,b\n"
                "2021-01-03,8\n2021-01-04,9,c,x\n\n 2021-01-05 , 1e2 ,\n2021-01-06,NaN,c\n")
    got = [(str(r.date), r.store_id, r.total_revenue, r.failed, r.record) for r in files.read_history_checked(spark, path).collect()]
    assert got == [
        ("2021-01-01", "a", 5.5, [], None), ("None", "a", 7.0, ["date"], "soon,7,a"),
        ("2021-01-02", "b", None, ["total_revenue"], "2021-01-02,many,b"), ("None", "b", None, ["date", "total_revenue"], got[3][4]),
        ("2021-01-03", None, 8.0, ["line"], "2021-01-03,8"), ("2021-01-04", "c", 9.0, ["line"], "2021-01-04,9,c,x"),
        ("2021-01-05", None, 100.0, [], None), ("2021-01-06", "c", None, ["total_revenue"], "2021-01-06,NaN,c")]


def test_checked_history_edges(spark):
    assert files.read_history_checked(spark, _csv("date,total_revenue\n")).count() == 0
    assert files.read_history_checked(spark, _csv("total_revenue,date\n1,2021-01-01\n")).first().store_id == "store_001"
    with pytest.raises(ValueError):
        files.read_history_checked(spark, _csv("day,total_revenue\n2021-01-01,1\n"))


def test_repeated_rows_equal_a_grouping(spark):
    nan = float("nan")
    rows = [(None, 1.0, "a")] * 3 + [(1, None, "a")] * 2 + [(1, 0.0, ""), (1, -0.0, ""), (1, nan, None), (1, nan, None), (2, 1.0, "b")]
    df = spark.createDataFrame(rows, "i int, x double, `s.t` string")
    assert quality.repeated_rows(df).first()[0] == quality.duplicate_rows(df).first()[0] == 5
    clash = df.withColumnRenamed("i", "count")
    assert quality.repeated_rows(clash).first()[0] == quality.duplicate_rows(clash).first()[0] == 5
    assert quality.repeated_rows(df.where("false")).first()[0] == 0


def test_colliding_fingerprints_are_told_apart(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, "c")], "k int, s string")
    monkeypatch.setattr(quality.F, "xxhash64", lambda *cols: F.lit(7).cast("long"))  # all rows collide
    assert quality.repeated_rows(df).first()[0] == 1
