import datetime as dt
import math
import tempfile

import pytest
from pyspark.sql import functions as F

from tillcast.operators import profiles as P, quality
from tillcast.operators.ordered import ks_statistic
from tillcast.sources import quarantine, tables as T

SMALL = "/root/testdata/sf0.001"
DAY = dt.date(2021, 1, 1)


def _kept(df, day="day"):
    root = tempfile.mkdtemp(prefix="tillcast-profiles-") + "/p"
    P.store_profiles(P.day_profiles(df, day), root)
    return root


def test_merged_days_equal_the_whole_profile(spark):
    sales = T.sales(spark, SMALL).select("date", "store_id", "quantity_sold", "revenue")
    got = {r.column: r for r in P.merged(P.day_profiles(sales, "date")).collect()}
    want = {(r.column, r.metric): r.value for r in quality.column_profile(sales).collect()}
    for c in ("quantity_sold", "revenue"):
        assert math.isclose(got[c]["mean"], want[c, "mean"]) and math.isclose(got[c]["std"], want[c, "std"])
        assert (got[c].lo, got[c].hi) == (want[c, "min"], want[c, "max"])
    assert all(r.rows == sales.count() and r.nulls == want[c, "null_count"] for c, r in got.items())
    counts = {r.column: r.d for r in P.merged(P.day_profiles(sales, "date")).select(
        "column", P.distinct_count().alias("d")).collect()}
    assert all(abs(d - want[c, "unique_values"]) <= P.DISTINCT_ERROR * want[c, "unique_values"] + 1 for c, d in counts.items())


def test_sketches_stay_within_their_errors(spark):
    """200,000 distinct values over 40 days, one of which holds a third of the rows."""
    i = F.col("id")
    df = spark.range(200_000).select(F.when(i % 3 == 0, 0).otherwise(i % 40).alias("day"), (F.xxhash64("id") % 10**9).alias("v"))
    row = P.merged(P.day_profiles(df, "day", ["v"])).select(P.distinct_count().alias("d"), P.quantiles([0.01, 0.5, 0.99]).alias("q")).first()
    exact = df.select("v").distinct().count()
    assert abs(row.d - exact) <= P.DISTINCT_ERROR * exact
    for p, q in zip((0.01, 0.5, 0.99), row.q):
        assert abs(df.where(F.col("v") <= q).count() / 200_000 - p) <= P.RANK_ERROR


def test_a_new_day_leaves_the_others_and_a_repeated_one_is_replaced(spark):
    first = spark.createDataFrame([(DAY, 1.0), (DAY, 3.0)], "day date, x double")
    root = _kept(first)
    before = {f for f in spark.read.parquet(root).inputFiles()}
    later = spark.createDataFrame([(DAY + dt.timedelta(1), 5.0)], "day date, x double")
    P.store_profiles(P.day_profiles(later, "day"), root)
    assert before <= set(spark.read.parquet(root).inputFiles())  # not written anew
    P.store_profiles(P.day_profiles(later.withColumn("x", F.lit(8.0)), "day"), root)
    row = P.merged(spark.read.parquet(root)).where("column = 'x'").first()
    assert (row.rows, row["mean"], row.hi) == (3, 4.0, 8.0) and math.isclose(row["std"], 13.0 ** 0.5)


def test_profiles_of_nulls_nan_text_and_nothing(spark):
    df = spark.createDataFrame(
        [(None, None, "a"), (DAY, float("nan"), None), (DAY, None, "a"), (DAY, 2.0, "")], "day date, x double, s string")
    got = {(r.day, r.column): r for r in P.day_profiles(df, "day", ["x", "s"]).collect()}
    x = got[DAY, "x"]
    assert (x.rows, x.nulls, x.n, x["mean"], x.lo) == (3, 1, 1, 2.0, 2.0)
    assert (got[None, "x"].n, got[None, "x"].quantiles, got[DAY, "s"].quantiles) == (0, None, None)
    whole = {r.column: r for r in P.merged(spark.read.parquet(_kept(df))).select(
        "*", P.quantiles([0.5]).alias("q"), P.distinct_count().alias("d")).collect()}
    assert (whole["x"].rows, whole["x"]["std"], whole["x"].q, whole["s"].q, whole["s"].d) == (4, None, [2.0], None, 2)
    none = spark.createDataFrame([], df.schema)
    assert P.merged(P.day_profiles(none, "day")).count() == 0


def test_drift_from_profiles(spark):
    a = spark.range(20_000).select((F.xxhash64("id") % 1000).cast("double").alias("v"), F.lit(1).alias("day"), F.lit("t").alias("s"))
    b = a.withColumn("v", F.col("v") + F.when(F.col("v") > 0, 300).otherwise(0))
    one, two = (P.merged(P.day_profiles(x, "day", ["v", "s"])) for x in (a, b))
    got = {r.column: r for r in P.drift(one, two).collect()}
    exact = ks_statistic(a, b, "v").first().ks
    assert abs(got["v"].ks - exact) <= 2 * P.RANK_ERROR + 1 / 200 and got["v"].mean_shift > 0.1
    assert got["s"].ks is None and got["s"].mean_shift is None
    assert P.drift(one, one).where("column = 'v'").first().ks <= 2 * P.RANK_ERROR  # sketched twice


@pytest.fixture
def rules(spark):
    return {"x_known": F.col("x").isNotNull(), "x_small": F.col("x") <= 10}


def test_ingest_splits_rows_in_one_pass(spark, rules):
    rows = [(1, 5), (2, None), (3, 11), (4, 11), (4, 11), (5, 10)]
    source = tempfile.mkdtemp(prefix="tillcast-in-") + "/in"
    spark.createDataFrame(rows, "k int, x int").write.parquet(source)
    df = spark.read.parquet(source)
    out = quarantine.ingest(df, rules, tempfile.mkdtemp(prefix="tillcast-out-") + "/out")
    assert sorted(tuple(r) for r in out.good.collect()) == [(1, 5), (5, 10)] and out.good.columns == df.columns
    assert sorted((r.k, r.x, r.failed_rules) for r in out.failed.collect()) == [
        (2, None, ["x_known"]), (3, 11, ["x_small"]), (4, 11, ["x_small"]), (4, 11, ["x_small"])]
    assert {r.rule: (r.failed, r.passed) for r in out.counts.collect()} == {"x_known": (1, 5), "x_small": (3, 3)}
    plan = quarantine.checked(df, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_the_ingest_job_reads_its_input_once(spark, rules):
    """An accumulator in the input's path counts every row that is read."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = spark.range(1000).select(F.col("id").alias("x")).mapInPandas(count, "x long")
    out = quarantine.ingest(df, rules, tempfile.mkdtemp(prefix="tillcast-once-") + "/out")
    assert (out.good.count(), out.failed.count(), out.counts.where("rule = 'x_small'").first().failed) == (11, 989, 989)
    assert seen.value == 1000


def test_ingest_of_nothing_and_of_clashing_names(spark, rules):
    none = spark.createDataFrame([], "k int, x int")
    out = quarantine.ingest(none, rules, tempfile.mkdtemp(prefix="tillcast-none-") + "/out")
    assert out.good.count() == out.failed.count() == 0
    assert {(r.failed, r.passed) for r in out.counts.collect()} == {(0, 0)}
    with pytest.raises(ValueError):
        quarantine.ingest(none.withColumn("passed", F.lit(1)), rules, "unused")
