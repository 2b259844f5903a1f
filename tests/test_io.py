import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from tillcast.sources import files, tables as T

SMALL = "/root/testdata/sf0.001"


def test_partitioned_roundtrip_and_date_filter(spark):
    root = tempfile.mkdtemp(prefix="tillcast-io-")
    sales = T.sales(spark, SMALL)
    files.write_partitioned_by_day(sales, f"{root}/sales")
    back = files.read_day_partitioned(spark, f"{root}/sales")
    assert back.count() == sales.count()
    lo = sales.agg(F.min("date")).first()[0]
    first_week = files.read_day_partitioned(spark, f"{root}/sales", end=str(lo + dt.timedelta(days=6)))
    assert first_week.count() == sales.where(F.col("date") <= lo + dt.timedelta(days=6)).count()
    files.write_weekly_snapshot(sales, f"{root}/weekly")
    snap = spark.read.parquet(f"{root}/weekly")
    assert snap.where(F.weekday("date") != 6).count() == 0 and {"year", "week"} <= set(snap.columns)


def test_history_csv_and_export(spark):
    root = tempfile.mkdtemp(prefix="tillcast-csv-")
    with open(f"{root}/h.csv", "w") as f:
        f.write("date,total_revenue\n2025-09-01,10.125\n2025-09-02,11.5\n")
    h = files.read_history_csv(spark, f"{root}/h.csv")
    assert [r.store_id for r in h.collect()] == ["store_001", "store_001"]
    files.export_csv(h, f"{root}/out")
    back = spark.read.csv(f"{root}/out", header=True)
    assert sorted(float(r.total_revenue) for r in back.collect()) == [10.12, 11.5]  # half-to-even


def test_daily_writes_keep_earlier_days(spark):
    root = tempfile.mkdtemp(prefix="tillcast-days-")
    days = [spark.createDataFrame([(dt.date(2021, 1, d), float(v))], "date date, x double") for d, v in ((1, 1), (2, 2), (2, 3))]
    for day in days:
        files.write_partitioned_by_day(day, root)
    assert sorted((r.date.day, r.x) for r in spark.read.parquet(root).collect()) == [(1, 1.0), (2, 3.0)]


def test_store_keys_stay_whole(spark):
    df = spark.createDataFrame([(7,), (1234,), (1235,), (None,)], "k int")
    assert [r.s for r in df.select(T.store_key("k").alias("s")).collect()] == ["store_007", "store_1234", "store_1235", None]


def test_unmatched_dimensions_stay(spark):
    """A line of an unknown supplier and part, and an order of an unknown customer, are not lost."""
    root = tempfile.mkdtemp(prefix="tillcast-dims-")
    for name in ("lineitem", "supplier", "part", "orders", "customer"):
        src = T.read(spark, SMALL, name)
        key = {"supplier": "s_suppkey", "part": "p_partkey", "customer": "c_custkey"}.get(name)
        (src.where(F.col(key) > 5) if key else src).write.parquet(f"{root}/{name}.parquet")
    assert T.sales(spark, root).count() == T.read(spark, SMALL, "lineitem").count()
    assert T.customer_traffic(spark, root).count() == T.read(spark, SMALL, "orders").count()
    assert T.sales(spark, root).where("store_id is null").count() > 0


def test_folds_and_intervals(spark):
    from tillcast.operators import forecast, split as S

    days = spark.createDataFrame([(dt.date(2021, 1, 1) + dt.timedelta(days=i),) for i in range(12)], "date date")
    folds = S.time_series_folds(days, folds=5)
    f1 = {r.role: r.n for r in folds.where("fold = 1").groupBy("role").agg(F.count("*").alias("n")).collect()}
    assert f1 == {"train": 2, "validation": 2}
    preds = spark.createDataFrame([("s", 100.0)], "store_id string, predicted_sales double")
    res = spark.createDataFrame([("s", float(x)) for x in range(-10, 11)], "store_id string, residual double")
    iv = forecast.residual_intervals(preds, res).first()
    assert iv.lower_80 == 92.0 and iv.upper_80 == 108.0


def test_clamp(spark):
    from tillcast.operators import rules

    r = spark.range(1).select(rules.clamp(F.lit(1.5), 0.5, 1.2).alias("a"), rules.clamp(F.lit(0.1), 0.5).alias("b")).first()
    assert (r.a, r.b) == (1.2, 0.5)


def _file_issues(spark, root, expected, negative, **options):
    from tillcast.sources import ingest

    report = ingest.file_report(spark, root, expected, negative, **options)
    return {r.file.split("/")[-2]: (r.rows, sorted((i.issue, i.column) for i in r.issues)) for r in report.collect()}, report


def test_file_report_survives_bad_files(spark):
    """A missing column, another type, no rows, all NULLs, a broken file: a row each, and nothing stops."""
    from tillcast.sources import ingest

    root = tempfile.mkdtemp(prefix="tillcast-files-")
    good = T.sales(spark, SMALL).limit(20).select("date", "store_id", "product_id", "quantity_sold", "revenue").coalesce(1)
    good.write.parquet(f"{root}/sales/good")
    good.drop("revenue").write.parquet(f"{root}/sales/lacks")
    good.where("false").drop("revenue").write.parquet(f"{root}/sales/empty")
    good.withColumn("quantity_sold", F.col("quantity_sold").cast("string")).write.parquet(f"{root}/sales/text")
    good.withColumn("revenue", F.lit(None).cast("double")).write.parquet(f"{root}/sales/nulls")
    good.withColumn("quantity_sold", -F.col("quantity_sold")).write.parquet(f"{root}/sales/negative")
    nan = F.when(F.col("product_id") > "5", float("nan")).otherwise(-1.0)  # NaN: no statistics, so values are read
    good.withColumn("revenue", nan).write.parquet(f"{root}/sales/nan")
    good.write.partitionBy("store_id").parquet(f"{root}/byfolder/keys")
    os.makedirs(f"{root}/sales/broken")
    with open(f"{root}/sales/broken/x.parquet", "wb") as file:
        file.write(b"PAR1 no parquet PAR1")
    expected = {"date": "date", "store_id": ["string"], "product_id": None, "quantity_sold": "bigint", "revenue": "double"}
    got, report = _file_issues(spark, f"{root}/sales", expected, ["revenue", "quantity_sold", "store_id", "absent"])
    assert got == {
        "good": (20, []), "lacks": (20, [("missing", "revenue")]), "empty": (0, [("empty", None), ("missing", "revenue")]),
        "text": (20, [("type", "quantity_sold")]), "nulls": (20, []), "negative": (20, [("negative", "quantity_sold")]),
        "nan": (20, [("negative", "revenue")]), "broken": (None, [("unreadable", None)]),
    }
    details = {r.issue: r.detail for r in ingest.issue_rows(report).collect()}
    assert details["type"] == "string, expected bigint"
    keyed, _ = _file_issues(spark, f"{root}/byfolder", expected, [])
    assert keyed and all(issues == [] for _, issues in keyed.values())  # the folder names the store
    both = ingest.dataset_files(ingest.file_report(spark, root, expected), root).collect()
    counts = {r.dataset: (r.files, r.rows) for r in both}
    assert counts["sales"] == (8, 120) and counts["byfolder"][1] == 20
    assert {r.dataset: r.column_names for r in both}["byfolder"] == ["date", "product_id", "quantity_sold", "revenue"]


def test_file_report_through_spark_alone(spark, monkeypatch):
    """Files of a store that pyarrow does not know come through Spark, with the same report."""
    from tillcast.sources import ingest

    root = tempfile.mkdtemp(prefix="tillcast-store-")
    spark.range(3).select(F.col("id") - 1).toDF("x").coalesce(1).write.parquet(f"{root}/a")
    direct, _ = _file_issues(spark, root, {"x": "bigint", "y": None}, ["x"])
    monkeypatch.setattr(ingest, "_opens", lambda path: False)
    through, _ = _file_issues(spark, root, {"x": "bigint", "y": None}, ["x"])
    assert direct == through == {"a": (3, [("missing", "y"), ("negative", "x")])}


def test_tables_are_read_in_small_splits(spark):
    """A task's totals and distinct values grow with its split, so that is bounded; a smaller setting stays."""
    from tillcast.sources import tables

    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "128MB")
        tables.read(spark, "/root/testdata/sf0.001", "lineitem")
        assert int(spark.conf.get(key)) == tables.SPLIT_BYTES
        spark.conf.set(key, "1048576")
        tables.read(spark, "/root/testdata/sf0.001", "lineitem")
        assert spark.conf.get(key) == "1048576"
    finally:
        spark.conf.set(key, before)
