"""Readers for the star-schema tables and adapters to the retail shapes.

The adapters turn the generic tables into the shapes the operators consume
(sales, promotions, customer traffic, store events, a single daily series).
They are lazy projections/joins: Catalyst prunes columns and pushes filters
into the Parquet scans; dimension joins are left to the planner, which
broadcasts a side only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` (and AQE re-plans at runtime).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.functions.holidays import is_holiday

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)

# Shift that moves the event stream (2024) onto the sales calendar (2000).
EVENT_DAY_SHIFT = 8766


#: Bytes of a file that one task reads.  The totals per product and day and the distinct values of a profile hold
#: nearly every row of their task in memory, at some 20 times its compressed size.
SPLIT_BYTES = 16 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table by its name; from now on, files are read in splits of at most ``SPLIT_BYTES`` in this session."""
    key = "spark.sql.files.maxPartitionBytes"
    if int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()) > SPLIT_BYTES:
        spark.conf.set(key, str(SPLIT_BYTES))
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def state(spark: SparkSession, sf_dir: str) -> tuple:
    """Path, length and change time of each table (folders: of what lies right in them); differs once a table is rewritten."""
    conf = spark._jsc.hadoopConfiguration()
    found = []
    for name in TABLES:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        store = path.getFileSystem(conf)
        if store.exists(path):
            found += [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in store.listStatus(path)]
    return tuple(sorted(found))


def store_key(col: str | Column) -> Column:
    """``store_007`` style identifiers from an integer key (longer keys stay whole, null stays null)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isNotNull(), F.format_string("store_%03d", c.cast("bigint")))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """date × store × product sales lines (store = supplier nation, category = brand).

    Lines of an unknown supplier or part stay, with a null store, or null category and price.
    """
    li = read(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate"
    )
    sup = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    part = read(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_retailprice")
    j = li.join(sup, li.l_suppkey == sup.s_suppkey, "left").join(part, li.l_partkey == part.p_partkey, "left")
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    cost = F.lit(0.7) * F.col("l_extendedprice")
    return j.select(
        F.to_date("l_shipdate").alias("date"),
        store_key("s_nationkey").alias("store_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("p_brand").alias("category"),
        F.col("l_quantity").cast("bigint").alias("quantity_sold"),
        F.col("p_retailprice").alias("unit_price"),
        F.col("l_discount").alias("discount_percent"),
        revenue.alias("revenue"),
        cost.alias("cost"),
        (revenue - cost).alias("profit"),
    )


def promotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discounted lines (discount ≥ 8 %) as (timestamp, product, type, discount)."""
    li = read(spark, sf_dir, "lineitem")
    return li.where(F.col("l_discount") >= 0.08).select(
        F.col("l_shipdate").alias("date"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.lit("markdown").alias("promotion_type"),
        F.col("l_discount").alias("discount_percent"),
    )


def customer_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One visit per order at the customer's nation store (null for an unknown customer)."""
    o = read(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey, "left")
    d = F.to_date("o_orderdate")
    return j.select(
        d.alias("date"),
        store_key("c_nationkey").alias("store_id"),
        F.lit(1).cast("bigint").alias("customer_traffic"),
        F.lit(1.0).alias("weather_impact"),
        is_holiday(d).alias("is_holiday"),
    )


def store_event_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store events from the ``error`` stream: closures (1 day) and renovations (7–21 days)."""
    ev = read(spark, sf_dir, "events").where(F.col("event_type") == "error")
    stores = read(spark, sf_dir, "nation").agg(F.count(F.lit(1))).scalar()  # one store per nation
    closure = F.col("value") < 100
    return ev.select(
        store_key(F.try_mod(F.col("user_id"), stores)).alias("store_id"),
        F.date_sub(F.to_date("ts"), EVENT_DAY_SHIFT).alias("start_date"),
        F.when(closure, "closure").otherwise("renovation").alias("event_type"),
        F.when(closure, -1.0).otherwise(-0.3).alias("impact"),
        F.when(closure, 1).otherwise(7 + F.col("event_id") % 15).cast("int").alias("duration_days"),
    )


def orders_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single revenue series: total order value per day (``history_csv`` shape).

    Order totals carry cents, so daily sums are snapped to cents.
    """
    o = read(spark, sf_dir, "orders")
    return (
        o.groupBy(F.to_date("o_orderdate").alias("date"))
        .agg((F.round(F.sum("o_totalprice") * 100.0, 0) / 100.0).alias("total_revenue"))
        .select("date", F.lit("store_001").alias("store_id"), "total_revenue")
    )


def orders_store_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue per (day, customer-nation store) from orders: many parallel series (unknown customers: a null store)."""
    o = read(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey, "left")
    return j.groupBy(
        F.to_date("o_orderdate").alias("date"), store_key("c_nationkey").alias("store_id")
    ).agg((F.round(F.sum("o_totalprice") * 100.0, 0) / 100.0).alias("total_revenue"))
