"""Parquet table access and the pipeline inputs derived from the warehouse tables.

The test warehouse is order-shaped (orders, customer, nation, supplier), so the
pipeline inputs are derived from it:

  area       nation name (via the customer's nation; the supplier's for units)
  obs_date   order date
  band       customer market segment
  supplier   order priority -- several rows per (area, date, band), one per value
  total      number of orders
  units      suppliers per nation
  population customers per nation times a constant

Every derived input is a lazy plan over the whole tables: Catalyst prunes the
columns, pushes date predicates into the orders scan, and sizes the joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


# Declared schemas of the warehouse tables the pipelines read. Declaring them
# skips schema inference, which otherwise runs a footer-reading job per read.
# Only the declared columns are visible; other tables fall back to inference.
WAREHOUSE_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "region": "r_regionkey int, r_name string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


CATALOG_PREFIX = "catalog:"


def table(spark: SparkSession, base: str, name: str, infer: bool = False) -> DataFrame:
    """``{base}/{name}.parquet`` as a DataFrame, with its declared schema when known.

    ``base = "catalog:<database>"`` reads the catalog table ``<database>.<name>``
    instead -- e.g. orders and customer stored bucketed by customer key
    (``sinks.write_bucketed``), whose join then needs no shuffle.
    """
    if base.startswith(CATALOG_PREFIX):
        database = base[len(CATALOG_PREFIX):]
        return spark.table(f"{database}.{name}" if database else name)
    path = f"{base.rstrip('/')}/{name}.parquet"
    ddl = None if infer else WAREHOUSE_SCHEMAS.get(name)
    reader = spark.read.schema(ddl) if ddl else spark.read
    return reader.parquet(path)


def _nation(spark: SparkSession, base: str) -> DataFrame:
    """The area dimension; the planner broadcasts it under its byte threshold, AQE by its measured size."""
    return table(spark, base, "nation").select("n_nationkey", F.col("n_name").alias("area"))


def _orders_by_area(spark: SparkSession, base: str, orders: DataFrame, keep: list[str]) -> DataFrame:
    """orders joined to the customer's nation and segment.

    orders is joined to customer first (the one large join: broadcast only when
    customer passes the planner's size check, otherwise sort-merge with AQE
    splitting skewed keys), then to the area dimension.
    """
    customer = table(spark, base, "customer").select(
        "c_custkey", "c_nationkey", F.col("c_mktsegment").alias("band")
    )
    with_cust = orders.join(customer, orders.o_custkey == customer.c_custkey)
    nation = _nation(spark, base)
    return with_cust.join(nation, with_cust.c_nationkey == nation.n_nationkey).select("area", *keep)


def supplier_rows(spark: SparkSession, base: str) -> DataFrame:
    """(area, obs_date, band, supplier, total): the per-supplier banded counts.

    Date ranges applied later on ``obs_date`` (a cast of the order timestamp)
    are rewritten by Catalyst into timestamp bounds pushed into the orders scan.
    """
    orders = table(spark, base, "orders").select(
        "o_custkey",
        F.col("o_orderdate").cast("date").alias("obs_date"),
        F.col("o_orderpriority").alias("supplier"),
    )
    joined = _orders_by_area(spark, base, orders, ["obs_date", "band", "supplier"])
    return joined.groupBy("area", "obs_date", "band", "supplier").agg(
        F.count(F.lit(1)).alias("total")
    )


def daily_totals_table(spark: SparkSession, base: str) -> DataFrame:
    """(area, obs_date, total): one row per area and day, all bands and suppliers."""
    orders = table(spark, base, "orders").select(
        "o_custkey", F.col("o_orderdate").cast("date").alias("obs_date")
    )
    joined = _orders_by_area(spark, base, orders, ["obs_date"])
    return joined.groupBy("area", "obs_date").agg(F.count(F.lit(1)).alias("total"))


def units_table(spark: SparkSession, base: str) -> DataFrame:
    """(area, unit): one row per supplier, placed in its nation."""
    nation = _nation(spark, base)
    supplier = table(spark, base, "supplier").select("s_nationkey", F.col("s_name").alias("unit"))
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select("area", "unit")


def population_table(spark: SparkSession, base: str, per_customer: int = 10) -> DataFrame:
    """(area, population): customers per nation times ``per_customer``."""
    nation = _nation(spark, base)
    per_nation = (
        table(spark, base, "customer")
        .groupBy("c_nationkey")
        .agg(F.count(F.lit(1)).alias("customers"))
    )
    return per_nation.join(nation, per_nation.c_nationkey == nation.n_nationkey).select(
        "area", (F.col("customers") * F.lit(per_customer)).cast("bigint").alias("population")
    )


def embedding_features(spark: SparkSession, base: str) -> DataFrame:
    """(vec_id, label, embedding array<double>) from the embeddings table."""
    return table(spark, base, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding")
    )
