"""A key holding a third of all rows: the large join is split by AQE and results stay whole."""

import collections
import contextlib
import datetime as dt
import io
import random

import pytest

from tallycast.plans import forecast_total_share
from tallycast.session import scratch_path
from tallycast.sources import daily_totals_table, population_table

HOT_CUSTOMER = 7

SKEW_CONF = {
    # force the sort-merge path and make the tiny fixture count as skewed
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(1)
    orders = []
    for i in range(30000):
        cust = HOT_CUSTOMER if i % 3 == 0 else rng.randrange(1, 2000)
        day = dt.datetime(1996, 1, 1) + dt.timedelta(days=rng.randrange(400))
        orders.append((i, cust, "O", 1.0, day, "1-URGENT"))
    base = scratch_path(spark, "skewed-warehouse")
    spark.createDataFrame(
        orders,
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string",
    ).repartition(8).write.parquet(base + "/orders.parquet")
    customers = [(c, f"C{c}", c % 5, 0.0, "SEG") for c in range(1, 2000)]
    spark.createDataFrame(
        customers, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ).write.parquet(base + "/customer.parquet")
    spark.createDataFrame([(k, f"N{k}", 0) for k in range(5)], "n_nationkey int, n_name string, n_regionkey int") \
        .write.parquet(base + "/nation.parquet")
    expected = collections.Counter((f"N{c % 5}", d.date()) for _, c, _, _, d, _ in orders)
    return base, expected


@contextlib.contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_join_key_is_split_and_totals_are_whole(spark, skewed):
    base, expected = skewed
    with conf(spark, SKEW_CONF):
        df = daily_totals_table(spark, base)
        rows = df.collect()
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain()
    plan = out.getvalue()
    assert "isFinalPlan=true" in plan
    assert "SortMergeJoin(skew=true)" in plan
    assert {(r.area, r.obs_date): r.total for r in rows} == dict(expected)


def test_hot_area_share_is_exact(spark, skewed):
    base, expected = skewed
    with conf(spark, SKEW_CONF):
        out = forecast_total_share(
            daily_totals_table(spark, base), population_table(spark, base), dt.date(1997, 1, 1)
        ).collect()
    history = collections.Counter()
    for (area, day), n in expected.items():
        if day < dt.date(1997, 1, 1):
            history[area] += n
    assert {r.area: r.history for r in out} == dict(history)
    hot_area = f"N{HOT_CUSTOMER % 5}"
    assert max(history, key=history.get) == hot_area
