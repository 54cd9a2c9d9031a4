"""Plan properties that matter at scale, checked on the physical plans."""

import contextlib
import io

import pytest

from fixtures import SF001
from tallycast import registry
from tallycast.operators import cluster
from tallycast.sources import embedding_features


def plan_of(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.fixture
def no_auto_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_q1_prunes_and_pushes_into_the_orders_scan(spark):
    plan = plan_of(registry.q1_daily_mean_per_unit(spark, SF001))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01T00:00)" in plan
    assert "LessThan(o_orderdate,1997-01-01T00:00)" in plan


def test_q2_shape(spark, no_auto_broadcast):
    plan = plan_of(registry.q2_next_month_top_k(spark, SF001))
    tree = plan.split("\n\n")[0]
    assert tree.count("WindowGroupLimit") == 2          # k rows per group and task before the last shuffle
    assert "REPARTITION" not in plan                    # the fit is spread over (month, area, band)
    assert "SortMergeJoin" in tree and "Broadcast" not in tree  # no size-unchecked broadcast
    assert "GreaterThanOrEqual(o_orderdate,1996-02-01T00:00)" in plan


def test_q3a_single_aggregate_per_area(spark):
    plan = plan_of(registry.q3_forecast_share(spark, SF001))
    assert "regr_slope" in plan and "regr_intercept" in plan
    assert "LessThan(o_orderdate,1999-06-01T00:00)" in plan


def test_label_cost_is_one_aggregate_without_join(spark):
    plan = plan_of(cluster.label_cost(embedding_features(spark, SF001), "embedding", "label"))
    tree = plan.split("\n\n")[0]
    assert "Join" not in tree
    assert tree.count("- Exchange (") == 1
    assert "ReadSchema: struct<embedding:array<float>,label:int>" in plan
