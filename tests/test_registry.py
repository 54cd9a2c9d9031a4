"""Every registered query against its DuckDB SQL at sf0.01; entry smoke check."""

import pytest

import __spark_entry__ as E
from fixtures import SF001
from oracle import compare, duck

SQL = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["next_month", "band", "area", "forecast", "rank"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, con, name):
    assert compare(QUERIES[name](spark, SF001), con, SQL[name]) == []


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_registered_sweeps_shape(spark):
    from fixtures import SF0001

    shares = QUERIES["q3_forecast_share"](spark, SF0001)
    areas = shares.count()
    q3 = QUERIES["q3_cluster_sweep"](spark, SF0001)
    assert q3.count() == 2 * 4 * areas
    assert q3.select("row_key").distinct().count() == q3.count()
    assert q3.filter("wssse < 0 or cost < 0").count() == 0
    cmp = QUERIES["cluster_comparison"](spark, SF0001).collect()
    assert len(cmp) == 8 and sorted({r.rank_in_k for r in cmp}) == [1, 2]
    emb = spark.read.parquet(f"{SF0001}/embeddings.parquet").count()
    assert QUERIES["embedding_cluster_sweep"](spark, SF0001).count() == 8 * emb
