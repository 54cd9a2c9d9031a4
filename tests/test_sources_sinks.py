"""Typed CSV readers (S1-S6), sinks and keyed export (K1-K5)."""

import datetime as dt
import os

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from tallycast.session import scratch_path
from tallycast.sinks import duplicate_keys, keyed, read_csv_dir, read_keyed, write_csv, write_keyed
from tallycast.sources import bind_columns, read_bound, read_csv, read_csv_with_rejects, schemas


def _write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_read_each_input_schema(spark, tmp_path):
    units = read_csv(spark, _write(tmp_path, "u.csv", "LOM,Centre A\nLOM,Centre B\nVDA,Centre C\n"), schemas.UNITS)
    assert units.columns == ["area", "unit"] and units.count() == 3
    daily = read_csv(spark, _write(tmp_path, "d.csv", "LOM,2021-01-02,15\n"), schemas.DAILY).first()
    assert daily.obs_date == dt.date(2021, 1, 2) and daily.total == 15
    banded = read_csv(spark, _write(tmp_path, "b.csv", "LOM,2021-03-01,20-29,7\nLOM,2021-03-01,20-29,3\n"), schemas.BANDED)
    assert dict(banded.dtypes) == {"area": "string", "obs_date": "date", "band": "string", "total": "bigint"}
    pop = read_csv(spark, _write(tmp_path, "p.csv", "area,population\nABR,1285256\nBAS,547579\n"),
                   schemas.POPULATION, header=True)
    # with the header option the first data row is kept (the original lost it)
    assert sorted(r.area for r in pop.collect()) == ["ABR", "BAS"]


def test_strict_read_fails_on_bad_number(spark, tmp_path):
    for lines in ("LOM,2021-01-02,x15\n", "LOM,2021-01-02,\n", ",2021-01-02,3\n", "LOM,2021-01-02\n", "LOM,2021-01-02,3,4\n"):
        path = _write(tmp_path, f"bad{len(lines)}{lines.count(',')}.csv", lines)
        for read in (lambda d: d.collect(), lambda d: d.select("area").collect(), lambda d: d.count()):
            with pytest.raises((Py4JJavaError, PySparkException)):
                read(read_csv(spark, path, schemas.DAILY))


def test_rejects_are_split_off(spark, tmp_path):
    path = _write(tmp_path, "mixed.csv", "LOM,2021-01-02,15\nLOM,2021-02-31,1\nVDA,2021-01-03,abc\nVDA,2021-01-04,2\n")
    good, bad = read_csv_with_rejects(spark, path, schemas.DAILY)
    assert sorted((r.area, r.total) for r in good.collect()) == [("LOM", 15), ("VDA", 2)]
    assert sorted(r.obs_date for r in bad.collect()) == ["2021-01-03", "2021-02-31"]


def test_good_and_rejected_rows_add_up(spark, tmp_path):
    lines = ["LOM,2021-01-02,15", "LOM,2021-01-02,", ",2021-01-02,1", "LOM,2021-01-02", "LOM,2021-01-02,1,9", "VDA,2021-01-04,2"]
    good, bad = read_csv_with_rejects(spark, _write(tmp_path, "odd.csv", "\n".join(lines) + "\n"), schemas.DAILY)
    assert sorted((r.area, r.total) for r in good.collect()) == [("LOM", 15), ("VDA", 2)]
    assert bad.count() == 4


def test_bind_columns_by_position(spark):
    df = spark.createDataFrame([("LOM", "2021-01-02", "15")], "_c0 string, _c1 string, _c2 string")
    out = bind_columns(df, schemas.DAILY)
    assert out.dtypes == [("area", "string"), ("obs_date", "date"), ("total", "bigint")]
    assert out.first().total == 15


def test_csv_round_trip_under_checkpoint_dir(spark):
    df = spark.createDataFrame([("A", dt.date(2021, 1, 1), 3), ("B", dt.date(2021, 1, 2), 4)], schemas.DAILY)
    path = scratch_path(spark, "rt")
    write_csv(df, path, header=True)
    back = read_csv_dir(spark, path, schemas.DAILY, header=True)
    assert sorted(back.collect()) == sorted(df.collect())


def test_keyed_export_and_uniqueness(spark):
    df = spark.createDataFrame([("A", "01", 1.5), ("A", "02", 2.5)], "area string, m string, v double")
    k = keyed(df, ["area", "m"], ["v"])
    assert sorted(r.row_key for r in k.collect()) == ["A::01", "A::02"]
    path = scratch_path(spark, "keyed")
    write_keyed(k, path)
    assert read_keyed(spark, path).count() == 2
    dup = keyed(df.unionByName(df), ["area", "m"], ["v"])
    assert duplicate_keys(dup).count() == 2
    with pytest.raises(ValueError):
        write_keyed(dup, scratch_path(spark, "dup"))


def test_rejects_with_header(spark, tmp_path):
    path = _write(tmp_path, "h.csv", "area,population\nABR,1285256\nBAS,n/a\n")
    good, bad = read_csv_with_rejects(spark, path, schemas.POPULATION, header=True)
    assert [(r.area, r.population) for r in good.collect()] == [("ABR", 1285256)]
    assert [(r.area, r.population) for r in bad.collect()] == [("BAS", "n/a")]


def test_bucketed_tables_join_without_shuffle(spark):
    import contextlib
    import io

    from fixtures import SF001
    from tallycast.sinks import write_bucketed
    from tallycast.sources import table

    orders = table(spark, SF001, "orders").select("o_custkey", "o_orderdate")
    customer = table(spark, SF001, "customer").select("c_custkey", "c_nationkey")
    write_bucketed(orders, "orders_by_cust", "o_custkey", 8, scratch_path(spark, "orders_b"))
    write_bucketed(customer, "customer_by_cust", "c_custkey", 8, scratch_path(spark, "customer_b"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        o, c = spark.table("orders_by_cust"), spark.table("customer_by_cust")
        joined = o.join(c, o.o_custkey == c.c_custkey)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            joined.explain()
        plan = buf.getvalue()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == orders.join(customer, orders.o_custkey == customer.c_custkey).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)



def test_pipeline_input_over_bucketed_catalog_tables(spark):
    import contextlib
    import io

    from fixtures import SF001
    from tallycast.sinks import write_bucketed
    from tallycast.sources import daily_totals_table, table

    spark.sql("CREATE DATABASE IF NOT EXISTS bucketed")
    write_bucketed(table(spark, SF001, "orders"), "bucketed.orders", "o_custkey", 8, scratch_path(spark, "bo"))
    write_bucketed(table(spark, SF001, "customer"), "bucketed.customer", "c_custkey", 8, scratch_path(spark, "bc"))
    table(spark, SF001, "nation").write.mode("overwrite").option("path", scratch_path(spark, "bn")) \
        .saveAsTable("bucketed.nation")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10000")  # the area table only
    try:
        daily = daily_totals_table(spark, "catalog:bucketed")
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            daily.explain()
        plan = buf.getvalue()
        # the only shuffle left is the aggregation's; the orders-customer join reads buckets in place
        assert plan.count("Exchange hashpartitioning") == 1
        assert sorted(daily.collect()) == sorted(daily_totals_table(spark, SF001).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_bound_columns_fail_on_what_they_cannot_bind(spark, tmp_path):
    head = "d,a,b,x,y\n"
    path = _write(tmp_path, "wide.csv", head + "2021-01-01,LOM,20-29,1,2\n2021-01-02,VDA,30-39,,4\n")
    bind = {"area": "a", "obs_date": "d", "band": "b", "total": "y"}
    got = read_bound(spark, path, schemas.BANDED, bind, header=True)
    assert [(r.area, r.band, r.total) for r in got.collect()] == [("LOM", "20-29", 2), ("VDA", "30-39", 4)]
    for bad in ({"total": "z"}, {"total": 9}, {"totals": "y"}):
        with pytest.raises(ValueError):
            read_bound(spark, path, schemas.BANDED, {**bind, **bad}, header=True)
    with pytest.raises(ValueError):
        read_bound(spark, path, schemas.BANDED, {"total": "y"})
    for text in (head + "2021-01-01,LOM,20-29,1\n", head + "2021-01-01,LOM,20-29,1,two\n", head + "2021-01-01,LOM,20-29,1,\n"):
        with pytest.raises((Py4JJavaError, PySparkException)):
            read_bound(spark, _write(tmp_path, f"bad{len(text)}.csv", text), schemas.BANDED, bind, header=True).count()
    # files with other columns than the first fail rather than mix
    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "1.csv").write_text(head + "2021-01-01,LOM,20-29,1,2\n")
    (folder / "2.csv").write_text("d,a,b,y,x\n2021-01-01,LOM,20-29,1,2\n")
    with pytest.raises((Py4JJavaError, PySparkException)):
        read_bound(spark, str(folder), schemas.BANDED, bind, header=True).count()


def test_publish_replaces_the_pointer(spark, tmp_path):
    from tallycast.sinks import new_version, publish, published

    base = str(tmp_path / "results")
    for i in range(3):
        version = new_version(base)
        spark.range(i + 1).write.parquet(f"{version}/t.parquet")
        publish(spark, version)
        assert published(spark, base) == version
        assert spark.read.parquet(f"{published(spark, base)}/t.parquet").count() == i + 1
    assert sorted(x for x in os.listdir(base) if not x.startswith((".", "v-"))) == ["CURRENT"]
