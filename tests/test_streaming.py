"""File-stream ingest: drops appended incrementally, pipelines read the result."""

import datetime as dt
import os
import subprocess
import sys

import pytest

from tallycast.operators.aggregates import merge_rows
from tallycast.session import scratch_path
from tallycast.sources import schemas
from tallycast.streaming import ingest, ingest_with_rejects, read_ingested, read_rejects


def test_ingest_appends_drops_and_resumes(spark, tmp_path):
    src = tmp_path / "drops"
    src.mkdir()
    (src / "a.csv").write_text("LOM,2021-03-01,20-29,5\nLOM,2021-03-01,20-29,5\nVDA,2021-04-02,20-29,1\n")
    table_dir = scratch_path(spark, "ingested")
    ckpt = scratch_path(spark, "ingest-ckpt")
    ingest(spark, str(src), schemas.BANDED, table_dir, checkpoint=ckpt).awaitTermination()
    first = read_ingested(spark, table_dir, schemas.BANDED)
    assert first.count() == 3
    # a second drop: only the new file is read on restart
    (src / "b.csv").write_text("LOM,2021-03-01,20-29,2\n")
    ingest(spark, str(src), schemas.BANDED, table_dir, checkpoint=ckpt).awaitTermination()
    table = read_ingested(spark, table_dir, schemas.BANDED)
    assert table.count() == 4
    merged = {(r.area, r.obs_date): r.total for r in merge_rows(table, ["area", "obs_date", "band"]).collect()}
    assert merged == {("LOM", dt.date(2021, 3, 1)): 12, ("VDA", dt.date(2021, 4, 2)): 1}
    # month partitions prune a date range
    march = spark.read.parquet(table_dir).filter("month = date'2021-03-01'")
    assert march.count() == 3


def test_pipeline_over_ingested_daily_feed(spark, tmp_path):
    import contextlib
    import io

    from fixtures import Q1_DAILY, Q1_EXPECTED, Q1_UNITS
    from tallycast.plans import daily_mean_per_unit

    src = tmp_path / "daily"
    src.mkdir()
    # two drops; the pipeline sees their union
    (src / "1.csv").write_text("".join(f"{a},{d},{t}\n" for a, d, t in Q1_DAILY[:3]))
    (src / "2.csv").write_text("".join(f"{a},{d},{t}\n" for a, d, t in Q1_DAILY[3:]))
    table_dir = scratch_path(spark, "daily-table")
    ingest(spark, str(src), schemas.DAILY, table_dir).awaitTermination()
    daily = read_ingested(spark, table_dir, schemas.DAILY, dt.date(2021, 1, 1), dt.date(2022, 1, 1))
    units = spark.createDataFrame(Q1_UNITS, schemas.UNITS)
    out = daily_mean_per_unit(daily, units, 2021)
    assert {(r.area, r.month): r.mean_per_unit for r in out.collect()} == Q1_EXPECTED
    # the year range prunes the month partitions of other years
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain("formatted")
    plan = buf.getvalue()
    assert "PartitionFilters: [isnotnull(month" in plan and "month#" in plan
    assert spark.read.parquet(table_dir).select("month").distinct().count() == 3  # 2020-12, 2021-01, 2021-02


ONE_RUN = """
import sys
from tallycast import build_session
from tallycast.sources import schemas
from tallycast.streaming import ingest, ingest_with_rejects
src, table, ckpt, kind = sys.argv[1:]
spark = build_session("local[2]", 2, extra={"spark.checkpoint.dir": ckpt})
{"plain": ingest, "rejects": ingest_with_rejects}[kind](spark, src, schemas.BANDED, table).awaitTermination()
"""


@pytest.mark.parametrize("kind", ["plain", "rejects"])
def test_two_processes_ingest_every_drop_once(spark, tmp_path, kind):
    src, table_dir = tmp_path / "drops", str(tmp_path / "table")
    src.mkdir()
    env = os.environ | {"PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}

    def one_process():
        subprocess.run([sys.executable, "-c", ONE_RUN, str(src), table_dir, str(tmp_path / "ckpt"), kind], check=True, env=env, timeout=300)

    bad = "LOM,2021-03-01,20-29\nLOM,2021-03-01,20-29,x\n" if kind == "rejects" else ""
    (src / "a.csv").write_text("LOM,2021-03-01,20-29,5\nLOM,2021-03-01,20-29,5\nVDA,2021-04-02,20-29,1\n" + bad)
    one_process()
    (src / "b.csv").write_text("LOM,2021-03-01,20-29,2\n" + bad)
    one_process()
    one_process()  # nothing new
    rows = read_ingested(spark, table_dir, schemas.BANDED, dt.date(2021, 3, 1), dt.date(2021, 5, 1)).collect()
    assert sorted((r.area, r.total) for r in rows) == [("LOM", 2), ("LOM", 5), ("LOM", 5), ("VDA", 1)]
    if kind == "rejects":
        assert sorted((r.area, r.total or "") for r in read_rejects(spark, table_dir).collect()) == [("LOM", ""), ("LOM", "")] + [("LOM", "x")] * 2


def test_a_batch_that_runs_again_replaces_its_rows(spark, tmp_path):
    src, table_dir = tmp_path / "in", str(tmp_path / "t")
    src.mkdir()
    (src / "a.csv").write_text("LOM,2021-03-01,20-29,5\nbad\n")
    for n in range(2):  # the second checkpoint has forgotten that batch 0 was written
        ingest_with_rejects(spark, str(src), schemas.BANDED, table_dir, checkpoint=str(tmp_path / f"c{n}")).awaitTermination()
    assert read_ingested(spark, table_dir, schemas.BANDED).count() == 1
    assert read_rejects(spark, table_dir).count() == 1
