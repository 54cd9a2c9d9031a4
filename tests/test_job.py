"""The batch job end to end on CSV feeds: keyed outputs, unique keys, read-back."""

import datetime as dt
import os

import pytest

from fixtures import Q1_DAILY, Q1_UNITS, Q2_ROWS
from tallycast.job import Inputs, Params, run_job
from tallycast.session import scratch_path
from tallycast.sinks import drop_old_versions, published, read_csv_dir


def _csv(path, rows, header=None):
    lines = ([header] if header else []) + [",".join(str(v) for v in r) for r in rows]
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_run_job(spark, tmp_path):
    # population chosen so every area of the daily feed has one
    pop = [(a, 1000) for a in ("AAA", "BBB", "DDD")]
    daily = Q1_DAILY + [("BBB", dt.date(2021, 5, 30), 7), ("DDD", dt.date(2021, 5, 31), 2)]
    inputs = Inputs(
        units=_csv(tmp_path / "units.csv", Q1_UNITS),
        daily=_csv(tmp_path / "daily.csv", daily),
        banded=_csv(tmp_path / "banded.csv", Q2_ROWS),
        population=_csv(tmp_path / "pop.csv", pop, header="area,population"),
    )
    out = scratch_path(spark, "job")
    assert run_job(spark, inputs, out, Params(ks=[2])) == published(spark, out)
    out = published(spark, out)
    q1 = {r.row_key: r.avg for r in read_csv_dir(spark, f"{out}/query1", "row_key string, avg float").collect()}
    assert q1 == {"AAA::01": 7.75, "AAA::02": 3.5, "BBB::01": 5.0, "BBB::05": 7.0}
    q2 = read_csv_dir(spark, f"{out}/query2", "row_key string, forecast bigint, rank int").collect()
    assert sorted((r.rank, r.row_key, r.forecast) for r in q2)[0] == (1, "2021-04::20-29::A", 72)
    assert len(q2) == 5
    q3 = spark.read.parquet(f"{out}/query3.parquet")
    assert q3.count() == 2 * 3  # two algorithms x one k x three areas
    assert q3.select("row_key").distinct().count() == q3.count()
    cmp = {r.row_key: r.rank_in_k for r in spark.read.parquet(f"{out}/query3_comparison.parquet").collect()}
    assert set(cmp) == {"kmeans::2", "bisecting::2"} and sorted(cmp.values()) == [1, 2]


def test_cli_main(spark, tmp_path):
    from tallycast.job import main

    daily = Q1_DAILY + [("BBB", dt.date(2021, 5, 30), 7), ("DDD", dt.date(2021, 5, 31), 2)]
    args = [
        "--units", _csv(tmp_path / "u.csv", Q1_UNITS),
        "--daily", _csv(tmp_path / "d.csv", daily),
        "--banded", _csv(tmp_path / "b.csv", Q2_ROWS),
        "--population", _csv(tmp_path / "p.csv", [(a, 500) for a in ("AAA", "BBB", "DDD")], header="area,population"),
        "--out", scratch_path(spark, "cli"),
        "--ks", "2,3",
    ]
    main(args)
    out = published(spark, args[args.index("--out") + 1])
    assert spark.read.parquet(f"{out}/query3.parquet").count() == 2 * 2 * 3
    assert spark.read.parquet(f"{out}/query3_comparison.parquet").count() == 4


@pytest.fixture
def feeds(tmp_path):
    daily = Q1_DAILY + [("BBB", dt.date(2021, 5, 30), 7), ("DDD", dt.date(2021, 5, 31), 2)]
    return Inputs(
        units=_csv(tmp_path / "units.csv", Q1_UNITS), daily=_csv(tmp_path / "daily.csv", daily),
        banded=_csv(tmp_path / "banded.csv", Q2_ROWS),
        population=_csv(tmp_path / "pop.csv", [(a, 1000) for a in ("AAA", "BBB", "DDD")], header="area,population"),
    )


def test_a_killed_job_leaves_the_published_results(spark, tmp_path, feeds, monkeypatch):
    from tallycast import job

    out = scratch_path(spark, "atomic")
    run_job(spark, feeds, out, Params(ks=[2], method="exact"))
    before = published(spark, out)
    rows = sorted(spark.read.parquet(f"{before}/query1.parquet").collect())

    class Killed(BaseException):
        pass

    def killed(*_, **__):
        raise Killed

    feeds.daily = _csv(tmp_path / "more.csv", [("AAA", dt.date(2021, 1, 1), 1000), ("BBB", dt.date(2021, 1, 2), 9)])
    for name in ("write_csv", "publish"):  # between a result's table and its export, and before the pointer moves
        with monkeypatch.context() as m:
            m.setattr(job, name, killed)
            with pytest.raises(Killed):
                run_job(spark, feeds, out, Params(ks=[2], method="exact"))
        assert published(spark, out) == before
        assert sorted(spark.read.parquet(f"{before}/query1.parquet").collect()) == rows
    run_job(spark, feeds, out, Params(ks=[2], method="exact"))
    after = published(spark, out)
    assert after > before and sorted(spark.read.parquet(f"{after}/query1.parquet").collect()) != rows
    assert drop_old_versions(spark, out, keep=4) == []
    assert before in drop_old_versions(spark, out, keep=1)
    assert published(spark, out) == after
    with pytest.raises(FileNotFoundError):
        published(spark, scratch_path(spark, "nothing"))


def test_the_job_leaves_no_scratch(spark, tmp_path, feeds):
    from tallycast.session import checkpoint_dir

    root = checkpoint_dir(spark).removeprefix("file:")
    out = str(tmp_path / "out")
    before = set(os.listdir(root))
    run_job(spark, feeds, out, Params(ks=[2]))
    assert set(os.listdir(root)) <= before
    assert os.path.exists(f"{out}/CURRENT")


def test_measure_by_name_and_position_through_the_cli(spark, tmp_path, feeds):
    from tallycast.job import main

    # as Q2_ROWS, with the measure of interest last and another before it; columns out of order
    named = _csv(tmp_path / "named.csv", [(d, a, 99, b, n) for a, d, b, n in Q2_ROWS], header="DAY,AREA,male,BAND,female")
    placed = _csv(tmp_path / "placed.csv", [(d, a, 99, b, n) for a, d, b, n in Q2_ROWS])
    common = ["--units", feeds.units, "--daily", feeds.daily, "--population", feeds.population, "--ks", "2", "--method", "exact", "--speed"]
    for banded, more in (
        (named, ["--banded-header", "--banded-columns", "area=AREA,obs_date=DAY,band=BAND", "--measure", "female"]),
        (placed, ["--banded-columns", "area=1,obs_date=0,band=3", "--measure", "4"]),
    ):
        out = scratch_path(spark, "measure")
        main([*common, "--banded", banded, "--out", out, *more])
        q2 = spark.read.parquet(f"{published(spark, out)}/query2.parquet").collect()
        assert (1, "2021-04::20-29::A", 72) in {(r["rank"], r.row_key, r.forecast) for r in q2} and len(q2) == 5
        compared = spark.read.parquet(f"{published(spark, out)}/query3_comparison.parquet").collect()
        assert all(r.seconds > 0 and r.iterations >= 1 for r in compared)
    with pytest.raises(ValueError, match="no column 'femal'"):
        main([*common, "--banded", named, "--out", out, "--banded-header", "--banded-columns", "area=AREA,obs_date=DAY,band=BAND",
              "--measure", "femal"])
