"""The batch job: read the four feeds, run Q1, Q2, Q3 and write keyed results
(plus the per-k comparison of the two clustering algorithms).

Each result is computed once into a keyed parquet table of a new version folder; its
keys are checked for uniqueness and the headerless CSV export (the original format, composite
``row_key``) is written from that table. When all results stand, the pointer ``CURRENT`` is
replaced (``sinks.publish``): readers see the old results or the new ones, never a mixture. Everything
is lazy until the writes; the clustering step trains its models when Q3 is built.
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.functions.keys import row_key
from tallycast.operators.cluster import (
    ALGORITHMS, DEFAULT_KS, DEFAULT_MAX_ITER, DEFAULT_RESTARTS, compare, timed_fits, vectorize,
)
from tallycast.plans import daily_mean_per_unit, exact_segments, forecast_total_share, next_month_top_k, share_segments
from tallycast.session import scratch_scope
from tallycast.sinks import drop_old_versions, duplicate_keys, new_version, publish, write_csv
from tallycast.sources import read_bound, read_csv, schemas


@dataclass
class Inputs:
    """Paths of the feeds (headerless CSV unless noted)."""

    units: str
    daily: str
    banded: str
    population: str
    population_header: bool = True
    banded_header: bool = False
    banded_bind: dict[str, str | int] = field(default_factory=dict)  # column of the feed -> header name or position


@dataclass
class Params:
    year: int = 2021
    trend_start: dt.date = dt.date(2021, 2, 1)
    trend_end: dt.date | None = None
    top_k: int = 5
    cutoff: dt.date = dt.date(2021, 6, 1)
    ks: Sequence[int] = field(default_factory=lambda: list(DEFAULT_KS))
    algorithms: Sequence[str] = ALGORITHMS
    as_float: bool = True
    month_pattern: str = "yyyy-MM"
    published_format: bool = False  # Q2 as published: unpadded month, key and forecast only, keys descending
    measure: str | int | None = None  # Q2: header name or position of the summed column; None: the fourth
    method: str = "iterative"  # Q3: the library's iterative algorithms, or "exact" (one-dimensional optimum)
    speed: bool = False  # Q3 comparison: also seconds and iterations of sequential fits
    max_iter: int = DEFAULT_MAX_ITER
    seed: int | None = None
    restarts: int = DEFAULT_RESTARTS


def query1(spark: SparkSession, inputs: Inputs, p: Params) -> DataFrame:
    """(row_key 'area::MM', avg) -- mean daily count per unit."""
    daily = read_csv(spark, inputs.daily, schemas.DAILY)
    units = read_csv(spark, inputs.units, schemas.UNITS)
    q1 = daily_mean_per_unit(daily, units, p.year, as_float=p.as_float)
    return q1.select(row_key("area", F.date_format("month", "MM")).alias("row_key"),
                     F.col("mean_per_unit").alias("avg"))


def query2(spark: SparkSession, inputs: Inputs, p: Params) -> DataFrame:
    """(row_key 'month::band::area', forecast, rank) -- next-month top k."""
    bind = dict(inputs.banded_bind) if p.measure is None else {**inputs.banded_bind, "total": p.measure}
    if bind or inputs.banded_header:
        banded = read_bound(spark, inputs.banded, schemas.BANDED, bind, header=inputs.banded_header)
    else:
        banded = read_csv(spark, inputs.banded, schemas.BANDED)
    q2 = next_month_top_k(banded, p.trend_start, p.trend_end, k=p.top_k)
    pattern = "M" if p.published_format else p.month_pattern
    key = row_key(F.date_format("next_month", pattern), "band", "area").alias("row_key")
    return q2.select(key, "forecast") if p.published_format else q2.select(key, "forecast", "rank")


def query3(spark: SparkSession, inputs: Inputs, p: Params) -> tuple[DataFrame, DataFrame]:
    """Share and segments: (row_key 'algorithm::k::area', cost, wssse, ratio, cluster),
    and the per-model comparison (row_key 'algorithm::k', cost, wssse, clusters_used, rows, rank_in_k)."""
    daily = read_csv(spark, inputs.daily, schemas.DAILY)
    population = read_csv(spark, inputs.population, schemas.POPULATION, header=inputs.population_header)
    shares = forecast_total_share(daily, population, p.cutoff)
    if p.method == "exact":
        sweep = exact_segments(shares, ks=p.ks, algorithms=p.algorithms)
    elif p.method == "iterative":
        sweep = share_segments(
            shares, ks=p.ks, algorithms=p.algorithms, max_iter=p.max_iter, seed=p.seed, restarts=p.restarts
        )
    else:
        raise ValueError(f"method must be iterative or exact, got {p.method!r}")
    speed = timed_fits(vectorize(shares, ["ratio"]), p.ks, p.algorithms, p.max_iter, p.seed) if p.speed else None
    rows = sweep.select(
        row_key("algorithm", "k", "area").alias("row_key"), "cost", "wssse", "ratio", "cluster"
    )
    comparison = compare(sweep, speed).select(
        row_key("algorithm", "k").alias("row_key"), "cost", "wssse", "clusters_used", "rows", "rank_in_k",
        *(["seconds", "iterations"] if p.speed else []),
    )
    return rows, comparison


def _save(df: DataFrame, version: str, name: str, order: Column | None = None) -> None:
    """Compute the result once into the version's keyed parquet table, check its keys and export it as CSV."""
    path = f"{version}/{name}.parquet"
    df.write.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    if duplicate_keys(written).limit(1).count() > 0:
        raise ValueError(f"{name}: duplicate row keys; the published results are unchanged")
    write_csv(written.orderBy(order) if order is not None else written, f"{version}/{name}", header=False)


def run_job(spark: SparkSession, inputs: Inputs, out: str, params: Params | None = None) -> str:
    """Run Q1, Q2 and Q3 in sequence, publish their results under ``out``; returns the published version's folder.

    Read them through ``sinks.published(spark, out)``. Scratch tables and checkpoints of the run are deleted.
    """
    p = params or Params()
    version = new_version(out)
    with scratch_scope(spark):
        _save(query1(spark, inputs, p), version, "query1")
        # keys begin with month and band, so one order serves both
        _save(query2(spark, inputs, p), version, "query2", F.col("row_key").desc() if p.published_format else None)
        rows, comparison = query3(spark, inputs, p)
        _save(rows, version, "query3")
        _save(comparison, version, "query3_comparison")
    publish(spark, version)
    return version


def _binding(text: str) -> dict[str, str | int]:
    """``area=AREA,band=2`` -> {"area": "AREA", "band": 2}."""
    pairs = [part.split("=", 1) for part in text.split(",") if part]
    if any(len(x) != 2 for x in pairs):
        raise argparse.ArgumentTypeError("expected column=header or column=position, separated by commas")
    return {a.strip(): _place(b.strip()) for a, b in pairs}


def _place(text: str) -> str | int:
    return int(text) if text.isdigit() else text


def main(argv: Sequence[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="tallycast", description=__doc__)
    ap.add_argument("--units", required=True)
    ap.add_argument("--daily", required=True)
    ap.add_argument("--banded", required=True)
    ap.add_argument("--population", required=True)
    ap.add_argument("--population-no-header", action="store_true")
    ap.add_argument("--out", required=True)
    ap.add_argument("--year", type=int, default=2021)
    ap.add_argument("--trend-start", type=dt.date.fromisoformat, default=dt.date(2021, 2, 1))
    ap.add_argument("--trend-end", type=dt.date.fromisoformat, default=None)
    ap.add_argument("--cutoff", type=dt.date.fromisoformat, default=dt.date(2021, 6, 1))
    ap.add_argument("--top-k", type=int, default=5)
    ap.add_argument("--month-pattern", default="yyyy-MM")
    ap.add_argument("--published-format", action="store_true")
    ap.add_argument("--measure", type=_place, default=None, help="header name or position (from 0) of Q2's measure")
    ap.add_argument("--banded-header", action="store_true")
    ap.add_argument("--banded-columns", type=_binding, default={}, help="column=header or column=position, ...")
    ap.add_argument("--method", choices=["iterative", "exact"], default="iterative")
    ap.add_argument("--speed", action="store_true")
    ap.add_argument("--keep-versions", type=int, default=2)
    ap.add_argument("--algorithms", type=lambda s: s.split(","), default=list(ALGORITHMS))
    ap.add_argument("--max-iter", type=int, default=DEFAULT_MAX_ITER)
    ap.add_argument("--seed", type=int, default=None)
    ap.add_argument("--restarts", type=int, default=DEFAULT_RESTARTS)
    ap.add_argument("--ks", type=lambda s: [int(x) for x in s.split(",")], default=list(DEFAULT_KS))
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("tallycast").getOrCreate()
    inputs = Inputs(args.units, args.daily, args.banded, args.population, not args.population_no_header,
                    args.banded_header, args.banded_columns)
    params = Params(year=args.year, trend_start=args.trend_start, trend_end=args.trend_end,
                    top_k=args.top_k, cutoff=args.cutoff, ks=args.ks, algorithms=args.algorithms,
                    month_pattern=args.month_pattern, published_format=args.published_format,
                    measure=args.measure, method=args.method, speed=args.speed,
                    max_iter=args.max_iter, seed=args.seed, restarts=args.restarts)
    run_job(spark, inputs, args.out, params)
    drop_old_versions(spark, args.out, args.keep_versions)
