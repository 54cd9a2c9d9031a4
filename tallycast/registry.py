"""Registered queries: one callable ``(spark, base_dir) -> DataFrame`` per operator.

Every query reads the warehouse tables under ``base_dir`` in full; the dates,
k and cutoffs below are the pipelines' parameters, not sampling. Doubles that
come out of a regression or a floating-point sum are rounded to
``DIGITS`` places so independent engines agree; ratios of integers are exact
IEEE divisions and are left alone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.functions.dates import month_start, month_token, next_month_start, split_part
from tallycast.functions.keys import row_key
from tallycast.operators import aggregates as agg
from tallycast.operators import cluster, filters, rank
from tallycast.plans import (
    daily_mean_per_unit,
    exact_centres,
    exact_segments,
    exact_split_tree,
    forecast_total_share,
    history_and_forecast,
    history_union_forecast,
    monthly_trends,
    next_month_forecasts,
    next_month_top_k,
    share_segments,
    vector_segments,
    vector_sweep,
)
from tallycast.sinks import keyed, read_csv_dir, read_keyed, write_csv, write_keyed
from tallycast.session import scratch_path
from tallycast.sources import (
    bind_columns,
    daily_totals_table,
    embedding_features,
    population_table,
    read_bound,
    schemas,
    supplier_rows,
    table,
    units_table,
)

# Parameters of the registered runs (the test warehouse spans 1995-01-01 .. 2001-08-01).
YEAR = 1996                      # Q1: calendar year averaged
TREND_START = dt.date(1996, 2, 1)  # Q2: first day fitted; every later month is ranked
TOP_K = 5                        # Q2: areas kept per (month, band)
CUTOFF = dt.date(1999, 6, 1)     # Q3: history strictly before, forecast at the cutoff day
DIGITS = 6
COST_DIGITS = 9

Query = Callable[[SparkSession, str], DataFrame]


def _banded(spark: SparkSession, base: str) -> DataFrame:
    return supplier_rows(spark, base).select("area", "obs_date", "band", "supplier", "total")


# --- scans, filters, scalar functions -------------------------------------------------

def scan_project_rename(spark: SparkSession, base: str) -> DataFrame:
    raw = table(spark, base, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    return bind_columns(raw, "order_key bigint, cust_key bigint, obs_date date, supplier string")


def filter_year(spark: SparkSession, base: str) -> DataFrame:
    return filters.in_year(daily_totals_table(spark, base), "obs_date", YEAR)


def filter_from(spark: SparkSession, base: str) -> DataFrame:
    return filters.on_or_after(_banded(spark, base), "obs_date", TREND_START)


def filter_before(spark: SparkSession, base: str) -> DataFrame:
    return filters.before(daily_totals_table(spark, base), "obs_date", CUTOFF)


def month_tokens(spark: SparkSession, base: str) -> DataFrame:
    d = daily_totals_table(spark, base)
    return d.select(
        "area",
        "obs_date",
        month_token("obs_date").alias("month_mm"),
        split_part(F.col("obs_date").cast("string"), "-", 1).alias("month_split"),
        month_start("obs_date").alias("month"),
        next_month_start("obs_date").alias("next_month"),
    )


def leading_token_explode(spark: SparkSession, base: str) -> DataFrame:
    """Documents per comma-separated token of their whole text."""
    exploded = agg.explode_tokens(table(spark, base, "documents").select("text"), "text", sep=",")
    return agg.count_per_key(exploded, ["token"])


def text_contains(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents").select("doc_id", "lang", "text")
    return filters.text_contains(docs, "text", " the ").select("doc_id", "lang")


# --- aggregates and joins -------------------------------------------------------------

def units_per_area(spark: SparkSession, base: str) -> DataFrame:
    return agg.count_per_leading_token(units_table(spark, base), "area", name="units")


def _month_sums(spark: SparkSession, base: str) -> DataFrame:
    d = daily_totals_table(spark, base)
    return agg.sum_and_count(d.withColumn("month", month_start("obs_date")), ["area", "month"], "total")


def sum_count_by_area_month(spark: SparkSession, base: str) -> DataFrame:
    return _month_sums(spark, base)


def mean_by_area_month(spark: SparkSession, base: str) -> DataFrame:
    return agg.mean_from(_month_sums(spark, base))


def daily_totals(spark: SparkSession, base: str) -> DataFrame:
    return agg.merge_rows(_banded(spark, base), ["obs_date", "area", "band"], "total")


def join_mean_units(spark: SparkSession, base: str) -> DataFrame:
    means = agg.mean_from(_month_sums(spark, base))
    units = agg.count_per_leading_token(units_table(spark, base), "area", name="units")
    return means.join(units, "area").select(
        "area", "month", "mean", "units", (F.col("mean") / F.col("units")).alias("mean_per_unit")
    )


def join_total_population(spark: SparkSession, base: str) -> DataFrame:
    hist = agg.total_per_key(daily_totals_table(spark, base), ["area"], "total", "history")
    return hist.join(population_table(spark, base), "area").select(
        "area", "history", "population",
        (F.col("history").cast("double") / F.col("population")).alias("ratio"),
    )


# --- trend and forecast ---------------------------------------------------------------

def _trends(spark: SparkSession, base: str) -> DataFrame:
    return monthly_trends(_banded(spark, base))


def trend_by_group(spark: SparkSession, base: str) -> DataFrame:
    # a single day has no line: null slope and intercept
    return _trends(spark, base).select(
        "month", "area", "band", "n",
        F.round("slope", DIGITS).alias("slope"),
        F.round("intercept", DIGITS).alias("intercept"),
    )


def next_month_forecast(spark: SparkSession, base: str) -> DataFrame:
    return next_month_forecasts(_trends(spark, base)).select(
        "month", "area", "band", "n", "next_month", "forecast"
    )


# --- ranking --------------------------------------------------------------------------

def top_k_per_group(spark: SparkSession, base: str) -> DataFrame:
    monthly = agg.total_per_key(
        _banded(spark, base).withColumn("month", month_start("obs_date")),
        ["month", "band", "area"],
        "total",
    )
    return rank.top_k(monthly, ["month", "band"], [F.col("total").desc(), F.col("area").asc()], TOP_K)


def _q2(spark: SparkSession, base: str) -> DataFrame:
    return next_month_top_k(_banded(spark, base), TREND_START, k=TOP_K)


def _all_months(spark: SparkSession, base: str) -> DataFrame:
    return next_month_top_k(_banded(spark, base), k=TOP_K)


def top_k_nested(spark: SparkSession, base: str) -> DataFrame:
    nested = rank.nest_ranked(_all_months(spark, base), ["next_month", "band"], ["area", "forecast"])
    return nested.select(
        "next_month",
        "band",
        F.array_join(
            F.transform("ranking", lambda s: F.concat_ws(":", s["area"], s["forecast"].cast("string"))),
            ",",
        ).alias("ranking"),
    )


def ordered_ranking(spark: SparkSession, base: str) -> DataFrame:
    order = [F.col("next_month").desc(), F.col("band").desc(), F.col("rank").asc()]
    return rank.with_position(_all_months(spark, base), order)


# --- history and forecast -------------------------------------------------------------

def history_union(spark: SparkSession, base: str) -> DataFrame:
    return history_union_forecast(daily_totals_table(spark, base), CUTOFF)


def total_with_forecast(spark: SparkSession, base: str) -> DataFrame:
    hf = history_and_forecast(daily_totals_table(spark, base), CUTOFF)
    return hf.select("area", "history", "forecast", (F.col("history") + F.col("forecast")).alias("total"))


# --- export and round trip ------------------------------------------------------------

def _q1(spark: SparkSession, base: str) -> DataFrame:
    return daily_mean_per_unit(daily_totals_table(spark, base), units_table(spark, base), YEAR)


def composite_key_export(spark: SparkSession, base: str) -> DataFrame:
    return _q1(spark, base).select(
        row_key("area", month_token("month")).alias("row_key"), "mean_per_unit"
    )


def csv_round_trip(spark: SparkSession, base: str) -> DataFrame:
    path = scratch_path(spark, "csv_round_trip")
    write_csv(daily_totals_table(spark, base), path, header=False)
    return read_csv_dir(spark, path, schemas.DAILY, header=False)


def units_round_trip(spark: SparkSession, base: str) -> DataFrame:
    """The unit rows through a headered CSV folder."""
    path = scratch_path(spark, "units_round_trip")
    write_csv(units_table(spark, base), path, header=True)
    return read_csv_dir(spark, path, schemas.UNITS, header=True)


def population_round_trip(spark: SparkSession, base: str) -> DataFrame:
    """The population rows through a headered CSV folder."""
    path = scratch_path(spark, "population_round_trip")
    write_csv(population_table(spark, base), path, header=True)
    return read_csv_dir(spark, path, schemas.POPULATION, header=True)


def bound_measure_round_trip(spark: SparkSession, base: str) -> DataFrame:
    """Banded rows with two measures through a headered CSV folder, the second bound by its name."""
    path = scratch_path(spark, "bound_measure")
    rows = agg.merge_rows(_banded(spark, base), ["obs_date", "area", "band"], "total")
    write_csv(rows.select("area", "obs_date", "band", "total", (F.col("total") * 3).alias("tripled")), path, header=True)
    return read_bound(spark, path, schemas.BANDED, {"total": "tripled"}, header=True)


def keyed_round_trip(spark: SparkSession, base: str) -> DataFrame:
    """Q1 as a keyed table, checked for unique keys, and read back (K4, K5)."""
    path = scratch_path(spark, "keyed_round_trip")
    rows = _q1(spark, base).withColumn("token", month_token("month"))
    write_keyed(keyed(rows, ["area", "token"], ["mean_per_unit"]), path)
    return read_keyed(spark, path)


# --- clustering -----------------------------------------------------------------------

def wssse_of_assignment(spark: SparkSession, base: str) -> DataFrame:
    costs = cluster.label_cost(embedding_features(spark, base), "embedding", "label")
    return costs.select("label", "n", F.round("wssse", DIGITS).alias("wssse"))


def _shares(spark: SparkSession, base: str) -> DataFrame:
    return forecast_total_share(daily_totals_table(spark, base), population_table(spark, base), CUTOFF)


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, COST_DIGITS) for c in cols})


def kmeans_sweep(spark: SparkSession, base: str) -> DataFrame:
    return _rounded(exact_segments(_shares(spark, base), algorithms=["kmeans"]), "cost", "wssse")


def bisecting_sweep(spark: SparkSession, base: str) -> DataFrame:
    return _rounded(exact_segments(_shares(spark, base), algorithms=["bisecting"]), "cost", "wssse")


def cluster_comparison(spark: SparkSession, base: str) -> DataFrame:
    return _rounded(cluster.compare(exact_segments(_shares(spark, base))), "cost", "wssse")


def q3_cluster_sweep(spark: SparkSession, base: str) -> DataFrame:
    sweep = _rounded(exact_segments(_shares(spark, base)), "cost", "wssse")
    return sweep.select(
        row_key("algorithm", "k", "area").alias("row_key"),
        "cost", "wssse", "ratio", "cluster",
    )


def q3_centres(spark: SparkSession, base: str) -> DataFrame:
    return _rounded(exact_centres(_shares(spark, base)), "centre", "cost")


def q3_split_tree(spark: SparkSession, base: str) -> DataFrame:
    return _rounded(exact_split_tree(_shares(spark, base)), "centre", "cost")


def iterative_sweep(spark: SparkSession, base: str) -> DataFrame:
    """The Q3 sweep with the library's iterative k-means and bisecting k-means."""
    sweep = share_segments(_shares(spark, base))
    return sweep.select(
        row_key("algorithm", "k", "area").alias("row_key"),
        "cost", "wssse", "ratio", "cluster",
    )


def iterative_against_exact(spark: SparkSession, base: str) -> DataFrame:
    """Per model of the iterative sweep: whether its cost is at least the optimum for k, and is that of its own assignment."""
    shares = _shares(spark, base)
    sweep = share_segments(shares)
    per_cluster = sweep.groupBy("algorithm", "k", "cluster").agg(
        F.first("cost").alias("cost"), F.count(F.lit(1)).alias("n"), F.var_pop("ratio").alias("var")
    )
    found = per_cluster.groupBy("algorithm", "k").agg(
        F.first("cost").alias("cost"), F.sum(F.col("n") * F.col("var")).alias("recomputed"), F.sum("n").alias("rows")
    )
    best = exact_centres(shares, algorithms=["kmeans"]).groupBy(F.col("k").alias("of")).agg(F.sum("cost").alias("optimum"))
    return found.join(best, F.col("k") == F.col("of")).select(
        "algorithm", "k", "rows", F.round("optimum", COST_DIGITS).alias("optimum"),
        (F.col("recomputed") >= F.col("optimum") * (1 - 1e-9)).alias("not_below_optimum"),
        (F.abs(F.col("cost") - F.col("recomputed")) <= 0.05 * F.col("recomputed") + 1e-12).alias("near_own_cost"),
    )


def embedding_cluster_sweep(spark: SparkSession, base: str) -> DataFrame:
    return vector_segments(embedding_features(spark, base), "vec_id", "embedding")


def embedding_nearest_centre(spark: SparkSession, base: str) -> DataFrame:
    """Per vector and k-means model: whether no other centre of the model's centre table is nearer than its own."""
    points = embedding_features(spark, base)
    sweep = vector_sweep(points, "vec_id", "embedding", algorithms=["kmeans"])
    assigned = sweep.assigned("vec_id", "features").withColumn("v", vector_to_array("features"))
    found = cluster.nearest_centre(assigned.drop("features"), sweep.centres(), "v")
    return found.select("algorithm", "k", "vec_id", (F.col("own") <= F.col("least") * (1 + 1e-9)).alias("nearest"))


def embedding_split_trees(spark: SparkSession, base: str) -> DataFrame:
    """Per bisecting model over the embeddings: leaves, rows in them, and whether every split's sizes add up."""
    sweep = vector_sweep(embedding_features(spark, base), "vec_id", "embedding", algorithms=["bisecting"])
    tree = sweep.split_trees()
    halves = tree.groupBy("k", F.col("parent").alias("of")).agg(F.sum("size").alias("below"))
    tree = tree.join(halves.withColumnRenamed("k", "k2"), (F.col("k") == F.col("k2")) & (F.col("node") == F.col("of")), "left")
    return tree.groupBy("k").agg(
        F.count_if("leaf").alias("leaves"), F.sum(F.when(F.col("leaf"), F.col("size"))).alias("rows"),
        F.bool_and(F.col("leaf") | (F.col("below") == F.col("size"))).alias("adds_up"),
    )


def cluster_speed(spark: SparkSession, base: str) -> DataFrame:
    """Training time and iterations per (algorithm, k) over the embeddings, one fit after the other."""
    points = embedding_features(spark, base)
    return cluster.timed_fits(cluster.vectorize_array(points, "embedding"))


def sweep_share_rows(spark: SparkSession, base: str) -> DataFrame:
    """Keys and ratios of the Q3 sweep: every share once per model."""
    return q3_cluster_sweep(spark, base).select("row_key", "ratio")


def sweep_sum_of_squares(spark: SparkSession, base: str) -> DataFrame:
    """Per model of the embedding sweep: rows, and squares within plus between its clusters."""
    sweep = vector_sweep(embedding_features(spark, base), "vec_id", "embedding")
    keys = ["algorithm", "k"]
    per = sweep.assigned("features").groupBy(*keys, "cluster").agg(
        Summarizer.metrics("count", "mean", "variance").summary(F.col("features")).alias("s")
    )
    dims = per.select(  # k rows per model times the vector's width
        *keys, F.col("s.count").alias("n"),
        F.posexplode(F.arrays_zip(vector_to_array("s.mean").alias("mean"), vector_to_array("s.variance").alias("var"))).alias("i", "d"),
    )
    n, mean = F.col("n"), F.col("d.mean")
    over = dims.groupBy(*keys, "i").agg(
        F.sum("n").alias("rows"), F.sum((n - 1) * F.col("d.var")).alias("within"),
        (F.sum(n * mean * mean) - F.sum(n * mean) * F.sum(n * mean) / F.sum("n")).alias("between"),
    )
    return over.groupBy(*keys).agg(
        F.max("rows").alias("rows"), F.round(F.sum(F.col("within") + F.col("between")), 3).alias("total_ss")
    )


def sweep_cost_check(spark: SparkSession, base: str) -> DataFrame:
    """Per model: rows, and whether the recomputed WSSSE is at most the training cost (that of the step before, if max_iter ends it)."""
    c = cluster.compare(embedding_cluster_sweep(spark, base))
    return c.select("algorithm", "k", "rows", (F.col("wssse") <= F.col("cost") * (1 + 1e-6)).alias("not_above"))


# --- the pipelines --------------------------------------------------------------------

def q1_daily_mean_per_unit(spark: SparkSession, base: str) -> DataFrame:
    return _q1(spark, base)


def q2_next_month_top_k(spark: SparkSession, base: str) -> DataFrame:
    return _q2(spark, base)


def q3_forecast_share(spark: SparkSession, base: str) -> DataFrame:
    return _shares(spark, base)


QUERIES: dict[str, Query] = {
    "scan_project_rename": scan_project_rename,
    "filter_year": filter_year,
    "filter_from": filter_from,
    "filter_before": filter_before,
    "month_token": month_tokens,
    "leading_token_explode": leading_token_explode,
    "text_contains": text_contains,
    "units_per_area": units_per_area,
    "sum_count_by_area_month": sum_count_by_area_month,
    "mean_by_area_month": mean_by_area_month,
    "daily_totals": daily_totals,
    "join_mean_units": join_mean_units,
    "join_total_population": join_total_population,
    "trend_by_group": trend_by_group,
    "next_month_forecast": next_month_forecast,
    "top_k_per_group": top_k_per_group,
    "top_k_nested": top_k_nested,
    "ordered_ranking": ordered_ranking,
    "history_union_forecast": history_union,
    "total_with_forecast": total_with_forecast,
    "composite_key_export": composite_key_export,
    "csv_round_trip": csv_round_trip,
    "units_round_trip": units_round_trip,
    "population_round_trip": population_round_trip,
    "bound_measure_round_trip": bound_measure_round_trip,
    "keyed_round_trip": keyed_round_trip,
    "wssse_of_assignment": wssse_of_assignment,
    "kmeans_sweep": kmeans_sweep,
    "bisecting_sweep": bisecting_sweep,
    "cluster_comparison": cluster_comparison,
    "q3_cluster_sweep": q3_cluster_sweep,
    "q3_centres": q3_centres,
    "q3_split_tree": q3_split_tree,
    "iterative_sweep": iterative_sweep,
    "iterative_against_exact": iterative_against_exact,
    "embedding_cluster_sweep": embedding_cluster_sweep,
    "embedding_nearest_centre": embedding_nearest_centre,
    "embedding_split_trees": embedding_split_trees,
    "cluster_speed": cluster_speed,
    "sweep_share_rows": sweep_share_rows,
    "sweep_sum_of_squares": sweep_sum_of_squares,
    "sweep_cost_check": sweep_cost_check,
    "q1_daily_mean_per_unit": q1_daily_mean_per_unit,
    "q2_next_month_top_k": q2_next_month_top_k,
    "q3_forecast_share": q3_forecast_share,
}
