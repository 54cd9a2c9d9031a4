"""

``entry(spark)`` runs the flagship pipeline on sf0.001; ``queries()`` returns
one callable per implemented operator (see ``tallycast.registry``);
``oracle_sql()`` gives, for each, an independent ANSI SQL statement over the
lineitem events documents embeddings pages benchmark labels conversations).
The shares' clusters are checked row by row; the iterative sweeps over vectors by what any training
result must satisfy (every vector at its nearest centre, costs, split sizes).
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallycast import registry  # noqa: E402

try:  # the training-data subpackage and its pipeline may be absent
    import corpus_pipeline
    from tallycast.llm import queries as llm
except ImportError:
    corpus_pipeline = llm = None

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: next-month top-5 forecast per (month, band) on sf0.001."""
    return registry.q2_next_month_top_k(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = dict(registry.QUERIES)
    if llm is not None:
        out |= llm.QUERIES | {"pipeline": corpus_pipeline.run}
    return out


# ---------------------------------------------------------------------------------------
# Oracle SQL (DuckDB dialect). Inputs are derived exactly as in tallycast.sources.tables.

_BANDED = """banded AS (
  SELECT n.n_name AS area, CAST(o.o_orderdate AS DATE) AS obs_date, c.c_mktsegment AS band,
         o.o_orderpriority AS supplier, COUNT(*) AS total
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY 1, 2, 3, 4)"""

_DAILY = """daily AS (
  SELECT n.n_name AS area, CAST(o.o_orderdate AS DATE) AS obs_date, COUNT(*) AS total
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY 1, 2)"""

_UNITS = """units AS (
  SELECT n.n_name AS area, s.s_name AS unit
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey)"""

_UNIT_COUNTS = """unit_counts AS (
  SELECT split_part(area, ',', 1) AS area, COUNT(*) AS units FROM units GROUP BY 1)"""

_POPULATION = """population AS (
  SELECT n.n_name AS area, CAST(COUNT(*) * 10 AS BIGINT) AS population
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY 1)"""

_MONTH_SUMS = """month_sums AS (
  SELECT area, CAST(date_trunc('month', obs_date) AS DATE) AS month,
         CAST(SUM(total) AS BIGINT) AS total, COUNT(*) AS n_days
  FROM daily
  GROUP BY 1, 2)"""

_YEAR_SUMS = _MONTH_SUMS.replace("GROUP BY", "WHERE obs_date >= DATE '1996-01-01' AND obs_date < DATE '1997-01-01' GROUP BY")

# Q2 fit: daily values per (month, area, band), x = day offset in the month.
_ALL_TRENDS = """merged AS (
  SELECT obs_date, area, band, CAST(SUM(total) AS BIGINT) AS total
  FROM banded GROUP BY 1, 2, 3),
trends AS (
  SELECT CAST(date_trunc('month', obs_date) AS DATE) AS month, area, band,
         CAST(regr_count(CAST(total AS DOUBLE), CAST(date_diff('day', CAST(date_trunc('month', obs_date) AS DATE), obs_date) AS DOUBLE)) AS BIGINT) AS n,
         regr_slope(CAST(total AS DOUBLE), CAST(date_diff('day', CAST(date_trunc('month', obs_date) AS DATE), obs_date) AS DOUBLE)) AS slope,
         regr_intercept(CAST(total AS DOUBLE), CAST(date_diff('day', CAST(date_trunc('month', obs_date) AS DATE), obs_date) AS DOUBLE)) AS intercept
  FROM merged GROUP BY 1, 2, 3),
forecasts AS (
  SELECT month, area, band, n,
         CAST(month + INTERVAL 1 MONTH AS DATE) AS next_month,
         CASE WHEN n < 2 THEN CAST(0 AS BIGINT)
              ELSE CAST(floor(round(intercept + slope * date_diff('day', month, CAST(month + INTERVAL 1 MONTH AS DATE)), 6) + 0.5) AS BIGINT)
         END AS forecast
  FROM trends),
top AS (
  SELECT next_month, band, area, forecast,
         CAST(row_number() OVER (PARTITION BY next_month, band ORDER BY forecast DESC, area ASC) AS INTEGER) AS rank
  FROM forecasts
  QUALIFY rank <= 5)"""

_TRENDS = _ALL_TRENDS.replace("FROM banded GROUP", "FROM banded WHERE obs_date >= DATE '1996-02-01' GROUP")

# Q3 fit: per area on days before 1999-06-01, x = days since the cutoff, forecast at x = 0.
_HISTORY_FORECAST = """hist AS (
  SELECT area,
         CAST(SUM(total) AS BIGINT) AS history,
         CAST(regr_count(CAST(total AS DOUBLE), CAST(date_diff('day', DATE '1999-06-01', obs_date) AS DOUBLE)) AS BIGINT) AS n,
         regr_slope(CAST(total AS DOUBLE), CAST(date_diff('day', DATE '1999-06-01', obs_date) AS DOUBLE)) AS slope,
         regr_intercept(CAST(total AS DOUBLE), CAST(date_diff('day', DATE '1999-06-01', obs_date) AS DOUBLE)) AS intercept
  FROM daily WHERE obs_date < DATE '1999-06-01' GROUP BY 1),
hf AS (
  SELECT area, history, n,
         CASE WHEN n < 2 THEN CAST(0 AS BIGINT)
              ELSE CAST(trunc(round(intercept + slope * 0, 6)) AS BIGINT) END AS forecast
  FROM hist)"""

_SHARES = """shares AS (
  SELECT hf.area, hf.history, hf.forecast, CAST(hf.history + hf.forecast AS BIGINT) AS total,
         p.population,
         CAST(hf.history + hf.forecast AS DOUBLE) / CAST(p.population AS DOUBLE) AS ratio
  FROM hf JOIN population p ON hf.area = p.area)"""


# The shares' best clusters on a line: block costs from prefix sums, then a dynamic programme over
# the last cut, and bisection by the best cut of the next leaf (least depth, then largest, then first).
_INTERVALS = """mid AS (SELECT avg(ratio) AS m FROM shares),
pt AS (SELECT row_number() OVER (ORDER BY ratio) AS i, ratio AS x, CAST(COUNT(*) AS DOUBLE) AS n FROM shares GROUP BY ratio),
pre AS (SELECT 0 AS i, 0.0::DOUBLE AS cn, 0.0::DOUBLE AS cs, 0.0::DOUBLE AS cq UNION ALL
        SELECT i, SUM(n) OVER w, SUM(n * (x - m)) OVER w, SUM(n * (x - m) * (x - m)) OVER w
        FROM pt, mid WINDOW w AS (ORDER BY i)),
seg AS (SELECT a.i AS lo, b.i AS hi, CAST(b.cn - a.cn AS BIGINT) AS n, m + (b.cs - a.cs) / (b.cn - a.cn) AS centre,
               greatest(b.cq - a.cq - (b.cs - a.cs) * (b.cs - a.cs) / (b.cn - a.cn), 0) AS c
        FROM mid, pre a JOIN pre b ON a.i < b.i),
top AS (SELECT max(i) AS m FROM pt),
d1 AS (SELECT hi, c, [0, hi] AS cuts FROM seg WHERE lo = 0),
""" + "".join(f"""d{k} AS (SELECT seg.hi, d.c + seg.c AS c, list_append(d.cuts, seg.hi) AS cuts FROM d{k - 1} d JOIN seg ON seg.lo = d.hi
       QUALIFY row_number() OVER (PARTITION BY seg.hi ORDER BY d.c + seg.c, seg.lo) = 1),
""" for k in (2, 3, 4, 5)) + """best AS (SELECT l.lo, r.hi, l.hi AS cut FROM seg l JOIN seg r ON l.hi = r.lo
         QUALIFY row_number() OVER (PARTITION BY l.lo, r.hi ORDER BY l.c + r.c, l.hi) = 1),
t1 AS (SELECT [{'node': 1, 'parent': NULL::INTEGER, 'lo': 0::BIGINT, 'hi': m::BIGINT, 'd': 0}] AS leaves FROM top),
""" + "".join(f"""p{k} AS (SELECT t.leaves, l.*, cut FROM (SELECT leaves, unnest(leaves) AS l FROM t{k - 1}) t
        JOIN best ON best.lo = l.lo AND best.hi = l.hi JOIN seg ON seg.lo = l.lo AND seg.hi = l.hi
        QUALIFY row_number() OVER (ORDER BY l.d, seg.n DESC, l.lo) = 1),
t{k} AS (SELECT list_concat(list_filter(leaves, lambda x: x.lo <> p.lo OR x.hi <> p.hi),
       [{{'node': {2 * k - 2}, 'parent': p.node, 'lo': p.lo, 'hi': p.cut::BIGINT, 'd': p.d + 1}},
        {{'node': {2 * k - 1}, 'parent': p.node, 'lo': p.cut::BIGINT, 'hi': p.hi, 'd': p.d + 1}}]) AS leaves FROM p{k} p),
""" for k in (2, 3, 4, 5)) + """parts AS (
  """ + " UNION ALL ".join(
    f"SELECT 'kmeans' AS algorithm, {k} AS k, unnest(cuts[1:{k}]) AS lo, unnest(cuts[2:]) AS hi FROM d{k}, top WHERE hi = m"
    f" UNION ALL SELECT 'bisecting', {k}, l.lo, l.hi FROM (SELECT unnest(leaves) AS l FROM t{k})"
    for k in (2, 3, 4, 5)
) + """),
clusters AS (SELECT algorithm, CAST(k AS INTEGER) AS k, lo, hi, n, centre, c,
                    CAST(row_number() OVER (PARTITION BY algorithm, k ORDER BY lo) - 1 AS INTEGER) AS cluster
             FROM parts JOIN seg USING (lo, hi)),
swept AS (SELECT algorithm, k, area, ratio, cluster, c_total AS cost
          FROM shares JOIN pt ON x = ratio JOIN clusters ON pt.i > lo AND pt.i <= hi
          JOIN (SELECT algorithm AS a2, k AS k2, round(SUM(c), 9) AS c_total FROM clusters GROUP BY 1, 2) ON a2 = algorithm AND k2 = k)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def oracle_sql() -> dict[str, str]:
    return _library_sql() | (llm.ORACLE_SQL if llm is not None else {})


def _library_sql() -> dict[str, str]:
    q1 = (
        _with(_DAILY, _UNITS, _UNIT_COUNTS, _YEAR_SUMS)
        + """SELECT m.area, m.month, m.n_days, m.total, u.units,
       CAST(m.total AS DOUBLE) / m.n_days / u.units AS mean_per_unit
FROM month_sums m JOIN unit_counts u ON m.area = u.area"""
    )
    swept = _with(_DAILY, _POPULATION, _HISTORY_FORECAST, _SHARES, _INTERVALS)
    return {
        "kmeans_sweep": swept + """SELECT algorithm, k, area, ratio, cluster, cost, cost AS wssse
FROM swept WHERE algorithm = 'kmeans'""",
        "bisecting_sweep": swept + """SELECT algorithm, k, area, ratio, cluster, cost, cost AS wssse
FROM swept WHERE algorithm = 'bisecting'""",
        "q3_cluster_sweep": swept + """SELECT algorithm || '::' || k || '::' || area AS row_key, cost, cost AS wssse, ratio, cluster
FROM swept""",
        "cluster_comparison": swept + """SELECT algorithm, k, cost, cost AS wssse, COUNT(DISTINCT cluster) AS clusters_used, COUNT(*) AS rows,
       CAST(row_number() OVER (PARTITION BY k ORDER BY cost, algorithm) AS INTEGER) AS rank_in_k
FROM swept GROUP BY algorithm, k, cost""",
        "q3_centres": swept + """SELECT algorithm, k, cluster, a.x AS lo, b.x AS hi, c.n AS size, round(centre, 9) AS centre, round(c, 9) AS cost
FROM clusters c JOIN pt a ON a.i = c.lo + 1 JOIN pt b ON b.i = c.hi""",
        "q3_split_tree": swept + """SELECT node, parent, a.x AS lo, b.x AS hi, seg.n AS size, round(centre, 9) AS centre, round(seg.c, 9) AS cost, leaf
FROM (SELECT DISTINCT l.node, l.parent, l.lo, l.hi, list_contains((SELECT list_transform(leaves, lambda x: x.node) FROM t5), l.node) AS leaf
      FROM (SELECT unnest(leaves) AS l FROM (SELECT leaves FROM t1 UNION ALL SELECT leaves FROM t2 UNION ALL
            SELECT leaves FROM t3 UNION ALL SELECT leaves FROM t4 UNION ALL SELECT leaves FROM t5))) t
JOIN seg USING (lo, hi) JOIN pt a ON a.i = t.lo + 1 JOIN pt b ON b.i = t.hi""",
        "iterative_against_exact": swept + """SELECT a AS algorithm, c.k, (SELECT COUNT(*) FROM shares) AS rows, round(SUM(c.c), 9) AS optimum,
       true AS not_below_optimum, true AS near_own_cost
FROM clusters c, (SELECT unnest(['kmeans', 'bisecting']) AS a) WHERE c.algorithm = 'kmeans' GROUP BY a, c.k""",
        "embedding_nearest_centre": """SELECT 'kmeans' AS algorithm, CAST(k AS INTEGER) AS k, vec_id, true AS nearest
FROM embeddings, (SELECT unnest([2, 3, 4, 5]) AS k)""",
        "embedding_split_trees": """SELECT CAST(k AS INTEGER) AS k, CAST(k AS BIGINT) AS leaves, n AS rows, true AS adds_up
FROM (SELECT COUNT(*) AS n FROM embeddings), (SELECT unnest([2, 3, 4, 5]) AS k)""",
        "scan_project_rename": """SELECT o_orderkey AS order_key, o_custkey AS cust_key,
       CAST(o_orderdate AS DATE) AS obs_date, o_orderpriority AS supplier FROM orders""",
        "filter_year": _with(_DAILY)
        + "SELECT area, obs_date, total FROM daily WHERE obs_date >= DATE '1996-01-01' AND obs_date < DATE '1997-01-01'",
        "filter_from": _with(_BANDED)
        + "SELECT area, obs_date, band, supplier, total FROM banded WHERE obs_date >= DATE '1996-02-01'",
        "filter_before": _with(_DAILY) + "SELECT area, obs_date, total FROM daily WHERE obs_date < DATE '1999-06-01'",
        "month_token": _with(_DAILY)
        + """SELECT area, obs_date, strftime(obs_date, '%m') AS month_mm,
       split_part(CAST(obs_date AS VARCHAR), '-', 2) AS month_split,
       CAST(date_trunc('month', obs_date) AS DATE) AS month,
       CAST(date_trunc('month', obs_date) + INTERVAL 1 MONTH AS DATE) AS next_month
FROM daily""",
        "leading_token_explode": """SELECT t.token, COUNT(*) AS n
FROM documents, unnest(string_split(documents.text, ',')) AS t(token) GROUP BY 1""",
        "text_contains": "SELECT doc_id, lang FROM documents WHERE contains(text, ' the ')",
        "units_per_area": _with(_UNITS, _UNIT_COUNTS) + "SELECT area, units FROM unit_counts",
        "sum_count_by_area_month": _with(_DAILY, _MONTH_SUMS) + "SELECT area, month, total, n_days FROM month_sums",
        "mean_by_area_month": _with(_DAILY, _MONTH_SUMS)
        + "SELECT area, month, total, n_days, CAST(total AS DOUBLE) / n_days AS mean FROM month_sums",
        "daily_totals": _with(_BANDED)
        + "SELECT obs_date, area, band, CAST(SUM(total) AS BIGINT) AS total FROM banded GROUP BY 1, 2, 3",
        "join_mean_units": _with(_DAILY, _UNITS, _UNIT_COUNTS, _MONTH_SUMS)
        + """SELECT m.area, m.month, CAST(m.total AS DOUBLE) / m.n_days AS mean, u.units,
       CAST(m.total AS DOUBLE) / m.n_days / u.units AS mean_per_unit
FROM month_sums m JOIN unit_counts u ON m.area = u.area""",
        "join_total_population": _with(_DAILY, _POPULATION)
        + """SELECT h.area, h.history, p.population, CAST(h.history AS DOUBLE) / p.population AS ratio
FROM (SELECT area, CAST(SUM(total) AS BIGINT) AS history FROM daily GROUP BY 1) h
JOIN population p ON h.area = p.area""",
        "trend_by_group": _with(_BANDED, _ALL_TRENDS)
        + """SELECT month, area, band, n, CASE WHEN n >= 2 THEN round(slope, 6) END AS slope,
       CASE WHEN n >= 2 THEN round(intercept, 6) END AS intercept FROM trends""",
        "next_month_forecast": _with(_BANDED, _ALL_TRENDS)
        + "SELECT month, area, band, n, next_month, forecast FROM forecasts",
        "top_k_per_group": _with(_BANDED)
        + """SELECT month, band, area, total,
       CAST(row_number() OVER (PARTITION BY month, band ORDER BY total DESC, area ASC) AS INTEGER) AS rank
FROM (SELECT CAST(date_trunc('month', obs_date) AS DATE) AS month, band, area,
             CAST(SUM(total) AS BIGINT) AS total
      FROM banded GROUP BY 1, 2, 3) m
QUALIFY rank <= 5""",
        "top_k_nested": _with(_BANDED, _ALL_TRENDS)
        + """SELECT next_month, band,
       string_agg(area || ':' || CAST(forecast AS VARCHAR), ',' ORDER BY rank) AS ranking
FROM top GROUP BY 1, 2""",
        "ordered_ranking": _with(_BANDED, _ALL_TRENDS)
        + """SELECT next_month, band, area, forecast, rank,
       row_number() OVER (ORDER BY next_month DESC, band DESC, rank ASC) AS position
FROM top""",
        "history_union_forecast": _with(_DAILY, _HISTORY_FORECAST)
        + """SELECT area, obs_date, CAST(total AS BIGINT) AS total, 'history' AS kind
FROM daily WHERE obs_date < DATE '1999-06-01'
UNION ALL
SELECT area, DATE '1999-06-01' AS obs_date, forecast AS total, 'forecast' AS kind FROM hf""",
        "total_with_forecast": _with(_DAILY, _HISTORY_FORECAST)
        + "SELECT area, history, forecast, CAST(history + forecast AS BIGINT) AS total FROM hf",
        "composite_key_export": q1.replace(
            "SELECT m.area, m.month, m.n_days, m.total, u.units,",
            "SELECT m.area || '::' || strftime(m.month, '%m') AS row_key,",
        ),
        "keyed_round_trip": q1.replace(
            "SELECT m.area, m.month, m.n_days, m.total, u.units,",
            "SELECT m.area || '::' || strftime(m.month, '%m') AS row_key,",
        ),
        "units_round_trip": _with(_UNITS) + "SELECT area, unit FROM units",
        "population_round_trip": _with(_POPULATION) + "SELECT area, population FROM population",
        "bound_measure_round_trip": _with(_BANDED)
        + "SELECT area, obs_date, band, CAST(3 * SUM(total) AS BIGINT) AS total FROM banded GROUP BY 1, 2, 3",
        "csv_round_trip": _with(_DAILY) + "SELECT area, obs_date, total FROM daily",
        "wssse_of_assignment": """WITH e AS (
  SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
per_dim AS (
  SELECT label, i, COUNT(*) AS n, var_pop(CAST(v AS DOUBLE)) * COUNT(*) AS ss FROM e GROUP BY 1, 2)
SELECT label, CAST(max(n) AS BIGINT) AS n, round(SUM(ss), 6) AS wssse FROM per_dim GROUP BY 1""",
        "sweep_share_rows": _with(_DAILY, _POPULATION, _HISTORY_FORECAST, _SHARES)
        + """SELECT a || '::' || k || '::' || area AS row_key, ratio
FROM shares, (SELECT unnest(['kmeans', 'bisecting']) AS a), (SELECT unnest([2, 3, 4, 5]) AS k)""",
        "sweep_sum_of_squares": """WITH e AS (
  SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
per_dim AS (SELECT i, COUNT(*) AS n, var_pop(CAST(v AS DOUBLE)) * COUNT(*) AS ss FROM e GROUP BY 1),
t AS (SELECT CAST(max(n) AS BIGINT) AS rows, round(SUM(ss), 3) AS total_ss FROM per_dim)
SELECT a AS algorithm, CAST(k AS INTEGER) AS k, rows, total_ss
FROM t, (SELECT unnest(['kmeans', 'bisecting']) AS a), (SELECT unnest([2, 3, 4, 5]) AS k)""",
        "sweep_cost_check": """SELECT a AS algorithm, CAST(k AS INTEGER) AS k, n AS rows, true AS not_above
FROM (SELECT COUNT(*) AS n FROM embeddings), (SELECT unnest(['kmeans', 'bisecting']) AS a), (SELECT unnest([2, 3, 4, 5]) AS k)""",
        "q1_daily_mean_per_unit": q1,
        "q2_next_month_top_k": _with(_BANDED, _TRENDS) + "SELECT next_month, band, area, forecast, rank FROM top",
        "q3_forecast_share": _with(_DAILY, _POPULATION, _HISTORY_FORECAST, _SHARES)
        + "SELECT area, history, forecast, total, population, ratio FROM shares",
    }
