"""Hand-worked pipeline cases."""

import datetime as dt

import pytest

from fixtures import (
    Q1_DAILY, Q1_EXPECTED, Q1_UNITS, Q2_EXPECTED, Q2_ROWS, Q3_DAILY, Q3_EXPECTED, Q3_POPULATION,
)
from tallycast.plans import (
    daily_mean_per_unit,
    forecast_total_share,
    history_union_forecast,
    next_month_top_k,
)
from tallycast.sources import schemas


def test_daily_mean_per_unit(spark):
    daily = spark.createDataFrame(Q1_DAILY, schemas.DAILY)
    units = spark.createDataFrame(Q1_UNITS, schemas.UNITS)
    out = {(r.area, r.month): r.mean_per_unit for r in daily_mean_per_unit(daily, units, 2021).collect()}
    assert out == Q1_EXPECTED


def test_daily_mean_as_float(spark):
    daily = spark.createDataFrame([("A", dt.date(2021, 1, 1), 1), ("A", dt.date(2021, 1, 2), 1),
                                   ("A", dt.date(2021, 1, 3), 0)], schemas.DAILY)
    units = spark.createDataFrame([("A", "x")], schemas.UNITS)
    out = daily_mean_per_unit(daily, units, 2021, as_float=True)
    assert dict(out.dtypes)["mean_per_unit"] == "float"
    assert out.first().mean_per_unit == pytest.approx(2 / 3, rel=1e-7)


def test_next_month_top_k(spark):
    rows = Q2_ROWS + [
        ("A", dt.date(2021, 1, 31), "20-29", 999),  # before the start: dropped
        ("Z", dt.date(2021, 2, 1), "20-29", 1),     # on the start: kept (February group)
    ]
    banded = spark.createDataFrame(rows, schemas.BANDED)
    out = next_month_top_k(banded, dt.date(2021, 2, 1), k=5)
    april = out.filter("next_month = date'2021-04-01'").orderBy("rank").collect()
    assert [(r.area, r.forecast, r.rank) for r in april] == Q2_EXPECTED
    march = out.filter("next_month = date'2021-03-01'").collect()
    assert [(r.area, r.forecast) for r in march] == [("Z", 0)]
    assert out.filter("next_month = date'2021-02-01'").count() == 0


def test_next_month_ties_break_by_area(spark):
    rows = [(a, dt.date(2021, 3, d), "b", 7) for a in ("Q", "P", "R") for d in (1, 2)]
    out = next_month_top_k(spark.createDataFrame(rows, schemas.BANDED), dt.date(2021, 2, 1), k=2)
    assert [(r.area, r.rank) for r in out.orderBy("rank").collect()] == [("P", 1), ("Q", 2)]


def test_next_month_december_rolls_into_next_year(spark):
    rows = [("A", dt.date(2021, 12, 1), "b", 1), ("A", dt.date(2021, 12, 2), "b", 2)]
    out = next_month_top_k(spark.createDataFrame(rows, schemas.BANDED), dt.date(2021, 2, 1)).first()
    assert out.next_month == dt.date(2022, 1, 1)
    assert out.forecast == 32  # 1 + 1 * 31


def test_forecast_total_share(spark):
    daily = spark.createDataFrame(Q3_DAILY, schemas.DAILY)
    pop = spark.createDataFrame(Q3_POPULATION, schemas.POPULATION)
    out = forecast_total_share(daily, pop, dt.date(2021, 6, 1)).collect()
    got = {r.area: (r.history, r.forecast, r.total, r.ratio) for r in out}
    assert got == Q3_EXPECTED


def test_forecast_share_origin_invariant(spark):
    daily = spark.createDataFrame(Q3_DAILY, schemas.DAILY)
    pop = spark.createDataFrame(Q3_POPULATION, schemas.POPULATION)
    a = forecast_total_share(daily, pop, dt.date(2021, 6, 1)).collect()
    b = forecast_total_share(daily, pop, dt.date(2021, 6, 1), origin=dt.date(2020, 12, 27)).collect()
    assert sorted(a) == sorted(b)


def test_history_union_forecast(spark):
    daily = spark.createDataFrame(Q3_DAILY, schemas.DAILY)
    out = history_union_forecast(daily, dt.date(2021, 6, 1))
    assert out.filter("kind = 'history'").count() == len(Q3_DAILY) - 1
    fc = {r.area: r.total for r in out.filter("kind = 'forecast'").collect()}
    assert fc == {"A": 16, "B": 0, "C": -1, "D": 0, "E": 3}
