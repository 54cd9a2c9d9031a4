"""Declared schemas of the pipeline inputs, in file column order.

Headerless CSV files bind names by position, so the DDL order is the file order.
"""

from __future__ import annotations

# One row per service unit.
UNITS = "area string, unit string"
# One row per (area, date): total count of the day.
DAILY = "area string, obs_date date, total bigint"
# Several rows per (area, date, band), one per supplier; only the measure is summed.
BANDED = "area string, obs_date date, band string, total bigint"
# One row per area.
POPULATION = "area string, population bigint"

