"""Column expressions used by the operators."""

from tallycast.functions.dates import (
    date_lit,
    day_offset,
    month_start,
    month_token,
    next_month_start,
    split_part,
    year_bounds,
)
from tallycast.functions.keys import KEY_SEPARATOR, leading_token, row_key, tokens
from tallycast.functions.numeric import GUARD_DIGITS, ratio, round_half_up, truncate_to_long

__all__ = [
    "GUARD_DIGITS",
    "KEY_SEPARATOR",
    "date_lit",
    "day_offset",
    "leading_token",
    "month_start",
    "month_token",
    "next_month_start",
    "ratio",
    "round_half_up",
    "row_key",
    "split_part",
    "tokens",
    "truncate_to_long",
    "year_bounds",
]
