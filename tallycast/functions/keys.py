"""Composite keys and tokens."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_SEPARATOR = "::"


def row_key(*cols: Column | str, sep: str = KEY_SEPARATOR) -> Column:
    """``'a::b::c'`` from the parts, each rendered as text (X3, X5); a null part fails the job."""
    null_part = F.raise_error(F.lit("null part in a row key")).cast("string")
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), null_part) for c in cols]
    return F.concat_ws(sep, *parts)


def leading_token(c: Column | str, sep: str = ",") -> Column:
    """Text before the first ``sep`` (the whole value when there is none)."""
    return F.substring_index(F.col(c) if isinstance(c, str) else c, sep, 1)


def tokens(c: Column | str, sep: str = ",") -> Column:
    """All ``sep``-separated tokens as an array; ``explode`` it for one row per token."""
    return F.split(F.col(c) if isinstance(c, str) else c, re.escape(sep))
