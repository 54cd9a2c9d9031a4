"""Typed CSV readers.

Feeds arrive as CSV files whose columns are bound by position. Instead of
reading everything as strings and converting row by row, the reader declares
the schema up front so Spark parses and types the columns inside the scan and
downstream filters and projections are pushed into it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATE_FORMAT = "yyyy-MM-dd"


def ddl_fields(ddl: str) -> list[tuple[str, str]]:
    """``"a string, b date"`` -> ``[("a", "string"), ("b", "date")]`` via Spark's DDL parser."""
    return [(f.name, f.dataType.simpleString()) for f in T.StructType.fromDDL(ddl).fields]


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    ddl: str,
    header: bool = False,
    date_format: str = DATE_FORMAT,
    strict: bool = True,
) -> DataFrame:
    """Read CSV with a declared schema; columns are named by position.

    ``strict`` (default) fails the job on a value that does not parse, a blank
    field, or a row with too few or too many fields, whichever columns the query
    reads; otherwise malformed fields become null.
    """
    rows = (
        spark.read.schema(ddl)
        .option("header", header)
        .option("dateFormat", date_format)
        .option("mode", "FAILFAST" if strict else "PERMISSIVE")
        .option("columnPruning", not strict)
        .csv(path)
    )
    if not strict:
        return rows
    names = rows.columns
    blank = F.raise_error(F.lit("blank field in a required column"))
    whole = reduce(lambda acc, c: acc & c, [F.col(n).isNotNull() for n in names])
    # a filter on all columns cannot be pruned away
    return rows.filter(F.when(whole, F.lit(True)).otherwise(blank.cast("boolean")))


def _typed(raw: Column, dtype: str, date_format: str) -> Column:
    if dtype == "date":
        return F.try_to_timestamp(raw, F.lit(date_format)).cast("date")
    if dtype == "string":
        return raw
    return raw.try_cast(dtype)


RECORD = "_record"  # the whole line of a row whose field count is wrong


def raw_schema(ddl: str) -> str:
    """The feed's columns as text, and ``_record``."""
    return ", ".join(f"{name} string" for name, _ in ddl_fields(ddl)) + f", {RECORD} string"


def raw_options(header: bool = False) -> dict[str, str]:
    """Reader options under which no line is lost: wrong field counts keep the line in ``_record``."""
    return {
        "header": str(header).lower(), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD, "columnPruning": "false",
    }


def split_rejects(raw: DataFrame, ddl: str, date_format: str = DATE_FORMAT) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rejected raw rows) of rows read with ``raw_schema`` and ``raw_options``, streaming or not.

    A row is rejected when a field is blank or fails to convert to its declared
    type, or when it has too few or too many fields. Good and rejected rows add up to the input.
    """
    fields = ddl_fields(ddl)
    typed = raw.select(
        *[F.col(n).alias(f"_raw_{n}") for n, _ in fields],
        *[_typed(F.col(n), t, date_format).alias(n) for n, t in fields],
        RECORD,
    )
    bad = reduce(lambda acc, c: acc | c, [F.col(n).isNull() for n, _ in fields], F.col(RECORD).isNotNull())
    good = typed.filter(~bad).select(*[n for n, _ in fields])
    rejects = typed.filter(bad).select(*[F.col(f"_raw_{n}").alias(n) for n, _ in fields], RECORD)
    return good, rejects


def read_csv_with_rejects(
    spark: SparkSession,
    path: str | list[str],
    ddl: str,
    header: bool = False,
    date_format: str = DATE_FORMAT,
) -> tuple[DataFrame, DataFrame]:
    """Read CSV leniently and split it into (typed rows, rejected raw rows), see ``split_rejects``.

    Both outputs come from the same scan; cache the input of both if they are consumed by separate actions.
    """
    raw = spark.read.schema(raw_schema(ddl)).options(**raw_options(header)).csv(path)
    return split_rejects(raw, ddl, date_format)


def read_bound(
    spark: SparkSession,
    path: str | list[str],
    ddl: str,
    bind: dict[str, str | int],
    header: bool = False,
    date_format: str = DATE_FORMAT,
) -> DataFrame:
    """Read wide CSV files, taking each column of ``ddl`` from the header name or position that ``bind`` gives.

    Columns that ``bind`` leaves out are taken by their own name with a header, else by their place in ``ddl``.
    With a header every file must have the columns of the first, in that order, or the job fails;
    without one the files' width is that of their first line. As in ``read_csv`` a blank or
    malformed value in a bound column and a wrong number of fields fail the job.
    """
    fields = ddl_fields(ddl)
    unknown = set(bind) - {n for n, _ in fields}
    if unknown:
        raise ValueError(f"no such column: {sorted(unknown)}; the feed has {[n for n, _ in fields]}")
    found = spark.read.option("header", header).csv(path).columns  # reads the first line
    names = found if header else [str(i) for i in range(len(found))]
    source = {}
    for i, (name, _) in enumerate(fields):
        at = bind.get(name, name if header else i)
        if isinstance(at, int) and not 0 <= at < len(names):
            raise ValueError(f"{name}: position {at} of {len(names)} columns")
        if isinstance(at, str) and (not header or at not in names):
            raise ValueError(f"{name}: no column {at!r}" + (f" in {names}" if header else "; the file has no header"))
        source[name] = at if isinstance(at, int) else names.index(at)
    # every file column is declared, under a name by place where there is no header
    quoted = [f"`{n.replace('`', '``')}`" for n in names]
    wide = (
        spark.read.schema(", ".join(f"{q} string" for q in quoted))
        .option("header", header)
        .option("enforceSchema", not header)
        .option("mode", "FAILFAST")
        .option("columnPruning", False)
        .csv(path)
    )
    blank = F.raise_error(F.lit("blank or malformed field in a bound column"))
    typed = wide.select(*[_typed(F.col(quoted[source[n]]), t, date_format).alias(n) for n, t in fields])
    whole = reduce(lambda acc, c: acc & c, [F.col(n).isNotNull() for n, _ in fields])
    return typed.filter(F.when(whole, F.lit(True)).otherwise(blank.cast("boolean")))


def bind_columns(df: DataFrame, ddl: str) -> DataFrame:
    """Name and type the leading columns of ``df`` by position.

    Casts follow the session's ANSI setting: with ANSI on (the default) a value
    that does not convert fails the job instead of turning into null.
    """
    fields = ddl_fields(ddl)
    if len(df.columns) < len(fields):
        raise ValueError(f"need {len(fields)} columns, got {df.columns}")
    return df.select(
        *[F.col(src).cast(t).alias(name) for src, (name, t) in zip(df.columns, fields)]
    )
