"""Atomic publication of a set of results (K4).

Every run writes into a version folder of its own, ``{base}/v-<time>-<id>``, and then replaces the
one-line file ``{base}/CURRENT`` that names it, by a rename. Readers go through the pointer, so a
run that is killed at any point before that leaves the previous results readable as they were,
and all results of a run appear together. The rename replaces in one step on HDFS and on local
and shared file systems; an object store needs a committer or a table format instead.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import SparkSession

POINTER = "CURRENT"


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def new_version(base: str) -> str:
    """The folder for a run's results; versions sort by time."""
    now = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    return f"{base.rstrip('/')}/v-{now}-{uuid.uuid4().hex[:8]}"


def publish(spark: SparkSession, version: str) -> None:
    """Make ``version`` (from ``new_version``, fully written) the one that readers see."""
    base, _, name = version.rpartition("/")
    jvm = spark._jvm
    fresh, fs = _path(spark, f"{base}/.{POINTER}-{uuid.uuid4().hex}")
    stream = fs.create(fresh, True)
    try:
        stream.write(bytearray(name.encode()))
    finally:
        stream.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fresh, jvm.org.apache.hadoop.fs.Path(f"{base}/{POINTER}"), options)


def published(spark: SparkSession, base: str) -> str:
    """The folder of the published version; raises FileNotFoundError if nothing was published."""
    base = base.rstrip("/")
    pointer, fs = _path(spark, f"{base}/{POINTER}")
    if not fs.exists(pointer):
        raise FileNotFoundError(f"nothing is published under {base}")
    stream = fs.open(pointer)
    try:
        name = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()
    return f"{base}/{name}"


def drop_old_versions(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Delete all versions but the published one and the ``keep - 1`` newest before it; returns the deleted paths.

    Versions newer than the published one may belong to a run that is still writing and stay.
    """
    current = published(spark, base).rpartition("/")[2]
    root, fs = _path(spark, base.rstrip("/"))
    names = sorted(s.getPath().getName() for s in fs.listStatus(root) if s.getPath().getName().startswith("v-"))
    old = [n for n in names if n < current]
    drop = old[: max(0, len(old) - (keep - 1))]
    for name in drop:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{name}"), True)
    return [f"{base.rstrip('/')}/{name}" for name in drop]
