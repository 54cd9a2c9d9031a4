"""Session helpers.

The library never creates or reconfigures a session behind the caller's back:
pipelines take the ``SparkSession`` they are given. ``build_session`` is for
tests, the benchmark and command-line use; ``checkpoint_dir`` resolves the
shared folder named by ``spark.checkpoint.dir`` and falls back to a folder under
the session's warehouse when none is set; never to a machine-local temp folder.
"""

from __future__ import annotations

import contextlib
import os
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings that matter at scale: adaptive execution re-plans joins
# from real sizes, coalesces small shuffle partitions and splits skewed ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "tallycast",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings the pipelines assume."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TALLYCAST_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # checkpoints (sweep features, ordered positions) are removed once unreferenced
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # keep generated code of recurring plans: the clustering sweeps compile many
        # distinct plans, which would evict the pipelines' classes from a 100-entry cache
        .config("spark.sql.codegen.cache.maxEntries", "2000")
    )
    for key, value in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Uses the session's checkpoint directory (``spark.checkpoint.dir`` or one set
    on the context). When none is configured, a ``_scratch`` folder under the
    session's warehouse folder is registered: the warehouse is shared by driver
    and executors, a machine's temp folder is not.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises on some versions
            configured = None
    if not configured:
        configured = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


# Scratch paths handed out so far, per application, for release_scratch.
_SCRATCH: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release_scratch(spark: SparkSession, paths: list[str] | None = None) -> int:
    """Delete the given scratch paths, or every one handed out in this application; returns how many.

    Call it only when no DataFrame that reads them will be used again, e.g. after
    its rows were written elsewhere.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    if paths is None:
        paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    return len(paths)


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """On leaving, delete the scratch tables handed out and the checkpoints written inside the block.

    For a job that has written its results elsewhere by then; nothing made inside may be read after.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(checkpoint_dir(spark))
    fs = root.getFileSystem(conf)

    def checkpoints() -> set[str]:
        if not fs.exists(root):
            return set()
        return {s.getPath().toString() for s in fs.listStatus(root) if s.getPath().getName().startswith("rdd-")}

    app = spark.sparkContext.applicationId
    held, before = list(_SCRATCH.get(app, [])), checkpoints()
    try:
        yield
    finally:
        made = [p for p in _SCRATCH.get(app, []) if p not in held]
        release_scratch(spark, [*made, *(checkpoints() - before)])
        _SCRATCH[app] = [p for p in _SCRATCH.get(app, []) if p in held]


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, most: int):
    """Inside the block, Arrow batches have ``most`` rows or fewer; the caller's setting is back afterwards.

    For jobs that hand whole texts to Python workers: a batch is held by the JVM, as Arrow and as Python strings.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if not 0 < int(before) <= most:
        spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)
