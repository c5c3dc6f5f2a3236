"""Session settings and table access shared by every job."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Columns each driver table is read with; pruning is explicit so the parquet
# scan's ReadSchema never carries more than the job uses.
_SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HTML rows are large: keep Arrow batches into the shredder small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
}


def get_session(master: str | None = None, app: str = "folia", **conf: str) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    On a cluster the master and checkpoint dir come from spark-submit; only
    unset values are filled in here.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for key, value in {**_SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Set the runtime SQL settings the jobs rely on. On a local master the
    shred stage deals pages out over the cores; on a cluster the scan's own
    splits stand unless ``folia.shred.partitions`` is set."""
    for key, value in _SESSION_DEFAULTS.items():
        spark.conf.set(key, value)
    if spark.sparkContext.master.startswith("local[") and spark.conf.get("folia.shred.partitions", None) is None:
        spark.conf.set("folia.shred.partitions", str(spark.sparkContext.defaultParallelism))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A private one is made only on a local master; on a cluster a
    driver-local folder would be lost to the executors, so that fails.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="folia-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def folder_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders directly in ``folder``; none if it does not exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(x.getPath().getName() for x in fs.listStatus(path) if x.isDirectory()) if fs.exists(path) else []


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_scratch: list[tuple[SparkSession, str]] = []


def scratch_folder(spark: SparkSession, kind: str) -> str:
    """A new folder name under the shared checkpoint folder, removed when this
    process ends: results may be read until then."""
    if not _scratch:
        atexit.register(clear_scratch)
    folder = f"{checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"
    _scratch.append((spark, folder))
    return folder


def clear_scratch() -> None:
    """Remove the scratch folders of this process."""
    while _scratch:
        spark, folder = _scratch.pop()
        with contextlib.suppress(Exception):  # the session may have ended; nothing is read from them any more
            remove_folder(spark, folder)


def materialize(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet to the shared checkpoint folder and read
    from there: several branches read it by column, and a lost executor
    re-reads files instead of recomputing."""
    folder = scratch_folder(df.sparkSession, "frame")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def ship_by_value(module) -> None:
    """Pickle a module's functions by value so Python workers run them
    without the package being installed on the executors."""
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(module)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one driver table, projecting to ``columns`` when given."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return df.select(*columns) if columns else df
