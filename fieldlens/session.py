"""Session settings and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Settings every job wants: runtime re-planning, skew splitting and UTC clocks.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_own_folders: dict[str, str] = {}


def local_session(cpus: int = 8, app: str = "fieldlens", memory: str = "12g",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
    )
    for key, value in ENGINE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Give a session from elsewhere, such as a cluster's, the settings that can change at run time."""
    for key, value in ENGINE_CONF.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, from ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own, which goes when the process ends: a
    machine-local path is invisible to other executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    app_id = spark.sparkContext.applicationId
    if app_id not in _own_folders:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        _own_folders[app_id] = tempfile.mkdtemp(prefix="fieldlens-")
        atexit.register(shutil.rmtree, _own_folders[app_id], ignore_errors=True)
    return _own_folders[app_id]


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, never used before."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def ensure_checkpointing(spark: SparkSession) -> None:
    """Let iterative jobs cut their lineage in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(work_path(spark, "lineage"))


def stored(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Write an intermediate table to the shared folder; return it and its row count.

    The lineage ends here: several readers share one computation, and a lost
    executor re-reads files instead of recomputing joins. Rows are counted while
    they are written.
    """
    spark = df.sparkSession
    path = work_path(spark, label)
    watch = Observation(label)
    df.observe(watch, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_path = path
    return table, watch.get["rows"]


def discard(table: DataFrame) -> None:
    """Delete the files of a table from ``stored``, once no later plan reads them."""
    path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.stored_path)
    path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def sent_if_small(table: DataFrame, label: str, rows: int = 100_000) -> DataFrame:
    """A table for the small side of a join: stored, counted, and broadcast only up to ``rows`` rows.

    Few-valued keys would otherwise gather the long side in a few tasks; beyond the limit the keys are
    many, and an ordinary join spreads them.
    """
    saved, n = stored(table, label)
    return F.broadcast(saved) if n <= rows else saved
