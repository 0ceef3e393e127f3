"""Session settings and the durable cut used between stages."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession

# Largest number of rows of one group that a single task may be handed. Groups above it
# take the distributed route of each operator.
ROWS_PER_TASK_KEY = "seedline.rowsPerTask"
ROWS_PER_TASK = 1_000_000

CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where the split costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def ship(spark: SparkSession) -> SparkSession:
    """Hand this package to the workers, so that functions running in tasks can be imported there.

    Needed once per session; the zip goes through the driver's file server, as with ``--py-files``.
    """
    context = spark.sparkContext
    if getattr(context, "_seedline_shipped", False):
        return spark
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="seedline-zip-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.addPyFile(shutil.make_archive(f"{folder}/seedline", "zip", package.parent, package.name))
    context._seedline_shipped = True
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the cluster settings to a user's session and hand the package to its workers."""
    for key, value in CLUSTER_SETTINGS.items():
        spark.conf.set(key, value)
    return ship(spark)


def local_session(cores: str = "8", memory: str = "8g", **extra: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("seedline")
    settings = {
        **CLUSTER_SETTINGS,
        "spark.sql.shuffle.partitions": cores,
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def rows_per_task(spark: SparkSession) -> int:
    return int(spark.conf.get(ROWS_PER_TASK_KEY, str(ROWS_PER_TASK)))


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; a cluster without
    it is an error, because a machine-local path would not be visible to other executors.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="seedline-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/seedline/{label}-{uuid.uuid4().hex}"


def bucketed(df: DataFrame, label: str, columns: list[str], rows_per_bucket: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder in buckets of ``columns`` and read it back: a join on them does not shuffle it again.

    As many buckets as keep each at about ``rows_per_bucket`` (``seedline.rowsPerTask`` by default), but no fewer than shuffle partitions.
    """
    spark = df.sparkSession
    written = durable(df, label)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least, -(-written.count() // (rows_per_bucket or ROWS_PER_TASK)))
    name = f"seedline_{re.sub('[^a-z0-9]', '_', label.lower())}_{uuid.uuid4().hex}"
    writer = written.repartition(buckets, *columns).write.bucketBy(buckets, *columns).sortBy(*columns)
    writer.option("path", scratch_path(spark, f"{label}-buckets")).format("parquet").saveAsTable(name)
    return spark.table(name)


def durable(df: DataFrame, label: str, observation: Observation | None = None, *metrics, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage, survives the loss of executors, and gives the optimiser the measured size,
    so that a broadcast is chosen from real bytes. ``metrics`` are observed by the same job.
    ``path``: a place to write to again, whose former table no plan reads any more.
    """
    mode, path = "overwrite" if path else "errorifexists", path or scratch_path(df.sparkSession, label)
    (df.observe(observation, *metrics) if observation is not None else df).write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
