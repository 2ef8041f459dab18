"""Session construction and lineage-cutting helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for every plan in this package: adaptive execution
# (partition coalescing, skew-join splitting, runtime broadcast choice),
# UTC timestamps and ANSI arithmetic (Spark 4 default, stated explicitly).
_BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Target ~128 MB shuffle partitions; AQE coalesces small ones and splits
    # skewed join partitions (a run holding a third of all reads).
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "cohortlens",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with this package's base settings.

    On a cluster, ``master`` is left to spark-submit; locally it defaults to
    ``local[*]``.
    """
    builder = SparkSession.builder.appName(app)
    if master is None and "SPARK_MASTER" not in os.environ:
        master = "local[*]"
    if master:
        builder = builder.master(master)
    conf = dict(_BASE_CONF)
    # Local mode runs everything in the driver JVM; give it room (a cluster
    # deployment sets driver/executor memory through spark-submit instead).
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", os.environ.get("COHORTLENS_DRIVER_MEMORY", "12g"))
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Only a local session (one machine, no
    executors) without it gets a fresh scratch folder; on a cluster that is an
    error.  The folder is registered once in a session, so all checkpoints
    share one subfolder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        if not named and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="cohortlens-ckpt-"))
    return named or context._jsc.sc().getCheckpointDir().get()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def write_staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder of the shared checkpoint folder as Parquet and read it back.

    Unlike a checkpoint its columns are compressed, and later queries read only those they use."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Spark's setting by which an action's shuffle files go when it ends.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """The session has these settings inside the block; afterwards those of before."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def freed_shuffles(spark: SparkSession):
    """The shuffle files of DataFrames that are built and run in this block go as soon as their action ends.

    Otherwise they stay until the JVM collects its garbage, so steps that follow one another pile them up."""
    return settings(spark, {FREED: "true"})
