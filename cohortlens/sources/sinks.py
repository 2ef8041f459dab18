"""Sinks: tables, CSV outputs, append-only stage logs, failure files."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators.stages import stage_failures


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """K1/K3/K4: Parquet by default, CSV with header on request."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def append_stage_log(log: DataFrame, path: str, stage: str) -> None:
    """K2: append-only stage log, partitioned by stage (reruns add rows)."""
    log.withColumn("stage", F.lit(stage)).write.mode("append").partitionBy("stage").parquet(path)


def commit_stage_log(log: DataFrame, path: str, stage: str, attempt: str) -> bool:
    """K2: append the rows of one attempt once, however often it is tried again.

    An attempt writes into a folder of its own, replacing what an earlier try
    has left there, and then enters the manifest, a folder of one entry for
    each finished attempt.  A finished attempt is not written again; returns
    whether it was written now."""
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", attempt):
        raise ValueError(f"{attempt!r} is no name of an attempt")
    spark = log.sparkSession
    entry, entries = _hadoop_path(spark, f"{path}/manifest/attempt={attempt}/_SUCCESS")
    if entries.exists(entry):
        return False
    log.withColumn("stage", F.lit(stage)).write.mode("overwrite").parquet(f"{path}/rows/attempt={attempt}")
    # The entry is complete when the writer has committed it.
    spark.range(1).select(F.lit(stage).alias("stage")).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/attempt={attempt}")
    return True


def read_stage_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of all finished attempts (``schema``, stage, attempt); no attempt, no rows."""
    root, files = _hadoop_path(spark, f"{path}/manifest")
    named = f"{schema}, stage string"
    if not files.exists(root):
        return spark.createDataFrame([], f"{named}, attempt string")
    done = sorted(s.getPath().getName().split("=", 1)[1] for s in files.listStatus(root)
                  if s.isDirectory() and files.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")))
    if not done:
        return spark.createDataFrame([], f"{named}, attempt string")
    return (spark.read.schema(f"{named}, attempt string").option("basePath", f"{path}/rows")
            .parquet(*[f"{path}/rows/attempt={a}" for a in done]))


def _hadoop_path(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_failures(log: DataFrame, path: str) -> bool:
    """K2: failures file only when there are failures; otherwise any old
    file is removed.  Returns whether a file was written."""
    failed = stage_failures(log)
    spark = log.sparkSession
    if failed.isEmpty():
        p, fs = _hadoop_path(spark, path)
        if fs.exists(p):
            fs.delete(p, True)
        return False
    failed.write.mode("overwrite").option("header", True).csv(path)
    return True


def write_cohort_outputs(tables: Mapping[str, DataFrame], root: str, cohort: str, fmt: str = "parquet") -> None:
    """K5: every analysis table under ``root/<name>/cohort=<cohort>``, as Parquet or as CSV with header."""
    for name, df in tables.items():
        w = (df.withColumn("cohort", F.lit(cohort)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("cohort"))
        if fmt == "csv":
            w.option("header", True).csv(f"{root}/{name}")
        else:
            w.format(fmt).save(f"{root}/{name}")
