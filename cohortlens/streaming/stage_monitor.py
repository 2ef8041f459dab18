"""Structured Streaming over append-only stage logs.

Stage logs only grow (one row per run and attempt), so failures and status
counts can be maintained incrementally as new log files land, instead of
re-reading the whole log.  Checkpoints live under the session's shared
``spark.checkpoint.dir``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators.stages import stage_failures
from cohortlens.session import checkpoint_dir

STAGE_LOG_STREAM_SCHEMA = (
    "stage string, run_accession string, status string, ts timestamp, event_id bigint, "
    "original_reads bigint, subsampled_reads bigint, total_reads_before bigint, total_reads_after bigint")


def read_stage_log_stream(spark: SparkSession, directory: str,
                          schema: str = STAGE_LOG_STREAM_SCHEMA, fmt: str = "parquet",
                          max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the files of a stage-log folder (fixed schema, no inference)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(directory)


def failures_stream(log_stream: DataFrame) -> DataFrame:
    """F4 on a stream: failed rows and their messages (stateless, append)."""
    return stage_failures(log_stream)


def status_counts_stream(log_stream: DataFrame) -> DataFrame:
    """Rows per (stage, status) kept up to date (complete output mode)."""
    return log_stream.groupBy("stage", "status").agg(F.count("*").alias("n"))


def drain_to_table(df: DataFrame, name: str | None = None, mode: str = "append") -> DataFrame:
    """Run a streaming DataFrame over everything available (availableNow)
    into Parquet files of the shared folder and return them as a batch
    DataFrame.  In complete mode every batch replaces the one before."""
    spark = df.sparkSession
    name = name or f"stream_{uuid.uuid4().hex[:12]}"
    base = f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True)
    if mode == "complete":
        writer = writer.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(f"{base}/rows"))
    else:
        writer = writer.format("parquet").option("path", f"{base}/rows")
    writer.start().awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{base}/rows")
