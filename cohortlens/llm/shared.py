"""Small helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch that a task turns into numpy arrays at a time.
SLICE_ROWS = 512


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, else the context's checkpoint folder.

    Only a local session (one machine, no executors) without either gets a
    scratch folder; on a cluster that is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if context._jsc.sc().getCheckpointDir().isEmpty():
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="text-checkpoint-"))
    return context._jsc.sc().getCheckpointDir().get()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stash(df: DataFrame, name: str, **measures) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    ``measures`` are aggregates that the write takes on its way; they stand in
    ``measured`` of the result.
    """
    path = fresh_path(df.sparkSession, name)
    seen = Observation()
    observed = df.observe(seen, *[m.alias(k) for k, m in measures.items()]) if measures else df
    observed.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stash_path, out.measured = path, seen.get if measures else {}
    return out


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once, reliably, and go on from the written rows; ``measured["n"]`` is their number."""
    return stash(df, "cut", n=F.count(F.lit(1)))


#: Partitions that a result is gathered into at least.
LEAST_PARTITIONS = 24


def gathered(df: DataFrame, rows: int, per: int = 4096) -> DataFrame:
    """``df`` in one partition for every ``per`` of ``rows``, without a shuffle; never in more than it has.

    A task costs some hundredths of a second whatever it holds, so rows that
    lie thinly in hundreds of shuffle partitions are worked on by fewer tasks.
    """
    return df.coalesce(max(LEAST_PARTITIONS, -(-rows // per)))


def discard(*stashed: DataFrame) -> None:
    """Remove the files of stashed frames that nothing reads any more."""
    for df in stashed:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df.stash_path)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of an Arrow batch between Spark and Python.  Texts are long, and Spark's
#: default of 10,000 rows would hold tens of megabytes on both sides.
ARROW_ROWS = 1000


def bounded_batches(spark: SparkSession) -> None:
    """Let the session hand texts to Python in batches of at most ``ARROW_ROWS`` rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, ARROW_ROWS)


def slices(batches, rows: int = SLICE_ROWS):
    """Cut the record batches of a task into pieces of at most ``rows`` rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def text_slices(batches, column: int, size: int = 16 << 20):
    """Cut the record batches of a task into pieces of about ``size`` bytes of text (one row at least)."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False),
                         dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null reads as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def lean_task(run):
    """Wrap a task's function so that it costs less time and leaves no memory behind.

    The tasks make millions of small objects without cycles, so cyclic garbage
    collection rests meanwhile.  Spark keeps Python workers for later tasks and
    stages; what the allocators hold of a finished task goes back to the system.
    """
    def wrapped(batches):
        on = gc.isenabled()
        gc.disable()
        try:
            yield from run(batches)
        finally:
            if on:
                gc.enable()
            release_memory()
    return wrapped


def release_memory() -> None:
    """Give freed memory back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def ragged(starts, lengths):
    """Flat positions of many runs: ``starts[i] .. starts[i]+lengths[i]-1`` one after another."""
    import numpy as np

    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total, dtype=np.int64)


#: Ids (a row of 8 bytes each) that a join may broadcast; longer lists are shuffled.
BROADCAST_IDS = 1_000_000
#: Ids of a partition, where their number is known to stay below some bound (``rows``).
IDS_PER_PARTITION = 1 << 16


def _id_join(docs: DataFrame, ids: DataFrame, how: str, column: str, most: int, rows: int | None) -> DataFrame:
    ids = ids.select(F.col(column).alias("__wanted"))
    ids = cut(ids if rows is None else gathered(ids, rows, IDS_PER_PARTITION))
    if ids.measured["n"] <= most:
        ids = F.broadcast(ids)
    return docs.join(ids, docs[column].eqNullSafe(ids["__wanted"]), how)


def without_ids(docs: DataFrame, ids: DataFrame, column: str = "doc_id", most: int = BROADCAST_IDS) -> DataFrame:
    """The rows of ``docs`` whose id is not in ``ids``; the counted ids are broadcast if they are few."""
    return _id_join(docs, ids, "left_anti", column, most, None)


def with_ids(docs: DataFrame, ids: DataFrame, column: str = "doc_id", most: int = BROADCAST_IDS,
             rows: int | None = None) -> DataFrame:
    """The rows of ``docs`` whose id is in ``ids`` (``rows`` at most); the counted ids are broadcast if they are few."""
    return _id_join(docs, ids, "left_semi", column, most, rows)
