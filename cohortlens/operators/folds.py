"""Stratified, repeated k-fold assignment with deterministic keyed shuffles.

``assign_folds`` gives a row for each (id, repeat).  ``deal`` gives the rows with
their places in all repeats beside them: a task sends the digests of a slice of
rows in packs by (repeat, class, range of digests), a range's places come back
in packs by slice, so no row is shuffled for each repeat, and none is looked up
by its id.  A place serves any number of folds."""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.session import freed_shuffles, write_staged

#: Rows that one window numbers, about.
ROWS_PER_BUCKET = 250_000
#: A bucket is a range of the first 32 bits of the digest.
SPAN = 1 << 32
#: Rows of a slice; a row's number in its slice is two bytes.
SLICE = 1 << 15


def assign_folds(df: DataFrame, k: int = 5, repeats: int = 10, seed: int = 42,
                 id_col: str = "run_accession", label: str = "y",
                 rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """(id, label, repeat, fold) for every row and repeat.

    Within each (repeat, class) rows are ordered by md5(seed:repeat:id) and
    dealt round-robin into k folds, so class counts per fold differ by at
    most one.  The digest is uniform, so equal ranges of it are buckets of
    equal size that need no sketch: buckets are counted (a partial aggregate),
    and one window numbers the rows of each (repeat, class, bucket).  Only id,
    class, repeat and bucket are shuffled; the digest is taken again behind it."""
    base = df.select(F.col(id_col).alias("id"), F.col(label).alias("y"))
    n = base.count()
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col("repeat"), F.col("id").cast("string")))
    buckets = max(1, -(-n // rows_per_bucket))
    # One row per (sample, repeat): a generator bounded by the parameter.
    expanded = base.select("id", "y", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("repeat"))
    place = F.floor(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") * buckets / SPAN).cast("int")
    tagged = expanded.withColumn("bucket", place if buckets > 1 else F.lit(0))
    parts = ["repeat", "y", "bucket"]
    dealt = tagged.repartition(*parts)
    own = Window.partitionBy(*parts).orderBy(digest, "id")
    numbered = dealt.withColumn("at", F.row_number().over(own).cast("bigint"))
    if buckets > 1:
        before = Window.partitionBy("repeat", "y").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        # As many rows as there are repeats, classes and buckets.
        offsets = tagged.groupBy(*parts).agg(F.count(F.lit(1)).alias("n")).select(
            F.col("repeat").alias("__r"), F.col("y").alias("__y"), F.col("bucket").alias("__b"),
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
        numbered = numbered.join(F.broadcast(offsets), (F.col("repeat") == F.col("__r")) & F.col("y").eqNullSafe(F.col("__y"))
                                 & (F.col("bucket") == F.col("__b"))).withColumn("at", F.col("at") + F.col("ahead"))
    return numbered.select(F.col("id").alias(id_col), F.col("y").alias(label), "repeat",
                           ((F.col("at") - 1) % k).cast("int").alias("fold"))


def fold_balance(folds: DataFrame, label: str = "y") -> DataFrame:
    """Rows per (repeat, fold, class): balanced folds differ by at most one."""
    return folds.groupBy("repeat", "fold", label).agg(F.count("*").alias("n"))


@dataclass(frozen=True)
class Dealt:
    """Rows (__id, y, x, places) and the folds that are made of the places."""
    rows: DataFrame
    columns: tuple[str, ...]
    k: int
    keys: tuple[tuple[int, int], ...]  # (repeat, fold), as many as hold rows

    def training_rows(self) -> DataFrame:
        """__id, y, x, parts (the row's fold in each repeat)."""
        return self.rows.select("__id", "y", "x", F.expr(f"transform(places, p -> cast(p % {self.k} as int))").alias("parts"))


def deal(rows: DataFrame, columns: list[str], ks: list[int], repeats: int = 10, seed: int = 42,
         rows_per_bucket: int = ROWS_PER_BUCKET, size: int = SLICE) -> list[Dealt]:
    """For each of ``ks`` the folds of ``assign_folds`` beside the rows (__id, y, x: array of ``columns``), which are staged once.

    Rows of the same id are dealt one by one."""
    spark, id_type, width = rows.sparkSession, rows.schema["__id"].dataType.simpleString(), len(columns)

    def cut(batches):
        number, held, n = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                if n + part.num_rows > size:
                    yield whole(number, held)
                    number, held, n = number + 1, [], 0
                held.append(part)
                n += part.num_rows
        if n:
            yield whole(number, held)

    def whole(number, held):
        table = pa.Table.from_batches(held).combine_chunks()
        listed = lambda c: pa.ListArray.from_arrays(pa.array([0, table.num_rows], pa.int32()), pa.concat_arrays(table.column(c).chunks))
        x = pa.concat_arrays(table.column("x").chunks).flatten().to_numpy(zero_copy_only=False)
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), listed("__id"), listed("key"), listed("y"), pa.array([x.tobytes()], pa.binary())],
                                          names=["slice", "ids", "keys", "y", "x"])
    kinds = f"slice long, ids array<{id_type}>, keys array<string>, y array<double>, x binary"
    keyed = rows.select("__id", F.col("__id").cast("string").alias("key"), F.col("y").cast("double").alias("y"), "x")
    slices = write_staged(keyed.mapInArrow(cut, kinds), "fold-slices")
    counts = [r["n"] for r in slices.select(F.explode("y").alias("y")).groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()]
    buckets = max(1, -(-sum(counts) // rows_per_bucket))

    def send(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                keys = [None if k is None else k.encode() for k in batch.column(1)[i].as_py()]
                side = batch.column(2)[i].values.to_numpy(zero_copy_only=False)
                packs = []
                for r in range(repeats):
                    start = f"{seed}:{r}"
                    begin, none = md5(f"{start}:".encode()), md5(start.encode()).digest()
                    digests = bytearray()
                    for k in keys:
                        if k is None:
                            digests += none
                        else:
                            one = begin.copy()
                            one.update(k)
                            digests += one.digest()
                    digest = np.frombuffer(bytes(digests), ">u8").reshape(-1, 2)
                    bucket = ((digest[:, 0].astype(np.uint64) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
                    for c in {-1 if np.isnan(v) else v for v in side.tolist()}:
                        own = np.flatnonzero(np.isnan(side) if c == -1 else side == c)
                        own = own[np.argsort(bucket[own], kind="stable")]
                        found, first = np.unique(bucket[own], return_index=True)
                        for b, lo, hi in zip(found, first, np.r_[first[1:], len(own)]):
                            at = own[lo:hi]
                            packs.append((r, float(c), int(b), batch.column(0)[i].as_py(), at.astype(np.uint16).tobytes(), digest[at].tobytes()))
                yield _packs(packs, "digests")

    def rank(table: pa.Table) -> pa.Table:
        sent = [np.frombuffer(d, ">u8").reshape(-1, 2) for d in table.column("digests").to_pylist()]
        slice_no = table.column("slice").to_numpy()
        by = np.argsort(slice_no, kind="stable")  # equal digests: in the order of the slices
        both = np.concatenate([sent[i] for i in by])
        place = np.empty(len(both), np.int32)
        place[np.lexsort((both[:, 1], both[:, 0]))] = np.arange(len(both), dtype=np.int32)
        ends = np.cumsum([len(sent[i]) for i in by])
        named = {c: table.column(c)[0].as_py() for c in ("r", "y", "bucket")}
        return pa.Table.from_batches([_packs([(named["r"], named["y"], named["bucket"], int(slice_no[i]), table.column("at")[int(i)].as_py(),
                                               place[e - len(sent[i]):e].tobytes()) for i, e in zip(by, ends)], "places")])
    form = "r int, y double, bucket int, slice long, at binary, {} binary"
    with freed_shuffles(spark):
        packs = slices.select("slice", "keys", "y").mapInArrow(send, form.format("digests"))
        ranked = write_staged(packs.groupBy("r", "y", "bucket").applyInArrow(rank, form.format("places")), "fold-places")
    # As many rows as there are repeats, classes and buckets.
    ahead: dict[tuple, int] = {}
    for row in ranked.groupBy("r", "y", "bucket").agg(F.sum(F.length("at") / 2).cast("long").alias("n")).orderBy("r", "y", "bucket").collect():
        for b in range(row["bucket"] + 1, buckets):
            ahead[row["r"], row["y"], b] = ahead.get((row["r"], row["y"], b), 0) + row["n"]
    shared = spark.sparkContext.broadcast(ahead)

    def merge(back: pa.Table, own: pa.Table) -> pa.Table:
        n = len(own.column("y")[0].values)
        places = np.zeros((n, repeats), np.int32)
        for r, y, b, at, place in zip(*(back.column(c).to_pylist() for c in ("r", "y", "bucket", "at", "places"))):
            places[np.frombuffer(at, np.uint16), r] = np.frombuffer(place, np.int32) + shared.value.get((r, y, b), 0)
        x = np.frombuffer(own.column("x")[0].as_py(), float)
        lists = lambda v, w: pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * w, pa.int32()), pa.array(v))
        return pa.Table.from_arrays([own.column("ids")[0].values, own.column("y")[0].values, lists(x, width), lists(places.ravel(), repeats)],
                                    names=["__id", "y", "x", "places"])
    with freed_shuffles(spark):
        merged = ranked.groupBy("slice").cogroup(slices.groupBy("slice")).applyInArrow(
            merge, f"__id {id_type}, y double, x array<double>, places array<int>")
        merged = write_staged(merged, "dealt-rows")
    return [Dealt(merged, tuple(columns), k, tuple((r, f) for r in range(repeats) for f in range(min(k, max(counts, default=0))))) for k in ks]


def _packs(packs: list[tuple], last: str) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.float64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in packs], t) for i, t in enumerate(kinds)],
                                      names=["r", "y", "bucket", "slice", "at", last])
