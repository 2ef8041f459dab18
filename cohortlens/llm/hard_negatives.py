"""Hard negatives of anchor vectors, by slots between the positives' scores.

A row's score for an anchor is the inner product of their vectors in whole
numbers.  An anchor's positives are its best rows of the same label; a positive
of score p takes its negatives, the best rows of other labels, from the window
``lower p <= 100 score <= 100 p``.  The windows of one anchor overlap.

1. Anchors are taken in blocks of a fixed number of bytes.  A block goes to all
   tasks, and every task scores its rows against it, tile by tile, in numpy.
2. Each task keeps the best rows of the anchor's own label; merged over the
   tasks they are the positives.
3. The positives' scores, the upper limits of the windows, cut the scores into
   disjoint slots.  A second pass keeps the best ``k`` rows of other labels for
   each (anchor, slot): first in the task, then over the tasks.  One row lies
   in one slot, so no window costs more for overlapping another.
4. An anchor's slots, one after another in descending order, are one sorted
   list.  A window's answer is the first ``k`` of the list's rest from its own
   slot on, down to its lower limit: any row of the window that was not kept
   has ``k`` better ones in its slot.

Rows are never shuffled; a task sends at most ``k`` rows for each anchor and
slot.  The work is that of every anchor against every row, as asked.

Defined cases: rows without ``vec_id``, label or vector, or with a null or
non-finite component, take no part; nor do vectors whose whole-number form has
a squared length of 2^62 and more, as their scores might not fit a long.  Vectors of
different lengths have no score for each other.  Rows that share a ``vec_id``
are each a row; an anchor's other rows are those of another ``vec_id``, and
anchors that share one each get their results.  A negative positive score has
an empty window.  An empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortlens.llm.shared import bounded_batches, fresh_path, lean_task, ragged

#: Bytes of anchor vectors in whole numbers that are broadcast at a time.
BLOCK_BYTES = 16 << 20
#: Scores of a tile.
TILE_SCORES = 1 << 20
#: Candidates that a task gathers before it keeps the best of them.
HELD = 1 << 19

_LEAST = np.iinfo(np.int64).min


def whole_vectors(column: pa.Array, ids: pa.Array, labels: pa.Array):
    """By vector length: (length, places, whole-number matrix) of the rows that take part."""
    lists = column.cast(pa.large_list(pa.float64()))
    ends = lists.offsets.to_numpy()
    starts, lengths = ends[:-1], np.diff(ends)
    flat = lists.values.to_numpy(zero_copy_only=False)  # a null component becomes nan
    valid = pc.and_(pc.and_(column.is_valid(), ids.is_valid()), labels.is_valid()).to_numpy(zero_copy_only=False)
    for length in np.unique(lengths[valid]).tolist():
        at = np.flatnonzero(valid & (lengths == length))
        # Components that no double holds as a whole number are not finite or too long in any case.
        with np.errstate(over="ignore", invalid="ignore"):
            matrix = np.floor(256.0 * flat[ragged(starts[at], lengths[at])].reshape(len(at), length))
            fits = (matrix ** 2).sum(axis=1) < 2.0 ** 62
        if fits.any():
            yield length, at[fits], matrix[fits]


class Anchors:
    """A block of anchors: places in the block, ids, labels and vectors by vector length, and the slots' limits."""

    def __init__(self, rows: list):
        self.ids = [r["vec_id"] for r in rows]
        self.groups = {}
        vectors = [np.frombuffer(r["vector"], np.float64) for r in rows]
        for length in {len(v) for v in vectors}:
            places = np.array([i for i, v in enumerate(vectors) if len(v) == length])
            matrix = np.stack([vectors[i] for i in places])
            self.groups[length] = (places, np.array([self.ids[i] for i in places]),
                                   np.array([rows[i]["label"] for i in places]), matrix,
                                   float(np.sqrt((matrix ** 2).sum(axis=1).max())))
        self.limits = self.lowest = None

    def set_limits(self, scores: dict[int, list[int]], lower: int, k: int) -> None:
        """Upper limits of the slots of each anchor, ascending, unused ones in front; and the lowest score of any window."""
        self.limits = np.full((len(self.ids), k), _LEAST, np.int64)
        self.lowest = np.full(len(self.ids), np.iinfo(np.int64).max, np.int64)
        for i, mine in scores.items():
            mine = sorted({p for p in mine if p >= 0})
            if mine:
                self.limits[i, k - len(mine):] = mine
                self.lowest[i] = -(-lower * mine[0] // 100)


def products(rows: np.ndarray, anchors: np.ndarray, longest: float) -> np.ndarray:
    """Exact inner products of whole-number vectors (rows x anchors)."""
    if not rows.shape[1]:
        return np.zeros((len(rows), len(anchors)), np.int64)
    if float(np.sqrt((rows ** 2).sum(axis=1).max())) * longest < 2.0 ** 52:
        return (rows @ anchors.T).astype(np.int64)  # no partial sum leaves the whole numbers that doubles hold
    # Sums may wrap on their way; the result is below 2^62.
    return rows.astype(np.int64) @ anchors.astype(np.int64).T


class Best:
    """The best ``k`` rows (highest score, then smallest id) of each key."""

    def __init__(self, keys: int, k: int):
        self.k, self.bar = k, np.full(keys, _LEAST, np.int64)
        self.kept, self.fresh, self.held = (np.empty(0, np.int64),) * 3, [], 0

    def add(self, key, score, vec_id) -> None:
        good = score >= self.bar[key]
        self.fresh.append((key[good], score[good], vec_id[good]))
        self.held += int(good.sum())
        if self.held > max(HELD, len(self.kept[0])):
            self.settle()

    def settle(self):
        key, score, vec_id = (np.concatenate(x) for x in zip(self.kept, *self.fresh, strict=True))
        order = np.lexsort((vec_id, -score, key))
        key, score, vec_id = key[order], score[order], vec_id[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        rank = np.arange(len(key)) - np.repeat(first, np.diff(np.append(first, len(key))))
        full = rank == self.k - 1
        self.bar[key[full]] = score[full]
        keep = rank < self.k
        self.kept, self.fresh, self.held = (key[keep], score[keep], vec_id[keep]), [], 0
        return self.kept


def _tiles(batch: pa.RecordBatch, block: Anchors):
    """(places and ids and labels of anchors, ids and labels of rows, scores) tile by tile."""
    ids, labels = batch.column(0), batch.column(1)
    all_ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
    all_labels = labels.fill_null(0).to_numpy(zero_copy_only=False)
    for length, at, matrix in whole_vectors(batch.column(2), ids, labels):
        if length not in block.groups:
            continue
        places, a_ids, a_labels, anchors, longest = block.groups[length]
        step = max(1, TILE_SCORES // len(at))
        for k in range(0, len(places), step):
            some = slice(k, k + step)
            yield (places[some], a_ids[some], a_labels[some], all_ids[at], all_labels[at],
                   products(matrix, anchors[some], longest))


def _positives(shared, k: int):
    def run(batches):
        block = shared.value
        best = Best(len(block.ids), k)
        for batch in batches:
            for places, a_ids, a_labels, ids, labels, scores in _tiles(batch, block):
                row, col = np.nonzero((labels[:, None] == a_labels) & (ids[:, None] != a_ids)
                                      & (scores >= best.bar[places]))
                best.add(places[col], scores[row, col], ids[row])
        anchor, score, vec_id = best.settle()
        yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(score), pa.array(vec_id)],
                                         names=["anchor", "score", "vec_id"])
    return lean_task(run)


def _negatives(shared, k: int):
    def run(batches):
        block = shared.value
        slots = block.limits.shape[1]
        best = Best(len(block.ids) * slots, k)
        for batch in batches:
            for places, _, a_labels, ids, labels, scores in _tiles(batch, block):
                row, col = np.nonzero((labels[:, None] != a_labels) & (scores <= block.limits[places, -1])
                                      & (scores >= block.lowest[places]))
                score = scores[row, col]
                slot = (block.limits[places[col]] < score[:, None]).sum(axis=1)
                best.add(places[col] * slots + slot, score, ids[row])
        key, score, vec_id = best.settle()
        yield pa.RecordBatch.from_arrays([pa.array(key // slots), pa.array(key % slots), pa.array(score), pa.array(vec_id)],
                                         names=["anchor", "slot", "score", "vec_id"])
    return lean_task(run)


def _prepared(batches):
    """The anchors' rows with their vectors in whole numbers."""
    for batch in batches:
        for _, at, matrix in whole_vectors(batch.column(2), batch.column(0), batch.column(1)):
            some = pa.array(at)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(some), batch.column(1).take(some), pa.array([m.tobytes() for m in matrix], pa.binary())],
                names=["vec_id", "label", "vector"])


def _first(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The best ``k`` rows of each key; Spark keeps as many a task before it shuffles."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id")
    return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def _block(rows: DataFrame, anchors: DataFrame, positives: int, k: int, lower: int) -> DataFrame | None:
    spark = rows.sparkSession
    block = Anchors(anchors.mapInArrow(_prepared, "vec_id long, label long, vector binary")
                    .orderBy("vec_id", "label", "vector").collect())
    if not block.ids:
        return None
    shared = spark.sparkContext.broadcast(block)
    near = _first(rows.mapInArrow(_positives(shared, positives), "anchor long, score long, vec_id long"),
                  ["anchor"], positives).collect()
    scores: dict[int, list[int]] = {}
    for r in near:
        scores.setdefault(r["anchor"], []).append(r["score"])
    block.set_limits(scores, lower, positives)
    shared.unpersist()
    shared = spark.sparkContext.broadcast(block)
    slots = _first(rows.mapInArrow(_negatives(shared, k), "anchor long, slot long, score long, vec_id long"),
                   ["anchor", "slot"], k)
    # Slots in descending order are one list by descending score; at most positives x k entries an anchor.
    lists = slots.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct(
        (-F.col("score")).alias("down"), "vec_id"))).alias("list"))
    windows = spark.createDataFrame(
        [(r["anchor"], block.ids[r["anchor"]], r["vec_id"], r["score"]) for r in near],
        "w_anchor long, anchor_id long, positive_id long, positive_score long")
    # The lower limit in decimals, which scores of up to 2^62 do not overflow.
    rest = F.expr("slice(filter(list, x -> -x.down <= positive_score and "
                  f"{lower} * cast(positive_score as decimal(20)) <= -100 * cast(x.down as decimal(20))), 1, {k})")
    return (windows.join(lists, F.col("w_anchor") == F.col("anchor"))
            .select("anchor_id", "positive_id", "positive_score", F.posexplode(rest).alias("at", "x"))
            .select("anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"),
                    F.col("x.vec_id").alias("negative_id"), "positive_score", (-F.col("x.down")).alias("negative_score")))


OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(vectors: DataFrame, every: int = 100, positives: int = 5, k: int = 5, lower: int = 80,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, embedding and label.  Anchors are the rows whose
    ``vec_id`` is divisible by ``every``; each has up to ``positives``
    positives, and each of these up to ``k`` negatives, of at least ``lower``
    hundredths of its score.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                          F.col("embedding").alias("embedding"))
    rows = rows.where("vec_id is not null and label is not null and embedding is not null")
    anchors = rows.where(F.col("vec_id") % every == 0)
    size = anchors.agg(F.sum(8 * F.size("embedding") + 64)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    path, written = fresh_path(spark, "hard-negatives"), False
    for i in range(blocks):
        found = _block(rows, anchors.where(F.pmod(F.xxhash64("vec_id", F.lit(12)), F.lit(blocks)) == i), positives, k, lower)
        if found is not None:
            found.write.mode("append").parquet(path)
            written = True
    if not written:
        return spark.createDataFrame([], OUT)
    return spark.read.schema(OUT).parquet(path)
