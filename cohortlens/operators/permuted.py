"""AUCs of a linear score after one of its columns was permuted, for many permutations.

A row takes the value of the row that a keyed bijection (``bijection``) names.
A task sends the values of its rows to where the inverse bijection puts them, as
packs by (block of places, column, permutation); a block's new margins are then
packed by score (``packed_auc``), so no row is shuffled for itself.  Values equal
to a column's usual one are not sent: a place that gets none has that one.

All permutations at once would shuffle rows x columns x permutations.  They are
taken in rounds instead, and a round's shuffle files go before the next one, so
the disk holds one round: ``ROUND_VALUES`` values, or ``LEAST`` permutations of
each column where there are more rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators import packed_auc as pk
from cohortlens.operators.bijection import AGAIN, PRIME, ROUNDS, TIMES, domain, permutation_keys
from cohortlens.session import freed_shuffles

#: Places of a block at most; a place in its block is two bytes.
BLOCK = 1 << 16
#: Values that the task of one block takes in a round, about.
BLOCK_VALUES = 4_000_000
#: Values of one round, about.
ROUND_VALUES = 100_000_000
#: Permutations of each column in a round at least.
LEAST = 2
#: Rows of a task that are sent at a time: the more, the fewer packs.
SENT = 4 * pk.SLICE
MOVED = "block int, j int, r int, place binary, value binary, side binary"
#: The permutation number of a block's own rows, and the column number of their margins.
OWN = -1


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    t = ((x + 1) * TIMES + key) % PRIME
    return ((t * t) % PRIME * AGAIN + key) % PRIME


def sent_back(place: np.ndarray, keys: list[int], n: int) -> np.ndarray:
    """The number that ``bijection.permute`` sends to ``place``."""
    a, b = domain(n)

    def once(x):
        left, right = x % a, x // a
        for i in range(ROUNDS - 1, -1, -1):
            if i % 2:
                right = (right - _mixed(left, keys[i])) % b
            else:
                left = (left - _mixed(right, keys[i])) % a
        return left + a * right
    out = once(place.astype(np.int64))
    while (over := np.flatnonzero(out >= n)).size:
        out[over] = once(out[over])
    return out


def _round(x: np.ndarray, digits: int | None) -> np.ndarray:
    """Half away from zero, as Spark and DuckDB round."""
    if digits is None:
        return x
    unit = 10.0 ** digits
    return np.copysign(np.floor(np.abs(x) * unit + 0.5), x) / unit


def permuted_aucs(rows: DataFrame, n: int, weights: list[float], repeats: int, seed: int, digits: int | None = None,
                  rows_per_bucket: int = pk.ROWS_PER_BUCKET, block: int | None = None, round_values: int = ROUND_VALUES) -> DataFrame:
    """(j, r, auc) for ``rows`` (pos 0 .. n-1, y, margin, x0, x1, ...); j = len(weights) is the score as it is.

    The rounds run here; what comes back is a row for each column and permutation."""
    spark, width = rows.sparkSession, len(weights)
    values = [f"x{j}" for j in range(width)]
    with freed_shuffles(spark):
        usual = rows.agg(*[F.percentile_approx(c, 0.5, 100).alias(c) for c in values]).first()
    usual = [0.0 if usual[c] is None else float(usual[c]) for c in values]
    at_once = min(repeats, max(LEAST, round_values // max(1, n * width)))
    if block is None:
        block = min(BLOCK, max(1024, 1 << (BLOCK_VALUES // max(1, width * at_once)).bit_length() - 1))

    def move(which):
        keys = {(j, r): permutation_keys(seed, j, r) for j in range(width) for r in which}

        def run(batches):
            for table in pk.slices(batches, SENT):
                pos = table.column("pos").to_numpy().astype(np.int64)
                y = table.column("y").to_numpy().astype(float)
                side = np.where(y == 1, 1, np.where(y == 0, 0, pk.NONE)).astype(np.int8)

                def cut(j, r, place, value, sides=None):
                    by = np.argsort(place, kind="stable")
                    place, value = place[by], value[by]
                    at = place // block
                    blocks, first = np.unique(at, return_index=True)
                    for b, lo, hi in zip(blocks, first, np.r_[first[1:], len(at)]):
                        yield (int(b), j, r, (place[lo:hi] - b * block).astype(np.uint16).tobytes(), value[lo:hi].tobytes(),
                               None if sides is None else sides[by][lo:hi].tobytes())
                yield _batch(list(cut(OWN, OWN, pos, table.column("margin").to_numpy(), side)))
                for j in range(width):
                    x = table.column(values[j]).to_numpy()
                    other = np.flatnonzero(x != usual[j])
                    packs = list(cut(j, OWN, pos[other], x[other]))
                    for r in which:
                        packs += cut(j, r, sent_back(pos[other], keys[j, r], n), x[other])
                    yield _batch(packs)
        return rows.select("pos", "y", "margin", *values).mapInArrow(run, MOVED)

    def changed(table: pa.Table, which, base: bool):
        """(number, scores, classes) of a block."""
        got: dict[tuple[int, int], list[int]] = {}
        for i, key in enumerate(zip(table.column("j").to_pylist(), table.column("r").to_pylist())):
            got.setdefault(key, []).append(i)
        columns = {c: table.column(c) for c in ("place", "value", "side")}
        read = lambda c, at, t: np.frombuffer(b"".join(columns[c][i].as_py() for i in at), t)
        mine = got[OWN, OWN]
        place = read("place", mine, np.uint16)
        margin, side = (np.zeros(int(place.max()) + 1) for _ in range(2))
        margin[place], side[place] = read("value", mine, float), read("side", mine, np.int8)
        ok = side != pk.NONE
        side = side[ok].astype(np.int8)
        if base:
            yield width * repeats, _round(margin, digits)[ok], side

        def placed(j, r):
            v = np.full(len(margin), usual[j])
            if (j, r) in got:
                v[read("place", got[j, r], np.uint16)] = read("value", got[j, r], float)
            return v
        for j in range(width):
            x = placed(j, OWN)
            for r in which:
                yield j * repeats + r, _round(margin + weights[j] * (placed(j, r) - x), digits)[ok], side

    bounds = {}
    buckets = min(pk.MAX_BUCKETS, -(-n // rows_per_bucket))
    if buckets > 1 and width:
        # The permutations of one column have much the same scores: the bounds of the first one serve all.
        def sketch(table):
            found = [(number, np.sort(s)[min(pk.STEP, len(s)) // 2::pk.STEP].tolist()) for number, s, _ in changed(table, [0], True)]
            return pa.Table.from_arrays([pa.array([i for i, _ in found], pa.int32()), pa.array([s for _, s in found], pa.list_(pa.float64()))],
                                        names=["number", "s"])
        probs = [(i + 1) / buckets for i in range(buckets - 1)]
        with freed_shuffles(spark):
            sketched = move([0]).groupBy("block").applyInArrow(sketch, "number int, s array<double>")
            for row in sketched.select("number", F.explode("s").alias("s")).where("not isnan(s)").groupBy("number").agg(
                    F.percentile_approx("s", probs, 10_000).alias("b")).collect():
                bounds[row["number"] // repeats] = np.unique(row["b"]).astype(float)
    nans = max(map(len, bounds.values()), default=0) + 2
    none = np.zeros(0)

    def score(which, base):
        def run(table):
            packs = []
            for number, s, side in changed(table, which, base):
                own = bounds.get(number // repeats, none)
                packs += [(p[0], nans if p[1] == len(own) + 2 else p[1], *p[2:])
                          for p in (pk.pack(number, s, None, side, np.zeros((len(s), 1), np.int8), 1, own) if len(s) else ())]
            return pa.Table.from_batches([pk.batch_of(packs)])
        return run

    found = []
    for start in range(0, max(repeats, 1), max(at_once, 1)):
        which = range(start, min(start + at_once, repeats))
        with freed_shuffles(spark):
            packs = move(which).groupBy("block").applyInArrow(score(which, not start), pk.PACK)
            found += [(r["number"] // repeats if repeats else width, r["number"] % repeats if repeats else 0, r["auc"])
                      for r in pk.packed_aucs(packs, 1, 1, nans).select("number", "auc").collect()]
    return spark.createDataFrame(found, "j int, r int, auc double")


def _batch(packs: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32()] * 3 + [pa.binary()] * 3
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in packs], t) for i, t in enumerate(kinds)],
                                      names=[c.split()[0] for c in MOVED.split(", ")])
