"""Near-duplicate documents by min-max hashing.

Every permutation of the shingles (an odd multiplier and a shift modulo 2^64)
is evaluated once and gives two values, the least and the greatest: half the
evaluations of a signature of as many least values.  Either value agrees
between two sets with the probability of their similarity, and the two agree
less often together than apart, so the share of agreeing values is an unbiased
estimate of a lower variance.

1. One pass over the texts gives each document's set size, set digest and
   signature of 160 values (80 permutations).  Equal sets become one class.
2. Bands of five values of different permutations, 16 of least and 16 of
   greatest values, are the buckets.  A pair of similarity 0.85 shares none of
   the 32 with a probability of 7e-9.
3. Each class is held against the first class (the hub) of that bucket of its
   own whose hub has the best estimate.  The links make components, so a bucket
   of very many near copies falls together without being paired off.
4. Buckets that still hold several components are dealt into blocks, and every
   pair of blocks is one group of rows.  A group compares signatures only
   between components, each pair in its first common bucket, and drops
   estimates of five standard deviations below the limit and less.  The sets
   of what is left meet in the group again; pairs of components that a link
   has joined meanwhile are passed over.  A group gives one link for each two
   components it joins, at most.

All links are confirmed on full sets.

Defined cases: a null or empty text, or one without words, has no shingles and
links with nothing; rows that share a ``doc_id`` are one node; a row without
``doc_id`` is no node, takes the component of an equal set (else null) and is
kept; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.components import components
from cohortlens.llm.shared import bounded_batches, discard, lean_task, stash, text_slices, with_ids
from cohortlens.llm.shingles import mix, shingle_sets

#: Permutations; each gives two values.
PERMUTATIONS = 80
#: Values of a band.
BAND = 5
BANDS = 2 * PERMUTATIONS // BAND
#: Standard deviations of the estimate below the limit from which on a pair is dropped.
DEVIATIONS = 5
#: Classes of a block of a bucket; a group of rows has two blocks at most.
BLOCK = 256
#: Shingles that are hashed at a time.
CHUNK = 1 << 15


def _series(name: bytes) -> np.ndarray:
    """A 64-bit number for each permutation, derived from its place."""
    return np.array([int.from_bytes(hashlib.sha256(name + b" %d" % i).digest()[:8], "little") for i in range(PERMUTATIONS)],
                    np.uint64)


_TIMES, _PLUS = _series(b"times") | np.uint64(1), _series(b"plus")


def least_agreement(num: int, den: int) -> int:
    """Agreeing values that two signatures must have at least."""
    t, values = num / den, 2 * PERMUTATIONS
    return max(1, math.ceil(values * (t - DEVIATIONS * math.sqrt(t * (1 - t) / values))))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Least, then greatest values (16 bits of each) of non-empty ``sets`` under all permutations."""
    out = np.empty((len(sets), 2 * PERMUTATIONS), np.uint16)
    sizes = np.array([len(s) for s in sets], np.int64)
    ends = np.cumsum(sizes)
    k = 0
    while k < len(sets):
        stop = max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + CHUNK, side="right")))
        flat = np.concatenate(sets[k:stop])
        starts = np.cumsum(sizes[k:stop]) - sizes[k:stop]
        low = np.empty((PERMUTATIONS, stop - k), np.uint64)
        high = np.empty((PERMUTATIONS, stop - k), np.uint64)
        for i in range(PERMUTATIONS):
            values = flat * _TIMES[i] + _PLUS[i]
            np.minimum.reduceat(values, starts, out=low[i])
            np.maximum.reduceat(values, starts, out=high[i])
        out[k:stop] = (mix(np.concatenate([low, high])) >> np.uint64(48)).astype(np.uint16).T
        k = stop
    return out


def _sign(size: int):
    def run(batches):
        for piece in text_slices(batches, 1, 4 << 20):
            sets = shingle_sets(piece.column(1), size)
            full = [i for i, s in enumerate(sets) if len(s)]
            codes: list[bytes | None] = [None] * len(sets)
            for i, row in zip(full, signatures([sets[i] for i in full]), strict=True):
                codes[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                 pa.array(codes, pa.binary())], names=["doc_id", "n", "digest", "code"])
    return lean_task(run)


def _sets(size: int):
    def run(batches):
        for piece in text_slices(batches, 1, 4 << 20):
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array([s.tobytes() for s in shingle_sets(piece.column(1), size)], pa.binary())],
                names=["set_id", "members"])
    return lean_task(run)


def _groups(batches, keys: int):
    """Lists of rows (tuples) that agree in their first ``keys`` columns, from batches sorted by these."""
    key, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:keys] != key:
                if held:
                    yield held
                key, held = row[:keys], []
            held.append(row)
    if held:
        yield held


# ---- estimates

def _agreement(batches):
    """How many values of two signatures agree."""
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, 2 * PERMUTATIONS) for i in (2, 3))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array((a == b).sum(axis=1), pa.int32())], names=["rep", "hub", "agree"])


def _promising(least: int):
    """Groups (band, key, lo, hi) of classes in; each class that has partners in another component, and them, out."""
    names = ["band", "key", "lo", "hi", "rep", "part", "partners"]

    def run(batches):
        out: list[tuple] = []
        for rows in _groups(batches, 4):
            band, _, lo, hi = rows[0][:4]
            reps, parts = np.array([r[4] for r in rows]), np.array([r[5] for r in rows])
            upper = np.array([r[6] != lo for r in rows])
            codes = np.frombuffer(b"".join(r[7] for r in rows), np.uint16).reshape(len(rows), 2 * PERMUTATIONS)
            a, b = (np.flatnonzero(~upper), np.flatnonzero(upper)) if lo != hi else (np.arange(len(rows)),) * 2
            allowed = parts[a][:, None] != parts[b]
            if lo == hi:
                allowed &= reps[a][:, None] < reps[b]
            if not allowed.any():
                continue
            agree = np.zeros((len(a), len(b)), np.int16)
            # A band at a time for large groups, all values at once for small ones.
            step = BAND if len(a) * len(b) > 4096 else 2 * PERMUTATIONS
            for c in range(0, 2 * PERMUTATIONS, step):
                same = codes[a, c:c + step][:, None] == codes[b, c:c + step]
                agree += same.sum(axis=2, dtype=np.int16)
                if c < band * BAND:  # pairs that met in an earlier bucket
                    earlier = same[:, :, :max(0, min(step, band * BAND - c))]
                    allowed &= ~earlier.reshape(len(a), len(b), -1, BAND).all(axis=3).any(axis=2)
            x, y = np.nonzero(allowed & (agree >= least))
            if not len(x):
                continue
            best = np.lexsort((-agree[x, y], x))
            x, y = x[best], y[best]
            cuts = np.flatnonzero(np.diff(x, prepend=-1)).tolist()
            partners = {int(a[x[i]]): reps[b[y[i:j]]].tolist() for i, j in zip(cuts, [*cuts[1:], len(x)], strict=True)}
            for i in sorted({*partners, *b[y].tolist()}):
                out.append((*rows[i][:6], partners.get(i, [])))
            if len(out) > 4096:
                yield _rows(out, names)
                out = []
        yield _rows(out, names)

    def _rows(out, names):
        columns = list(zip(*out, strict=True)) or [()] * 7
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)
    return lean_task(run)


# ---- full sets

def similar(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    """Whether two ascending sets reach the similarity num/den."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x) or den * len(x) < num * len(y):
        return False
    both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return den * both >= num * (len(x) + len(y) - both)


def _confirm(keys: int, num: int, den: int):
    """Groups of (keys.., id, component, partners, set) in; links that join components out."""
    def run(batches):
        left, right = [], []
        for rows in _groups(batches, keys):
            sets: dict[int, list] = {}
            above: dict[int, int] = {}
            part: dict[int, int] = {}
            wanted: dict[int, list] = {}
            for row in rows:
                rep, component, partners, members = row[keys:]
                sets.setdefault(rep, []).append(np.frombuffer(members, np.uint64))
                part[rep] = component
                wanted[rep] = partners

            def top(x, above=above):
                while above.get(x, x) != x:
                    above[x] = above.get(above[x], above[x])
                    x = above[x]
                return x
            for rep, partners in wanted.items():
                for other in partners:
                    p, q = top(part[rep]), top(part[other])
                    if p != q and any(similar(x, y, num, den) for x in sets[rep] for y in sets[other]):
                        above[p] = q
                        left.append(rep)
                        right.append(other)
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])
    return lean_task(run)


def confirmed(members: DataFrame, keys: list[str], docs: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """Links (a, b) between the rows' ids and their partners, confirmed on full sets group by group.

    ``members`` has the columns of ``keys``, rep, part and partners; the texts
    of the ids in it are read again.
    """
    sets = stash(with_ids(docs, members.select(F.col("rep").alias("doc_id")).distinct())
                 .mapInArrow(_sets(size), "set_id long, members binary"), "minmax-sets")
    rows = members.join(sets, F.col("rep") == F.col("set_id")).select(*keys, "rep", "part", "partners", "members")
    links = stash(rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_confirm(len(keys), num, den), "a long, b long"),
                  "minmax-links")
    discard(sets)
    return links


# ---- the operator

def near_duplicates(docs: DataFrame, size: int = 5, num: int = 85, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of ``docs``.

    Two documents link when ``den * intersection >= num * union`` of their sets
    of ``size``-word shingles; ``component_id`` is the smallest ``doc_id``
    reachable by links, the document's own included, and that document is kept.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signs = stash(docs.mapInArrow(_sign(size), "doc_id long, n long, digest binary, code binary"), "minmax-signs")
    classes = stash(signs.where("n > 0").groupBy("n", "digest").agg(
        F.min("doc_id").alias("rep"), F.first("code").alias("code"), F.count(F.lit(1)).alias("copies"))
        .where("rep is not null"), "minmax-classes")
    least = least_agreement(num, den)

    width = 2 * BAND
    keys = classes.select("rep", F.posexplode(F.expr(
        f"transform(sequence(0, {BANDS - 1}), k -> xxhash64(k, substring(code, k * {width} + 1, {width})))")).alias("band", "key"))
    hubs = keys.groupBy("band", "key").agg(F.min("rep").alias("hub"), F.max("rep").alias("last")).where("hub < last")
    live = stash(keys.join(hubs.select("band", "key", "hub"), ["band", "key"]).select("band", "key", "rep", "hub"), "minmax-buckets")

    # Each class with the best of its hubs.
    codes = classes.select(F.col("rep").alias("c_rep"), "code")
    pairs = live.where("rep <> hub").select("rep", "hub").distinct()
    pairs = (pairs.join(codes, F.col("rep") == F.col("c_rep")).select("rep", "hub", F.col("code").alias("own"))
             .join(codes, F.col("hub") == F.col("c_rep")).select("rep", "hub", "own", "code"))
    best = (pairs.mapInArrow(lean_task(_agreement), "rep long, hub long, agree int").where(F.col("agree") >= least)
            .groupBy("rep").agg(F.max(F.struct("agree", (-F.col("hub")).alias("hub"))).alias("best"))
            .select("rep", (-F.col("best.hub")).alias("hub")))
    best = stash(best, "minmax-stars")
    many = best.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) * 2 / BLOCK).cast("int").alias("parts")).withColumnRenamed("hub", "h")
    spokes = best.join(many, F.col("hub") == F.col("h")).select(
        "hub", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int").alias("deal"), "rep", F.array("hub").alias("partners"))
    centres = many.select(F.col("h").alias("hub"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("deal"),
                          F.col("h").alias("rep"), F.array().cast("array<bigint>").alias("partners"))
    stars = spokes.unionByName(centres).select("hub", "deal", "rep", F.col("rep").alias("part"), "partners")
    links = confirmed(stars, ["hub", "deal"], docs, size, num, den)
    # Rows of one id with different sets are one node.
    split = signs.where("n > 0").groupBy("doc_id").agg(F.min("digest").alias("d"), F.max("digest").alias("e")).where("d <> e")
    own = (signs.join(split.select(F.col("doc_id").alias("s_id")), F.col("doc_id") == F.col("s_id"))
           .join(classes.select(F.col("digest").alias("c_digest"), "rep"), F.col("digest") == F.col("c_digest"))
           .select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    links = links.unionByName(own)
    parts = components(links)

    # Buckets of several components, in pairs of blocks.
    placed = live.join(parts, F.col("rep") == F.col("node"), "left").select(
        "band", "key", "rep", F.coalesce("component", "rep").alias("part"))
    mixed = (placed.groupBy("band", "key").agg(F.min("part").alias("l"), F.max("part").alias("m"), F.count(F.lit(1)).alias("held"))
             .where("l < m").select("band", "key", F.ceil(F.col("held") / BLOCK).cast("int").alias("blocks")))
    block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    dealt = (placed.join(mixed, ["band", "key"]).withColumn("block", block)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("band", "key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
                     "rep", "part", "block"))
    dealt = dealt.join(codes, F.col("rep") == F.col("c_rep")).select(
        "band", "key", "lo", "hi", "rep", "part", "block", "code")
    group = ["band", "key", "lo", "hi"]
    open_ = stash(dealt.repartition(*group).sortWithinPartitions(*group).mapInArrow(
        _promising(least), "band int, key long, lo int, hi int, rep long, part long, partners array<long>"), "minmax-open")
    if not open_.isEmpty():
        more = confirmed(open_, group, docs, size, num, den)
        parts = components(parts.where("node <> component").select(
            F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))

    found = stash(classes.join(parts, F.col("rep") == F.col("node"), "left").where("copies > 1 or node is not null").select(
        F.col("digest").alias("c_digest"), F.coalesce("component", "rep").alias("component")), "minmax-found")
    discard(live, best, open_)
    own = F.when((F.col("n") > 0) & F.col("component").isNotNull(), F.col("component")).otherwise(F.col("doc_id"))
    return signs.join(found, F.col("digest") == F.col("c_digest"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"),
        F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))
