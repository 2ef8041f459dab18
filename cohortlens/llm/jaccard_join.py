"""N-gram Jaccard join by grouped prefixes.

A set's prefix is its first ``n - ceil(t n) + 1`` shingles in a corpus-wide
order, rare ones first; two sets of similarity ``t`` share prefix tokens.
Sets with one prefix and one size are collapsed into a group, equal sets into
a class before that, so copies of any number cost one row from there on.

1. One pass over the texts gives each document's size, set digest and its
   shingles of a fixed quarter of the hash space (more if the quarter holds
   fewer than the prefix needs), packed into chunks of documents.
2. Chunks send their shingles, Golomb-coded, to owners of hash ranges, which
   count the documents of each over the whole corpus and answer with grades.
   The order is (in the quarter, grade, hash): a function of the shingle
   alone, so filtering by it loses no pair.  Shingles of a single document
   come first and need not be emitted at all.  One document of each class that
   shares a prefix token goes through both steps again, with all shingles in
   the order, which makes prefixes and positions far more selective.
3. Groups that share a token are candidates.  First every group of a token and
   size band is held against the band's most typical member, and every class
   against its group's first; the links found make components.  Then the lists
   that still hold several components give the other pairs, between
   components only.  Pairs within a component would not change it, so a list
   of thousands of near copies is never paired off.  A pair must pass the
   size filter, the position filter and a lower bound of the tokens that
   similar sets have in common in their prefixes.
4. Candidates are expanded to their members and verified on whole sets.

Defined cases: a null or empty text has no shingles and links with nothing;
rows that share a ``doc_id`` are one node; a row without ``doc_id`` is no node
and takes the component of an equal set, else null; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm import golomb
from cohortlens.llm.components import leaves
from cohortlens.llm.shared import (LEAST_PARTITIONS, bounded_batches, cut, discard, gathered, lean_task, stash, text_slices,
                                   with_ids, without_ids)
from cohortlens.llm.shingles import shingle_sets

#: Masks of the shingles that are counted and stand first in the order: those
#: of a quarter of the hash space in the first round, all in the second.
QUARTER, ALL = 3, 0
#: Shingles of a chunk of documents.
CHUNK_TOKENS = 1 << 18
#: Documents whose shingles an owner of a hash range counts at least, where there are more than a few owners.
DOCS_PER_OWNER = 4096
#: Counting goes by the upper bits of a shingle.
KEY_BITS = 48
#: Steps of set size between n and t n, by which tokens are matched.
FINE = 4
#: Parts into which a document's partners are dealt for verification.
VERIFY_PARTS = 64
#: Pairs that a task verifies, about.
PAIRS_PER_PARTITION = 1024

CHUNK = "chunk long, doc_ids array<long>, sizes binary, digests binary, counted binary, tokens binary, filled binary, fill binary"
SIGNATURE = ("doc_id long, n long, digest binary, prefix_key binary, typical float, pos array<int>, tokens array<long>")


def prefix_length(n: int, num: int, den: int) -> int:
    return n - -(-num * n // den) + 1


# ---- chunks of documents

def _chunks(size: int, num: int, den: int, mask: int):
    names = [x.split()[0] for x in CHUNK.split(", ")]

    def row(number, ids, sizes, digests, tokens, fill):
        ints = lambda x: np.array(x, "<i4").tobytes()
        flat = lambda x: np.concatenate([np.empty(0, np.uint64), *x]).tobytes()
        values = [number, ids, ints(sizes), b"".join(digests), ints([len(x) for x in tokens]), flat(tokens),
                  ints([len(x) for x in fill]), flat(fill)]
        kinds = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 6]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)

    def run(batches):
        part, number, held = TaskContext.get().partitionId(), 0, 0
        ids, sizes, digests, tokens, fill = [], [], [], [], []
        for piece in text_slices(batches, 1, 4 << 20):
            for doc_id, mine in zip(piece.column(0).to_pylist(), shingle_sets(piece.column(1), size), strict=True):
                first = (mine & np.uint64(mask)) == 0
                ids.append(doc_id)
                sizes.append(len(mine))
                digests.append(hashlib.blake2b(mine.tobytes(), digest_size=16).digest())
                tokens.append(mine[first])
                wanted = prefix_length(len(mine), num, den) if len(mine) else 0
                fill.append(mine[~first][:max(0, wanted - len(tokens[-1]))])
                held += len(tokens[-1])
                if held >= CHUNK_TOKENS:
                    yield row((part << 32) + number, ids, sizes, digests, tokens, fill)
                    number, held, ids, sizes, digests, tokens, fill = number + 1, 0, [], [], [], [], []
        if ids:
            yield row((part << 32) + number, ids, sizes, digests, tokens, fill)
    return run


# ---- in how many documents a shingle stands

def _span(owners: int) -> int:
    return -(-(1 << KEY_BITS) // owners)


def _keys(code: bytes) -> np.ndarray:
    return np.frombuffer(code, np.uint64) >> np.uint64(64 - KEY_BITS)


def _send(owners: int):
    span = _span(owners)

    def run(batches):
        for batch in batches:
            for chunk, code in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                keys, counts = np.unique(_keys(code), return_counts=True)
                owner = (keys // np.uint64(span)).astype(np.int64)
                cuts = np.flatnonzero(np.diff(owner, prepend=-1)).tolist()
                out = []
                for a, b in zip(cuts, [*cuts[1:], len(keys)], strict=False):  # no keys: no cuts
                    bits = golomb.parameter(span, b - a)
                    out.append((int(owner[a]), b - a, bits,
                                golomb.encode(keys[a:b] - np.uint64(owner[a] * span), bits), counts[a:b].astype("<u4").tobytes()))
                columns = list(zip(*out, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk] * len(out), pa.int64()), pa.array(columns[0], pa.int32()),
                     pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32()),
                     pa.array(columns[3], pa.binary()), pa.array(columns[4], pa.binary())],
                    names=["chunk", "owner", "n", "bits", "code", "counts"])
    return run


def _grade(table: pa.Table) -> pa.Table:
    """An owner: the chunks' shingles and counts in, a grade for each (0: one document) out."""
    rows = table.to_pylist()
    lists = [golomb.decode(r["code"], r["n"], r["bits"]) for r in rows]
    _, where = np.unique(np.concatenate(lists), return_inverse=True)
    total = np.bincount(where, weights=np.concatenate([np.frombuffer(r["counts"], "<u4") for r in rows]).astype(float))
    grades = np.ceil(4 * np.log2(total)).astype(np.uint8)[where]
    parts = np.split(grades, np.cumsum([len(x) for x in lists])[:-1])
    return pa.table({"chunk": pa.array([r["chunk"] for r in rows], pa.int64()),
                     "owner": pa.array([r["owner"] for r in rows], pa.int32()),
                     "grades": pa.array([p.tobytes() for p in parts], pa.binary())})


# ---- signatures and sets

def _sign(num: int, den: int):
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                tokens, fill = np.frombuffer(r["tokens"], np.uint64), np.frombuffer(r["fill"], np.uint64)
                known = np.frombuffer(b"".join(x["grades"] for x in sorted(r["answers"] or [], key=lambda x: x["owner"])), np.uint8)
                _, where = np.unique(_keys(r["tokens"]), return_inverse=True)
                grades = known[where] if len(where) else known
                sizes = np.frombuffer(r["sizes"], "<i4").tolist()
                a = b = 0
                keys, typical, places, prefixes = [], [], [], []
                for n, t, f in zip(sizes, np.frombuffer(r["counted"], "<i4").tolist(),
                                   np.frombuffer(r["filled"], "<i4").tolist(), strict=True):
                    own = grades[a:a + t]
                    order = np.argsort(own, kind="stable")[:prefix_length(n, num, den) if n else 0]
                    prefix = np.concatenate([tokens[a:a + t][order], fill[b:b + f]])
                    shared = np.concatenate([own[order] > 0, np.ones(f, bool)])
                    keys.append(hashlib.blake2b(prefix.tobytes() + n.to_bytes(8, "little"), digest_size=16).digest())
                    typical.append(float(own.mean()) if t else 0.0)
                    at = np.flatnonzero(shared)
                    places.append(at)
                    prefixes.append(prefix[at].view(np.int64))
                    a, b = a + t, b + f
                digests = [r["digests"][i:i + 16] for i in range(0, len(r["digests"]), 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                     pa.array(keys, pa.binary()), pa.array(typical, pa.float32()),
                     pa.array(places, pa.list_(pa.int32())), pa.array(prefixes, pa.list_(pa.int64()))],
                    names=["doc_id", "n", "digest", "prefix_key", "typical", "pos", "tokens"])
    return run


def signatures(docs: DataFrame, size: int, num: int, den: int, mask: int) -> DataFrame:
    """Size, digest, prefix key and the shared prefix tokens with their places, per document; ``measured["n"]`` counts them."""
    chunks = stash(docs.mapInArrow(lean_task(_chunks(size, num, den, mask)), CHUNK), "jaccard-chunks", n=F.sum(F.size("doc_ids")))
    n = chunks.measured["n"] or 0
    # A range of hashes for each shuffle partition, but none for a handful of documents.
    owners = max(1, min(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), max(LEAST_PARTITIONS, -(-n // DOCS_PER_OWNER))))
    sent = chunks.select("chunk", "tokens").mapInArrow(
        lean_task(_send(owners)), "chunk long, owner int, n int, bits int, code binary, counts binary")
    answers = (sent.groupBy("owner").applyInArrow(_grade, "chunk long, owner int, grades binary")
               .groupBy(F.col("chunk").alias("a_chunk")).agg(F.collect_list(F.struct("owner", "grades")).alias("answers")))
    joined = chunks.join(answers, F.col("chunk") == F.col("a_chunk"), "left").drop("a_chunk", "chunk")
    out = stash(gathered(joined, n).mapInArrow(lean_task(_sign(num, den)), SIGNATURE), "jaccard-signatures")
    out.measured = {"n": n}
    discard(chunks)
    return out


def _sets(size: int):
    def run(batches):
        for piece in text_slices(batches, 1, 4 << 20):
            codes = [x.tobytes() for x in shingle_sets(piece.column(1), size)]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(codes, pa.binary())],
                                             names=["doc_id", "members"])
    return run


# ---- verification

def _verify(num: int, den: int):
    """Rows sorted by (a, part), the sets of ``a`` first; gives the linked pairs."""
    def run(batches):
        key, centre = None, []
        for batch in batches:
            left, right = [], []
            for a, part, b, code in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if key != (a, part):
                    key, centre = (a, part), []
                mine = np.frombuffer(code, np.uint64)
                if b is None:
                    centre.append(mine)
                    continue
                for other in centre:
                    both = len(np.intersect1d(mine, other, assume_unique=True))
                    if den * both >= num * (len(mine) + len(other) - both):
                        left.append(a)
                        right.append(b)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])
    return run


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int, rows: int) -> DataFrame:
    """Those ``pairs`` (a, b; ``rows`` of them) whose sets reach the similarity num/den.

    A set travels once to each of its pairs' parts: the partners of ``a`` are
    dealt into parts, and the set of ``a`` goes once to each part.
    """
    parted = pairs.select("a", F.pmod(F.xxhash64("b"), F.lit(VERIFY_PARTS)).cast("int").alias("part"), "b")
    partners = parted.join(sets, parted["b"] == sets["doc_id"]).select("a", "part", "b", "members")
    centres = parted.select("a", "part").distinct()
    centres = centres.join(sets, centres["a"] == sets["doc_id"]).select(
        "a", "part", F.lit(None).cast("long").alias("b"), "members")
    dealt = partners.union(centres).repartition("a", "part").sortWithinPartitions("a", "part", F.asc_nulls_first("b"))
    return gathered(dealt, rows, PAIRS_PER_PARTITION).mapInArrow(lean_task(_verify(num, den)), "a long, b long")


# ---- the join

def _need(a: str, b: str, num: int, den: int) -> str:
    """The least overlap of two sets of similarity num/den."""
    return f"cast(ceil({num} * ({a}.n + {b}.n) / cast({num + den} as double) - 1e-9) as long)"


def _prefix(a: str, num: int, den: int) -> str:
    return f"({a}.n - cast(ceil({num} * {a}.n / cast({den} as double) - 1e-9) as long) + 1)"


def _sizes_fit(a: str, b: str, num: int, den: int) -> str:
    """Size and position filter: the overlap that is still possible reaches the one that is needed."""
    return (f"{den} * least({a}.n, {b}.n) >= {num} * greatest({a}.n, {b}.n)"
            f" and least({a}.n - {a}.pos, {b}.n - {b}.pos) >= {_need(a, b, num, den)}")


def _least_common(a: str, b: str, num: int, den: int) -> str:
    """Tokens that the prefixes of two similar sets have in common at least.

    Of the first k common tokens, the last stands at place k + (n - overlap)
    at most in either set.
    """
    need = _need(a, b, num, den)
    return f"least({_prefix(a, num, den)} - {a}.n, {_prefix(b, num, den)} - {b}.n) + {need}"


def _classes(signs: DataFrame, rows: int) -> DataFrame:
    """One row for each distinct set: its prefix and the smallest ``doc_id`` (rep)."""
    classes = signs.where("n > 0").groupBy("n", "digest", "prefix_key", "typical", "pos", "tokens").agg(F.min("doc_id").alias("rep"))
    return stash(gathered(classes.where("rep is not null"), rows), "jaccard-classes")


def _tokens(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The groups (sets of one prefix and size), and their tokens that more than one set holds."""
    groups = classes.groupBy("n", "prefix_key", "pos", "tokens").agg(
        F.min("rep").alias("gid"), F.count(F.lit(1)).alias("classes"), F.max("typical").alias("typical"))
    tokens = groups.select("gid", "n", "prefix_key", "classes", "typical", F.explode(F.arrays_zip("pos", "tokens")).alias("t")).select(
        "gid", "n", "prefix_key", "classes", "typical", F.col("t.pos").alias("pos"), F.col("t.tokens").alias("token"))
    shared = tokens.groupBy("token").agg(F.sum("classes").alias("held")).where("held > 1").select("token")
    return groups, tokens.join(shared, "token")


def jaccard_components(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id: one row for each row of ``docs``.

    Two documents link when ``den * intersection >= num * union`` of their sets
    of ``size``-word shingles; ``component_id`` is the smallest ``doc_id``
    reachable by links, the document's own included.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signs = signatures(docs, size, num, den, QUARTER)
    n = signs.measured["n"]
    classes = _classes(signs, n)
    groups, tokens = _tokens(classes)
    hit = tokens.select("n", "prefix_key").distinct()
    reps = classes.join(hit, ["n", "prefix_key"], "left_semi").select(F.col("rep").alias("doc_id"))

    # Again for one document of each class that has a token in common with
    # another, now in the order of all their shingles.
    signs2 = signatures(with_ids(docs, reps, rows=n), size, num, den, ALL)
    m = signs2.measured["n"]
    nodes = _classes(signs2, m)
    groups, tokens = _tokens(nodes)
    live = stash(gathered(tokens, m).withColumn(
        "band", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(den / num)) + 1e-9).cast("int")), "jaccard-tokens", n=F.count(F.lit(1)))

    # Stars: each group with the most typical of its token and band, each class with its group's first.
    best = live.groupBy("token", "band").agg(F.max(F.struct("typical", "gid")).alias("best")).select(
        F.col("token").alias("t"), F.col("band").alias("d"), F.col("best.gid").alias("hub"))
    near = (live.join(best, (F.col("token") == F.col("t")) & (F.col("band") == F.col("d")))
            .where("gid <> hub").select("hub", "gid").distinct())
    profile = stash(gathered(live.groupBy("gid").agg(F.first("n").alias("n"), F.collect_list("token").alias("own")), m),
                    "jaccard-profiles")
    stars = _share_enough(near.toDF("a", "b"), profile.withColumnRenamed("gid", "id"), num, den)
    member = nodes.select("rep", F.col("n").alias("m_n"), "prefix_key")
    first = groups.where("classes > 1").select("gid", "n", F.col("prefix_key").alias("p_key"))
    expanded = cut(gathered(member.join(first, (F.col("prefix_key") == F.col("p_key")) & (F.col("m_n") == F.col("n")))
                            .select("gid", "rep"), m))
    within = expanded.where("gid <> rep").select(F.col("gid").alias("a"), F.col("rep").alias("b"))
    stars = cut(gathered(stars.union(within), live.measured["n"] + m))
    links = _verified(stars, docs, size, num, den)
    parts = leaves(links, links.measured["n"])

    # What is left: pairs between components that share tokens, members expanded.
    # A token counts for a partner of a given size only if it stands early
    # enough for the overlap such a pair needs; sizes go by fine steps.
    ids = profile.select("gid").join(expanded.withColumnRenamed("gid", "e_gid"), F.col("gid") == F.col("e_gid"), "left")
    ids = ids.select("gid", F.coalesce("rep", "gid").alias("id")).join(parts, F.col("id") == F.col("node"), "left").select(
        F.col("gid").alias("i_gid"), "id", F.coalesce("component", "id").alias("part"))
    places = live.join(ids, F.col("gid") == F.col("i_gid")).select("token", "n", "pos", "id", "part")
    step = math.log(den / num) / FINE
    places = (places.withColumn("own", F.floor(F.log(F.col("n").cast("double")) / F.lit(step) + 1e-9).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.col("own") - FINE - 1, F.col("own") + FINE + 1)))
              .where(F.expr(f"n - pos + 1e-6 >= {num / (num + den)!r} * (n + exp(other * {step!r}))")))
    key = ["token", F.least("own", "other").alias("lower"), F.greatest("own", "other").alias("upper")]
    mixed = places.groupBy(*key).agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.min("own").alias("o_lo"),
                                     F.max("own").alias("o_hi")).where(
        "lo < hi and o_lo = lower and o_hi = upper").select(
        F.col("token").alias("t"), F.col("lower").alias("l"), F.col("upper").alias("u"))
    open_ = stash(places.join(mixed, (F.col("token") == F.col("t")) & (F.least("own", "other") == F.col("l"))
                              & (F.greatest("own", "other") == F.col("u")), "left_semi"), "jaccard-open", n=F.count(F.lit(1)))
    if open_.measured["n"]:
        rest = cut(_between(open_, ids, stars, profile, num, den))
        if rest.measured["n"]:
            more = _verified(rest, docs, size, num, den)
            parts = leaves(parts.toDF("a", "b").union(more), m + more.measured["n"])

    found = stash(gathered(classes.join(parts, F.col("rep") == F.col("node"), "left").select(
        F.col("digest").alias("c_digest"), F.coalesce("component", "rep").alias("part")), n), "jaccard-found")
    discard(classes, nodes, signs2, live, profile, open_)
    return signs.join(found, F.col("digest") == F.col("c_digest"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("part")).alias("component_id"))


def _between(open_: DataFrame, ids: DataFrame, tried: DataFrame, profile: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of different components in the open lists that may be similar and were not ``tried``."""
    held = open_.groupBy("token", "own", "other", "part").agg(F.max(F.col("n") - F.col("pos")).alias("room"),
                                                             F.min("n").alias("least"))
    p, q = held.alias("p"), held.alias("q")
    beside = p.join(q, F.expr(
        "p.token = q.token and p.own = q.other and p.other = q.own and p.part < q.part"
        f" and {den + num} * least(p.room, q.room) >= {num} * (p.least + q.least)")).select(
        F.col("p.token").alias("token"), F.col("p.own").alias("own"), F.col("p.other").alias("other"),
        F.col("p.part").alias("part_p"), F.col("q.part").alias("part_q"))
    u, v, w = open_.alias("u"), open_.alias("v"), beside.alias("w")
    pairs = (w.join(u, F.expr("w.token = u.token and w.own = u.own and w.other = u.other and w.part_p = u.part"))
             .join(v, F.expr("w.token = v.token and w.own = v.other and w.other = v.own and w.part_q = v.part and "
                             + _sizes_fit("u", "v", num, den)))
             .select(F.least("u.id", "v.id").alias("a"), F.greatest("u.id", "v.id").alias("b")).distinct())
    tried = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = pairs.join(tried, ["a", "b"], "left_anti")
    return _share_enough(rest, ids.join(profile, F.col("i_gid") == F.col("gid")).select("id", "n", "own"), num, den)


def _share_enough(pairs: DataFrame, profiles: DataFrame, num: int, den: int) -> DataFrame:
    """Those ``pairs`` (a, b) whose prefixes share as many tokens as similar sets of their sizes must."""
    x, y = profiles.alias("x"), profiles.alias("y")
    enough = (f"{den} * least(x.n, y.n) >= {num} * greatest(x.n, y.n)"
              f" and size(array_intersect(x.own, y.own)) >= {_least_common('x', 'y', num, den)}")
    return (pairs.alias("s").join(x, F.expr("s.a = x.id")).join(y, F.expr("s.b = y.id")).where(F.expr(enough))
            .select("s.a", "s.b"))


def _verified(pairs: DataFrame, docs: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """Read the texts of the paired documents again and verify the pairs on their sets."""
    rows = pairs.measured["n"]
    involved = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    sets = stash(with_ids(docs, involved, rows=2 * rows).mapInArrow(lean_task(_sets(size)), "doc_id long, members binary"), "jaccard-sets")
    links = cut(verified(pairs, sets, num, den, rows))
    discard(sets)
    return links


def drop_near_copies(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the document with the smallest ``doc_id``.

    Rows without ``doc_id`` stay.
    """
    found = jaccard_components(docs, size, num, den)
    return without_ids(docs, found.where("doc_id <> component_id").select("doc_id"))
