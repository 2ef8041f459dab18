"""Exact de-duplication by a Golomb-coded fingerprint exchange.

Every scan task (a sender) hashes its texts, sorts the 48-bit fingerprints and
sends each owner (an equal range of the fingerprint space) its part as one
Golomb-coded block.  An owner unites the blocks and answers each sender with a
bitmap: which of its fingerprints another sender has too.  Rows with a marked
or locally repeated fingerprint are suspects; only their texts are shuffled,
and grouped by the whole text, so a suspect is a copy only if its bytes agree.

Defined cases: a null text counts as empty; empty texts are equal to each
other; a null ``doc_id`` is smaller than any other; of fully repeated rows
(same text and largest ``doc_id``) exactly one stays; an empty table gives an
empty result; further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm import golomb
from cohortlens.llm.shared import bounded_batches, cut, lean_task, texts_of, with_ids, without_ids
from cohortlens.operators.salted import salted_join

FINGERPRINT_BITS = 48
#: Rows that a sender sorts at a time.
SENDER_ROWS = 1 << 20
#: Fingerprints (with copies of one) that an owner compares at a time.
OWNER_ROWS = 1 << 21
#: Ids of suspects that may be broadcast (8 bytes each); beyond it texts and ids are shuffled to meet.
BROADCAST_SUSPECTS = 1_000_000

BLOCK = ("sender long, owner int, n int, bits int, code binary, uids array<long>, "
         "doc_ids array<long>, digests binary, member binary")


def normalise(text: bytes) -> bytes:
    """Lower-case A-Z only."""
    return text.lower()


def _fingerprints(digests: list[bytes]) -> np.ndarray:
    heads = np.frombuffer(b"".join(d[:8] for d in digests), ">u8")
    return heads.astype(np.uint64) >> np.uint64(64 - FINGERPRINT_BITS)


def _span(owners: int) -> int:
    return -(-(1 << FINGERPRINT_BITS) // owners)


def _send(owners: int):
    span = _span(owners)

    def block_rows(sender: int, ids: list, digests: list[bytes]):
        prints = _fingerprints(digests)
        order = np.argsort(prints, kind="stable")
        prints = prints[order]
        owner = (prints // np.uint64(span)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(owner, prepend=-1))
        out = {k: [] for k in ("sender", "owner", "n", "bits", "code", "uids", "doc_ids", "digests", "member")}
        for a, b in zip(cuts, [*cuts[1:], len(prints)], strict=True):
            mine, member = np.unique(prints[a:b], return_inverse=True)
            bits = golomb.parameter(span, len(mine))
            rows = order[a:b]
            out["sender"].append(sender)
            out["owner"].append(int(owner[a]))
            out["n"].append(len(mine))
            out["bits"].append(bits)
            out["code"].append(golomb.encode(mine - np.uint64(owner[a] * span), bits))
            out["uids"].append((rows + (sender << 20)).tolist())
            out["doc_ids"].append([ids[i] for i in rows])
            out["digests"].append(b"".join(digests[i] for i in rows))
            out["member"].append(member.astype("<i4").tobytes())
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()),
                 pa.list_(pa.int64()), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)],
                                          names=list(out))

    def run(batches):
        part = TaskContext.get().partitionId()
        flush, ids, digests = 0, [], []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            digests += [hashlib.sha256(normalise(t)).digest() for t in texts_of(batch.column(1))]
            while len(ids) >= SENDER_ROWS:
                yield block_rows((part << 20) | flush, ids[:SENDER_ROWS], digests[:SENDER_ROWS])
                flush, ids, digests = flush + 1, ids[SENDER_ROWS:], digests[SENDER_ROWS:]
        if ids:
            yield block_rows((part << 20) | flush, ids, digests)

    return run


def _answer(table: pa.Table) -> pa.Table:
    """An owner: the blocks of all senders in, a bitmap for each sender out."""
    rows = table.to_pylist()
    lists = [golomb.decode(r["code"], r["n"], r["bits"]) for r in rows]
    _, where, count = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    marked = np.split(count[where] > 1, np.cumsum([len(x) for x in lists])[:-1])
    return pa.table({"sender": pa.array([r["sender"] for r in rows], pa.int64()),
                     "owner": pa.array([r["owner"] for r in rows], pa.int32()),
                     "marks": pa.array([np.packbits(m).tobytes() for m in marked], pa.binary())})


def _unpack(batches):
    """Blocks with their bitmaps in, one row per document out."""
    for batch in batches:
        for r in batch.to_pylist():
            member = np.frombuffer(r["member"], "<i4")
            marks = np.unpackbits(np.frombuffer(r["marks"], np.uint8), count=r["n"]).astype(bool)
            suspect = marks[member] | (np.bincount(member, minlength=r["n"])[member] > 1)
            digests = [r["digests"][i:i + 32] for i in range(0, len(r["digests"]), 32)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(r["uids"], pa.int64()), pa.array(r["doc_ids"], pa.int64()),
                 pa.array(digests, pa.binary()), pa.array(suspect)],
                names=["uid", "doc_id", "digest", "suspect"])


def _texts(batches):
    """Normalised texts with their digests."""
    for batch in batches:
        texts = [normalise(t) for t in texts_of(batch.column(0))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()), pa.array(texts, pa.binary())],
            names=["digest", "body"])


def fingerprint_table(docs: DataFrame, owners: int | None = None) -> DataFrame:
    """One row per document: uid, doc_id, digest (SHA-256), suspect (may have a copy)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    owners = owners or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // OWNER_ROWS))
    blocks = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lean_task(_send(owners)), BLOCK))
    answers = (blocks.select("sender", "owner", "n", "bits", "code")
               .groupBy("owner").applyInArrow(_answer, "sender long, owner int, marks binary"))
    joined = (blocks.select("sender", "owner", "n", "uids", "doc_ids", "digests", "member")
              .join(answers, ["sender", "owner"]))
    return cut(joined.mapInArrow(lean_task(_unpack), "uid long, doc_id long, digest binary, suspect boolean"))


def exact_groups(docs: DataFrame, broadcast_suspects: int = BROADCAST_SUSPECTS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row for each row of ``docs``."""
    rows = fingerprint_table(docs)
    suspects = rows.where("suspect")
    groups = suspects.groupBy("digest").agg(
        F.max(F.struct("doc_id", "uid")).alias("last"), F.count(F.lit(1)).alias("group_size"))
    groups = cut(groups.where("group_size > 1"))

    shown = rows.select("uid", "doc_id", F.lower(F.hex("digest")).alias("text_sha256"), "suspect")
    single = [F.col("doc_id"), F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
              F.lit(True).alias("kept"), F.col("text_sha256")]
    if not groups.measured["n"]:
        return shown.select(*single)
    # Only the texts of suspects are read again; the ids go to the texts, broadcast if they are few.
    texts = with_ids(docs.select("doc_id", "text"), suspects.select("doc_id").distinct(), most=broadcast_suspects)
    texts = texts.select("text").mapInArrow(lean_task(_texts), "digest binary, body binary")
    # The byte check: the shuffle key is the whole text, combined before it is dealt out.
    bodies = texts.groupBy("digest", "body").agg(F.count(F.lit(1)).alias("copies"))
    checked = bodies.groupBy("digest").agg(F.count(F.lit(1)).alias("bodies"), F.sum("copies").alias("copies"))

    keepers = (groups.join(checked, "digest", "left")
               .select(F.lower(F.hex("digest")).alias("text_sha256"), "last", "group_size",
                       F.when((F.col("bodies") == 1) & (F.col("copies") == F.col("group_size")), True)
                       .otherwise(F.raise_error(F.lit("different texts share a SHA-256 digest")).cast("boolean"))
                       .alias("sure"))
               .where("sure"))
    # One large group may hold much of the suspects.
    grouped = salted_join(shown.where("suspect"), keepers, "text_sha256", "left").select(
        "doc_id", F.when(F.col("last").isNull(), F.col("doc_id")).otherwise(F.col("last.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("last.uid") == F.col("uid"), F.lit(True)).alias("kept"), "text_sha256")
    return shown.where("not suspect").select(*single).unionByName(grouped)


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each group of equal texts.

    Rows go by their ``doc_id``.  Only where rows that share a ``doc_id`` differ
    in whether they stay (repeated rows) the digest of the text decides too.
    """
    groups = cut(exact_groups(docs).select("doc_id", "kept", "text_sha256"))
    ids = groups.groupBy("doc_id").agg(F.bool_and("kept").alias("all"), F.bool_or("kept").alias("any"))
    left = without_ids(docs, ids.where(~F.col("any")).select("doc_id"))
    mixed = cut(ids.where("any and not all").select("doc_id"))
    if mixed.isEmpty():
        return left
    names = [f"`{c}`" for c in docs.columns]
    stay = groups.where("kept").select(F.col("doc_id").alias("__id"), "text_sha256").distinct()
    lower = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    first = (with_ids(left, mixed)
             .groupBy("doc_id", F.sha2(F.encode(lower, "UTF-8"), 256).alias("__digest"))
             .agg(F.first(F.struct(*names)).alias("__row")))
    first = first.join(stay, F.col("doc_id").eqNullSafe(stay["__id"])
                       & (F.col("__digest") == F.col("text_sha256")), "left_semi")
    return without_ids(left, mixed).unionByName(first.select("__row.*"))
