"""Token ids as directly addressable codes.

An id is split into 8-bit chunks.  Level 0 holds the lowest chunk of every id;
a level's continuation bitmap marks the ids that go on, and the next level
holds only their next chunks.  A rank directory (marked bits before every 512
bits) finds the place of an id in the next level, so one id is read without
decoding anything else.

A file is a Parquet file of the shared store whose rows are blocks of whole
documents in ascending ``doc_id`` order: the documents' ids and offsets, and
per level the chunks, the bitmap and the directory.

Defined cases: a null text counts as empty and has the end id alone; a null
``doc_id`` comes first; rows with one ``doc_id`` stand in the order of their
texts; an empty table gives an empty file set; other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlens.llm.shared import fresh_path, lean_task, ragged, text_slices, texts_of

CHUNK_BITS = 8
RANK_BITS = 512
#: Ids after which a block is closed (at the end of a document).
BLOCK_IDS = 1 << 20
#: Distinct words whose ids a Python worker keeps.
WORD_CACHE = 1 << 20
#: Words that the tokenizer gets at a time; its results are larger than the ids.
ENCODE_WORDS = 8192

LEVEL = "struct<chunks:binary,bitmap:binary,ranks:binary>"
BLOCK = (f"shard_doc long, shard_null boolean, block int, doc_ids array<long>, offsets binary, "
         f"n_ids long, levels array<{LEVEL}>")


# ---- the code itself

def encode_levels(ids: np.ndarray) -> list[dict]:
    """Chunk levels of unsigned ids, lowest chunk first."""
    rest, levels = np.asarray(ids, np.uint64 if np.asarray(ids).dtype.itemsize > 4 else np.uint32), []
    while True:
        chunks = rest.astype(np.uint8)
        rest = rest >> rest.dtype.type(CHUNK_BITS)
        more = rest > 0
        packed = np.packbits(more, bitorder="little")
        padded = np.zeros(-(-len(packed) // (RANK_BITS // 8)) * (RANK_BITS // 8), np.uint8)
        padded[:len(packed)] = packed
        counts = np.bitwise_count(padded).reshape(-1, RANK_BITS // 8).sum(axis=1, dtype=np.uint32)
        ranks = (np.cumsum(counts, dtype=np.uint32) - counts).astype("<u4")
        levels.append({"chunks": chunks.tobytes(), "bitmap": packed.tobytes(), "ranks": ranks.tobytes()})
        if not more.any():
            return levels
        rest = rest[more]


def decode_levels(levels: list[dict]) -> np.ndarray:
    """All ids of a block."""
    out = np.empty(0, np.uint64)
    for level in reversed(levels):
        low = np.frombuffer(level["chunks"], np.uint8).astype(np.uint64)
        if len(out):
            more = np.unpackbits(np.frombuffer(level["bitmap"], np.uint8), count=len(low), bitorder="little").astype(bool)
            low[more] |= out << np.uint64(CHUNK_BITS)
        out = low
    return out


def read_id(levels: list[dict], index: int) -> int:
    """The id at ``index`` of a block, by the rank directories alone."""
    value, shift = 0, 0
    for level in levels:
        value |= level["chunks"][index] << shift
        byte, bit = divmod(index, 8)
        if not level["bitmap"][byte] >> bit & 1:
            break
        group = index // RANK_BITS
        before = level["bitmap"][group * RANK_BITS // 8:byte]
        index = (int.from_bytes(level["ranks"][4 * group:4 * group + 4], "little")
                 + int.from_bytes(before, "little").bit_count()
                 + (level["bitmap"][byte] & ((1 << bit) - 1)).bit_count())
        shift += CHUNK_BITS
    return value


# ---- words to ids

def _tails(words: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """The last byte of each word (0: none), and whether it is a full stop or comma after an ASCII letter."""
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int64)[words.offset:words.offset + len(words) + 1]
    # Two bytes ahead stand for those that short words do not have.
    text = np.concatenate([np.zeros(2, np.uint8), np.frombuffer(data, np.uint8)[:ends[-1]] if data else np.empty(0, np.uint8)])
    size, at = np.diff(ends), ends[1:] + 2
    last = np.where(size > 0, text[at - 1], 0)
    before = np.where(size > 1, text[at - 2], 0) | 32
    return last, ((last == ord(".")) | (last == ord(","))) & (before >= ord("a")) & (before <= ord("z"))


class WordEncoder:
    """Encodes texts word by word with a tokenizer that never joins across white space.

    The tokenizer drops white space and splits letters from punctuation before
    its merges run, so a text's ids are those of its words one after another.
    Each distinct word is encoded once in a worker.  Upper-case ASCII letters
    are lowered first, as the tokenizer itself does, save in texts that could
    hold one of its special tokens.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        # Spark runs a worker for each core; more threads in each only cost memory.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self._clear()

    def _clear(self):
        self.known: dict[bytes, int] = {}
        self.pool, self.used = np.empty(1 << 16, np.int32), 0
        self.starts, self.lengths, self.words = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64), 0

    def _add(self, words: list[bytes]):
        lists = [e.ids for k in range(0, len(words), ENCODE_WORDS) for e in self.tokenizer.encode_batch_fast(
            [w.decode() for w in words[k:k + ENCODE_WORDS]], add_special_tokens=False)]
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter(chain.from_iterable(lists), np.int32, int(lengths.sum()))
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        while self.words + len(words) > len(self.starts):
            self.starts = np.concatenate([self.starts, np.empty_like(self.starts)])
            self.lengths = np.concatenate([self.lengths, np.empty_like(self.lengths)])
        self.pool[self.used:self.used + len(flat)] = flat
        self.starts[self.words:self.words + len(words)] = self.used + np.cumsum(lengths) - lengths
        self.lengths[self.words:self.words + len(words)] = lengths
        self.known.update(zip(words, range(self.words, self.words + len(words)), strict=True))
        self.used += len(flat)
        self.words += len(words)

    def places(self, words: list[bytes]) -> np.ndarray:
        """Cache places of words, encoding those not met before."""
        fresh = [w for w in dict.fromkeys(words) if w not in self.known]
        if self.words and self.words + len(fresh) > WORD_CACHE:
            self._clear()
            fresh = list(dict.fromkeys(words))
        if fresh:
            self._add(fresh)
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the number of ids of each text."""
        import pyarrow.compute as pc

        column = pa.array([t if b"<|" in t else t.lower() for t in texts], pa.binary()).cast(pa.large_string())
        lists = pc.ascii_split_whitespace(column)
        flat = lists.flatten().dictionary_encode()
        per_text = np.diff(lists.offsets.to_numpy())
        at = flat.indices.to_numpy()
        words = flat.dictionary.cast(pa.large_binary()).to_pylist()
        # A full stop or comma after an ASCII letter is a word of its own for the tokenizer.
        last, tail = _tails(flat.dictionary)
        for i in np.flatnonzero(tail).tolist():
            words[i] = words[i][:-1]
        place = self.places(words + [b".", b",", b""])
        stop, comma, none = place[-3:]
        ending = np.where(tail, np.where(last == ord("."), stop, comma), none)
        # The ids of each distinct word of these texts, one after another; empty
        # words (white space at an end of a text) have none.
        both = np.stack([place[:-3], ending], axis=1).ravel()
        pool = self.pool[ragged(self.starts[both], self.lengths[both])]
        sizes = self.lengths[both].reshape(-1, 2).sum(axis=1)
        lengths = sizes[at]
        ids = pool[ragged((np.cumsum(sizes) - sizes)[at], lengths)]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        edges = np.concatenate([[0], np.cumsum(per_text)])
        return ids, np.diff(ends[edges])


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a tokenizer file (kept between tasks)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


# ---- files

def _block_batch(shard, number, docs, lengths, parts) -> pa.RecordBatch:
    ids = np.concatenate(parts) if parts else np.empty(0, np.int32)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype("<i8")
    return pa.RecordBatch.from_arrays(
        [pa.array([shard], pa.int64()), pa.array([shard is None]), pa.array([number], pa.int32()),
         pa.array([docs], pa.list_(pa.int64())), pa.array([offsets.tobytes()], pa.binary()),
         pa.array([len(ids)], pa.int64()),
         pa.array([encode_levels(ids)], pa.list_(pa.struct([("chunks", pa.binary()), ("bitmap", pa.binary()),
                                                            ("ranks", pa.binary())])))],
        names=["shard_doc", "shard_null", "block", "doc_ids", "offsets", "n_ids", "levels"])


def _blocks(path: str, end_id: int):
    def run(batches):
        coder = encoder(path)
        number, began, shard = 0, False, None
        docs, lengths, parts, held = [], [], [], 0
        for piece in text_slices(batches, 1, 4 << 20):
            doc_ids = piece.column(0).to_pylist()
            ids, counts = coder.encode(texts_of(piece.column(1)))
            ids = np.insert(ids, np.cumsum(counts), end_id)
            counts = counts + 1
            if not began:
                began, shard = True, doc_ids[0]
            docs, lengths, held = docs + doc_ids, lengths + counts.tolist(), held + len(ids)
            parts.append(ids)
            if held >= BLOCK_IDS:
                yield _block_batch(shard, number, docs, lengths, parts)
                number, docs, lengths, parts, held = number + 1, [], [], [], 0
        if docs:
            yield _block_batch(shard, number, docs, lengths, parts)
    return lean_task(run)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Encode ``docs`` and write the blocks to ``path`` in ascending ``doc_id`` order.

    Documents are dealt by ranges of ``doc_id``; a shard is named by its first
    ``doc_id``, which orders the shards.
    """
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    ordered.mapInArrow(_blocks(tokenizer, end_id), BLOCK).write.option("compression", "zstd").parquet(path)


def block_starts(blocks: DataFrame) -> DataFrame:
    """shard_doc, shard_null, block, first: ids before each block.

    Running totals go over the shards (one row for each range partition), then
    over the blocks within a shard.
    """
    shards = blocks.groupBy("shard_null", "shard_doc").agg(F.sum("n_ids").alias("n_shard"))
    before = F.sum("n_shard").over(Window.orderBy(F.desc("shard_null"), "shard_doc")) - F.col("n_shard")
    shards = shards.select(F.col("shard_null").alias("s_null"), F.col("shard_doc").alias("s_doc"),
                           before.alias("before_shard"))
    within = Window.partitionBy("shard_null", "shard_doc").orderBy("block")
    return (blocks.select("shard_null", "shard_doc", "block", "n_ids")
            .withColumn("within", F.sum("n_ids").over(within) - F.col("n_ids"))
            .join(shards, F.col("shard_doc").eqNullSafe(F.col("s_doc")) & (F.col("shard_null") == F.col("s_null")))
            .select("shard_null", "shard_doc", "block", (F.col("before_shard") + F.col("within")).alias("first")))


def _documents(batches):
    for batch in batches:
        for r in batch.to_pylist():
            ids = decode_levels(r["levels"]).astype("<u4")
            offsets = np.frombuffer(r["offsets"], "<i8")
            data, at = memoryview(ids).cast("B"), (offsets * ids.itemsize).tolist()
            sums = [zlib.crc32(data[a:b]) for a, b in zip(at, at[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["shard_doc"]] * len(sums), pa.int64()), pa.array([r["shard_null"]] * len(sums)),
                 pa.array([r["block"]] * len(sums), pa.int32()), pa.array(r["doc_ids"], pa.int64()),
                 pa.array(offsets[:-1], pa.int64()), pa.array(np.diff(offsets), pa.int64()),
                 pa.array(sums, pa.int64())],
                names=["shard_doc", "shard_null", "block", "doc_id", "within", "n_tokens", "ids_crc32"])


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCK).parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the files."""
    blocks = read_blocks(spark, path)
    docs = blocks.select("shard_doc", "shard_null", "block", "doc_ids", "offsets", "levels").mapInArrow(
        lean_task(_documents), "shard_doc long, shard_null boolean, block int, doc_id long, within long, n_tokens long, "
                    "ids_crc32 long")
    starts = block_starts(blocks).select(F.col("shard_null").alias("b_null"), F.col("shard_doc").alias("b_doc"),
                                         F.col("block").alias("b"), "first")
    return (docs.join(starts, F.col("shard_doc").eqNullSafe(F.col("b_doc")) & (F.col("shard_null") == F.col("b_null"))
                      & (F.col("block") == F.col("b")))
            .select("doc_id", (F.col("first") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"))


def token_table(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Write the files to a new folder of the shared store and return what they hold, per document."""
    spark = docs.sparkSession
    path = fresh_path(spark, "token-codes")
    write_tokens(docs, path, tokenizer, end_id)
    return read_documents(spark, path)
