"""SentencePiece encoding and decoding on the tokenizers library.

The model file's protobuf is read field by field; from it the normaliser, the
metaspace marker, the unigram scores or BPE merges and the byte fallback are
rebuilt as a ``tokenizers`` tokenizer.  Texts are encoded in multithreaded
batches.  Where no piece has a marker after another character, merges never
cross the blank before a word, so each distinct word is encoded once and
texts are put together from their words; texts with runs of blanks (or a
literal marker) are encoded whole.  Decoding goes from ids back to text, and
every document is compared with its normalised text.  Every document is also
compared with the SentencePiece library; ``parity`` says whether the ids are
equal.  Neither encoder looks over a word's bounds under the condition above,
so texts that are put together from words are compared by their words, each
distinct word once as it enters the cache; all others are encoded whole by the
library too.

Defined cases: a null text counts as empty and has no ids; repeated rows each
get a row; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import operator
import os
import struct
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.shared import bounded_batches, lean_task, ragged, text_slices, texts_of

MARK = "▁"
#: Of so many documents one is compared with the SentencePiece library too (0: none); ``parity`` is null for the others.
PARITY_EVERY = 1
#: Distinct words whose ids a Python worker keeps.
WORD_CACHE = 1 << 18
#: Words that the tokenizer gets at a time; its results are larger than the ids.
ENCODE_WORDS = 8192
# Types of a piece and of a model in the file format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


# ---- the model file

def fields(data: bytes):
    """(number, value) of a protobuf message; values are ints or bytes."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        wire = key & 7
        if wire == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(wire)
        size = varint() if size is None else size
        yield key >> 3, data[at:at + size]
        at += size


class ModelFile:
    """Pieces and settings of a SentencePiece model."""

    def __init__(self, data: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        self.kind, self.unk_id, self.byte_fallback, self.whole_words = UNIGRAM, 0, False, True
        self.charsmap, self.dummy_prefix, self.squeeze, self.escape = b"", True, True, True
        for number, value in fields(data):
            if number == 1:
                piece = dict(fields(value))
                score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                self.pieces.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(fields(value))
                self.kind = trainer.get(3, UNIGRAM)
                self.unk_id = trainer.get(40, 0)
                self.byte_fallback = bool(trainer.get(35, 0))
            elif number == 3:
                rule = dict(fields(value))
                self.charsmap = rule.get(2, b"")
                self.dummy_prefix, self.squeeze, self.escape = (bool(rule.get(k, 1)) for k in (3, 4, 5))


def build_tokenizer(model: ModelFile):
    """The same model for the tokenizers library; it takes normalised, marked text."""
    from tokenizers import AddedToken, Tokenizer, models

    if model.kind == UNIGRAM:
        tokenizer = Tokenizer(models.Unigram([(p, s) for p, s, _ in model.pieces], model.unk_id, model.byte_fallback))
    elif model.kind == BPE:
        vocab = {p: i for i, (p, _, _) in enumerate(model.pieces)}
        merges = []
        for piece, score, kind in model.pieces:
            if kind in (NORMAL, USER, UNUSED):
                halves = [(piece[:k], piece[k:]) for k in range(1, len(piece))]
                found = [(a, b) for a, b in halves if a in vocab and b in vocab]
                merges += [(-score, vocab[piece], vocab[a], vocab[b], a, b) for a, b in found]
        merges.sort()
        tokenizer = Tokenizer(models.BPE(vocab, [m[4:] for m in merges], unk_token=model.pieces[model.unk_id][0],
                                         fuse_unk=True, byte_fallback=model.byte_fallback))
    else:
        raise ValueError(f"model type {model.kind} is neither unigram nor BPE")
    users = [AddedToken(p, normalized=False, special=False) for p, _, kind in model.pieces if kind == USER]
    if users:
        tokenizer.add_tokens(users)
    return tokenizer


class PieceCodec:
    """Encodes and decodes texts with one model file."""

    def __init__(self, path: str):
        self.path, self.check = path, False
        with open(path, "rb") as file:
            self.model = ModelFile(file.read())
        self.tokenizer = build_tokenizer(self.model)
        self.normaliser = None
        if self.model.charsmap:
            from tokenizers import normalizers
            self.normaliser = normalizers.Precompiled(self.model.charsmap)
        names = [p for p, _, kind in self.model.pieces if kind in (NORMAL, USER)]
        self.by_word = (self.model.escape and not any(kind == USER for _, _, kind in self.model.pieces)
                        and not any(MARK in p.lstrip(MARK) for p in names))
        table = []
        for piece, _, kind in self.model.pieces:
            if kind == BYTE:
                table.append(bytes([int(piece[3:5], 16)]))
            elif kind == CONTROL:
                table.append(b"")
            elif kind == UNKNOWN:
                table.append(" ⁇ ".encode())
            else:
                table.append(piece.replace(MARK, " ").encode() if self.model.escape else piece.encode())
        self.lengths = np.array([len(x) for x in table], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(table), np.uint8)
        self._clear()

    def _clear(self):
        self.known: dict[bytes, int] = {}
        self.pool, self.used = np.empty(1 << 16, np.int32), 0
        self.word_starts, self.word_lengths = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)
        self.word_same = np.empty(1 << 14, bool)

    def set_check(self, check: bool) -> None:
        """Compare words with the library as they enter the cache; words from before have no flags."""
        if check and not self.check:
            self._clear()
        self.check = check

    def normalise(self, text: str) -> str:
        if self.normaliser is not None:
            text = self.normaliser.normalize_str(text)
        if self.model.squeeze:
            text = " ".join(x for x in text.split(" ") if x)
        return text

    def marked(self, text: str) -> str:
        """Normalised text with the leading blank and the markers, as the pieces have them."""
        if not text:
            return ""
        if self.model.dummy_prefix:
            text = " " + text
        return text.replace(" ", MARK) if self.model.escape else text

    def _places(self, words: list[bytes]) -> np.ndarray:
        fresh = [w for w in words if w not in self.known]
        if self.known and len(self.known) + len(fresh) > WORD_CACHE:
            self._clear()
            fresh = words
        if fresh:
            lists, same = [], []
            for k in range(0, len(fresh), ENCODE_WORDS):
                some = [w.decode() for w in fresh[k:k + ENCODE_WORDS]]
                found = [e.ids for e in self.tokenizer.encode_batch_fast([MARK + w for w in some], add_special_tokens=False)]
                lists += found
                same += list(map(operator.eq, library(self.path).encode(some), found)) if self.check else [False] * len(some)
            lengths = np.fromiter(map(len, lists), np.int64, len(lists))
            flat = np.fromiter(chain.from_iterable(lists), np.int32, int(lengths.sum()))
            while self.used + len(flat) > len(self.pool):
                self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
            first = len(self.known)
            while first + len(fresh) > len(self.word_starts):
                self.word_starts = np.concatenate([self.word_starts, np.empty_like(self.word_starts)])
                self.word_lengths = np.concatenate([self.word_lengths, np.empty_like(self.word_lengths)])
                self.word_same = np.concatenate([self.word_same, np.empty_like(self.word_same)])
            self.pool[self.used:self.used + len(flat)] = flat
            self.word_starts[first:first + len(fresh)] = self.used + np.cumsum(lengths) - lengths
            self.word_lengths[first:first + len(fresh)] = lengths
            self.word_same[first:first + len(fresh)] = same
            self.known.update(zip(fresh, range(first, first + len(fresh)), strict=True))
            self.used += len(flat)
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of normalised ``texts`` one after another, and the number of ids of each.

        ``simple`` says which texts went by words and, with ``check``, ``same``
        whether the ids of all words of a text are the library's.
        """
        simple = np.array([self.by_word and self.model.dummy_prefix and bool(t) and "  " not in t and MARK not in t
                           and t[0] != " " and t[-1] != " " for t in texts], bool)
        counts = np.zeros(len(texts), np.int64)
        rest = np.flatnonzero(~simple)
        whole = self.tokenizer.encode_batch_fast([self.marked(texts[i]) for i in rest], add_special_tokens=False)
        counts[rest] = [len(e.ids) for e in whole]
        easy = np.flatnonzero(simple)
        lists = pc.split_pattern(pa.array([texts[i] for i in easy], pa.large_string()), " ")
        flat = lists.flatten().dictionary_encode()
        at = flat.indices.to_numpy(zero_copy_only=False)
        place = self._places(flat.dictionary.cast(pa.large_binary()).to_pylist())
        lengths = self.word_lengths[place][at]
        ids = self.pool[ragged(self.word_starts[place][at], lengths)]
        edges = np.concatenate([[0], np.cumsum(np.diff(lists.offsets.to_numpy()))])
        counts[easy] = np.diff(np.concatenate([[0], np.cumsum(lengths)])[edges])
        self.simple, self.same = simple, np.zeros(len(texts), bool)
        self.same[easy] = np.diff(np.concatenate([[0], np.cumsum(~self.word_same[place][at])])[edges]) == 0
        if not len(rest):
            return ids, counts
        out = np.empty(int(counts.sum()), np.int32)
        begins = np.cumsum(counts) - counts
        out[ragged(begins[easy], counts[easy])] = ids
        for i, e in zip(rest.tolist(), whole, strict=True):
            out[begins[i]:begins[i] + counts[i]] = e.ids
        return out, counts

    def parity(self, raw: list[str], texts: list[str], ids: np.ndarray, counts: np.ndarray, which) -> list[bool | None]:
        """Whether the ids that :meth:`encode` has just given for ``texts`` are the library's for the ``raw`` texts.

        Texts that went by words go by their words' flags, if normalising left
        them as they were; the others are encoded whole.  Null for texts that
        are not in ``which``.
        """
        out: list[bool | None] = [None] * len(texts)
        by_word = self.simple if self.check and self.normaliser is None else np.zeros(len(texts), bool)
        left = []
        for i in which:
            if by_word[i] and raw[i] == texts[i]:
                out[i] = bool(self.same[i])
            else:
                left.append(i)
        whole = parity(self.path, raw, ids, counts, left)
        for i in left:
            out[i] = whole[i]
        return out

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The texts' bytes from ids; the leading blank that encoding adds is taken off."""
        lengths = self.lengths[ids]
        flat = self.bytes[ragged(self.starts[ids], lengths)].tobytes()
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        cut = 1 if self.model.dummy_prefix else 0
        return [flat[a + cut if b > a and flat[a] == 32 else a:b] for a, b in zip(ends, ends[1:], strict=False)]


_CODECS: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    """The worker's codec for a model file (kept between tasks)."""
    if path not in _CODECS:
        os.environ.setdefault("RAYON_NUM_THREADS", "2")
        _CODECS[path] = PieceCodec(path)
    return _CODECS[path]


_LIBRARY: dict = {}


def library(path: str):
    """The SentencePiece library's model (kept between tasks)."""
    import sentencepiece
    if path not in _LIBRARY:
        _LIBRARY[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _LIBRARY[path]


def parity(path: str, texts: list[str], ids: np.ndarray, counts: np.ndarray, which) -> list[bool | None]:
    """Whether the ids of each text in ``which`` are those of the SentencePiece library for the whole text; else null."""
    model, ends = library(path), np.concatenate([[0], np.cumsum(counts)]).tolist()
    out: list[bool | None] = [None] * len(texts)
    for i in which:
        out[i] = model.encode(texts[i]) == ids[ends[i]:ends[i + 1]].tolist()
    return out


def check_parity(path: str, texts: list[str], ids: np.ndarray, counts: np.ndarray, which) -> None:
    """Compare the ids of some texts with those of the SentencePiece library."""
    for i, same in enumerate(parity(path, texts, ids, counts, which)):
        if same is False:
            raise ValueError(f"ids differ from the SentencePiece library's for {texts[i][:200]!r}")


def _run(path: str, parity_every: int, with_ids: bool):
    def run(batches):
        coder = codec(path)
        coder.set_check(parity_every == 1)
        for piece in text_slices(batches, 1, 1 << 20):
            raw = [t.decode() for t in texts_of(piece.column(1))]
            texts = [coder.normalise(t) for t in raw]
            ids, counts = coder.encode(texts)
            which = [i for i, t in enumerate(raw) if parity_every and zlib.crc32(t.encode()) % parity_every == 0]
            same = coder.parity(raw, texts, ids, counts, which)
            back = coder.decode(ids, counts)
            ends = np.concatenate([[0], np.cumsum(counts)]).tolist()
            code = ids.astype("<u4").tobytes()
            parts = [code[4 * a:4 * b] for a, b in zip(ends, ends[1:], strict=False)]
            columns = [piece.column(0), pa.array(counts, pa.int64()), pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                       pa.array([b == t.encode() for b, t in zip(back, texts, strict=True)], pa.bool_()),
                       pa.array(same, pa.bool_())]
            names = ["doc_id", "n_pieces", "ids_crc32", "round_trip", "parity"]
            if with_ids:
                columns.append(pa.array(parts, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)
    return lean_task(run)


def piece_table(docs: DataFrame, path: str, parity_every: int = PARITY_EVERY, with_ids: bool = False) -> DataFrame:
    """doc_id, n_pieces, ids_crc32, round_trip, parity (and ids as little-endian 32-bit integers, if asked for)."""
    bounded_batches(docs.sparkSession)
    kind = "doc_id long, n_pieces long, ids_crc32 long, round_trip boolean, parity boolean" + ", ids binary" * with_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _run(path, parity_every, with_ids), kind)
