"""Benchmark decontamination by pigeonhole edit matching.

A test item of length n may occur with up to k = floor(rate * n) edits.  Split
into k + 1 pieces, at least one piece stands unchanged in any such occurrence.
All pieces go into one Aho-Corasick automaton, every text is run through it,
and around each hit the item is verified with Myers' bit-parallel edit
distance over a window that any occurrence through that hit lies in.

Items and texts are compared with A-Z lowered and runs of ASCII white space
folded to one blank.  Items are broadcast in blocks of a bounded size, each
against all texts.

Defined cases: null or empty texts and items match nothing; items shorter
than 1 / rate are matched exactly; repeated items or rows each give their
pairs; rows without ``doc_id`` are matched too; empty tables give an empty
result; further columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.shared import bounded_batches, lean_task, text_slices, texts_of

#: Edits for each character of an item.
RATE = 0.08
#: Characters of the items that are broadcast at once.
BLOCK_CHARS = 2_000_000


def fold(text: bytes) -> str:
    return b" ".join(text.lower().split()).decode()


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """(offset, piece) of budget + 1 even pieces."""
    n = budget + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def myers(pattern: str, text: str, masks: dict[str, int] | None = None) -> int:
    """The least edit distance of ``pattern`` to any part of ``text``."""
    m = len(pattern)
    if masks is None:
        masks = symbol_masks(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best = m
    for c in text:
        eq = masks.get(c, 0)
        x = eq | minus
        d = ((((x & plus) + plus) ^ plus) | x) & full
        up = minus | (full & ~(d | plus))
        down = plus & d
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        # The first row is all 0: a match may begin anywhere.
        up = (up << 1) & full
        minus = up & d
        plus = ((down << 1) & full) | (full & ~(d | up))
        if score < best:
            best = score
    return best


def symbol_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


class Items:
    """The automaton of a block of items."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick

        self.items = [(i, t, int(rate * len(t)), symbol_masks(t)) for i, t in items if t]
        places: dict[str, list[tuple[int, int]]] = {}
        for k, (_, text, budget, _) in enumerate(self.items):
            for offset, piece in pieces(text, budget):
                places.setdefault(piece, []).append((k, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, found in places.items():
            self.automaton.add_word(piece, (len(piece), found))
        if places:
            self.automaton.make_automaton()
        else:
            self.automaton = None

    def matches(self, text: str) -> list[tuple[int, int, int]]:
        """(item number, least distance, budget) of the items that occur in ``text``."""
        if self.automaton is None or not text:
            return []
        best: dict[int, int] = {}
        tried: dict[int, set[int]] = {}
        for end, (length, found) in self.automaton.iter(text):
            for k, offset in found:
                _, item, budget, masks = self.items[k]
                start = end + 1 - length - offset
                seen = tried.setdefault(k, set())
                # One window holds all occurrences whose hits lie within a budget of this place.
                cell = start // (budget + 1)
                if best.get(k) == 0 or cell in seen:
                    continue
                seen.add(cell)
                if text.startswith(item, max(start, 0)):
                    best[k] = 0
                    continue
                low = cell * (budget + 1)
                window = text[max(0, low - budget):low + budget + 1 + len(item) + budget]
                distance = myers(item, window, masks)
                if distance <= budget:
                    best[k] = min(distance, best.get(k, distance))
        return [(k, d, self.items[k][2]) for k, d in sorted(best.items())]


_BUILT: dict[str, Items] = {}


def _built(shared) -> Items:
    """The worker's automaton of a broadcast block (the last one is kept)."""
    name, items, rate = shared.value
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Items(items, rate)
    return _BUILT[name]


def _match(shared):
    def run(batches):
        block = _built(shared)
        for piece in text_slices(batches, 1, 4 << 20):
            out = [], [], [], []
            for doc_id, text in zip(piece.column(0).to_pylist(), texts_of(piece.column(1)), strict=True):
                for k, distance, budget in block.matches(fold(text)):
                    for column, value in zip(out, (doc_id, block.items[k][0], distance, budget), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                out, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)],
                names=["doc_id", "item_id", "distance", "budget"])
    return run


def _keep(shared):
    def run(batches):
        block = _built(shared)
        for piece in text_slices(batches, 0, 4 << 20):
            clean = [not block.matches(fold(t)) for t in texts_of(piece.column(0))]
            yield pa.RecordBatch.from_arrays([pc.filter(c, pa.array(clean, pa.bool_())) for c in piece.columns[1:]],
                                             schema=pa.schema(list(piece.schema)[1:]))
    return run


def item_blocks(benchmark: DataFrame, rate: float, block_chars: int = BLOCK_CHARS) -> list:
    """The items as broadcasts of about ``block_chars`` characters each."""
    import uuid
    bounded_batches(benchmark.sparkSession)
    items = benchmark.select("item_id", "text").where("text is not null and text <> ''")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // block_chars)
    spread = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(n, 1))))
    out = []
    for b in range(n):
        rows = [(r["item_id"], fold(r["text"].encode())) for r in spread.where(F.col("block") == b).orderBy("item_id").collect()]
        out.append(benchmark.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, rows, rate)))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """doc_id, item_id, distance, budget of every item that occurs in a document within its budget."""
    kind = "doc_id long, item_id long, distance int, budget int"
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = docs.sparkSession.createDataFrame([], kind)
    for shared in item_blocks(benchmark, rate):
        out = out.union(texts.mapInArrow(lean_task(_match(shared)), kind))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """The rows of ``docs`` in which no item occurs, with all their columns."""
    for shared in item_blocks(benchmark, rate):
        docs = docs.select(F.col("text").alias("__text"), "*").mapInArrow(lean_task(_keep(shared)), docs.schema)
    return docs
