"""Periodic runs of words, found with string synchronising sets.

A run is a stretch of words with smallest period q and at least 3 q words that
no neighbouring word extends.  Texts are cut into words in Spark tasks; the
words of many texts lie one after another, each text closed by a mark of its
own, so no run leaves its text.  Names (64-bit hashes) of all stretches of 1,
2, 4, ... words are made by doubling.  At scale t = 2^k, a place belongs to the
synchronising set where the least name of the stretches of t words that begin
in ``[i, i + t]`` begins at ``i`` or ``i + t``; whether it does depends on the
2 t words from ``i`` on alone.  Stretches of t words with a period of t/3 or less are left out
of the choice: they lie in runs that lower scales have found.

For a run of period q in [4 t, 8 t) the first chosen place of the run lies
early enough that its context of some length L >= q repeats q words further,
inside the run, and no sooner, as a period is primitive.  Three lengths L cover
the range (``_contexts``).  So each pair of successive chosen places with equal
contexts proposes its distance, and a proposal is extended to both sides by the
names and compared word by word.  Periods below four are found directly.

Defined cases: a null or empty text, or one without words, has no words and no
runs; a null ``doc_id`` has no planted period; repeated rows each get a row; an
empty table gives an empty result; further columns are ignored.  One text is
the unit of work: 1 million words take about 200 MB in its task.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.shared import bounded_batches, lean_task, ragged, text_slices, texts_of
from cohortlens.llm.shingles import mix

#: Periods below this are found by comparing each word with those that follow it.
SMALL = 4
#: Words that a run must have at least, beside three periods.
LEAST_WORDS = 24
#: Texts of more words than this are worked on by themselves.
LONG_WORDS = 1 << 16

_LEFT, _RIGHT = np.uint64(0xD1342543DE82EF95), np.uint64(0xAF251AF3B0F025B5)

SCHEMA = ("doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


# ---- names of dyadic stretches

class Names:
    """Names of the stretches of 2^k words of ``words``; equal names, equal stretches."""

    def __init__(self, words: np.ndarray):
        self.levels = [mix((words.astype(np.uint64) + np.uint64(1)) * _LEFT)]

    def level(self, k: int) -> np.ndarray:
        while len(self.levels) <= k:
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            # Stretches over the end have names that no other stretch has.
            after = np.concatenate([last[half:], mix(np.arange(min(half, len(last)), dtype=np.uint64) * _RIGHT
                                                     + np.uint64(len(self.levels)))])[:len(last)]
            self.levels.append(mix(last * _LEFT + after * _RIGHT))
        return self.levels[k]

    def of(self, at: np.ndarray, length: int) -> np.ndarray:
        """Names of the stretches of ``length`` words that begin ``at``."""
        k = length.bit_length() - 1
        names = self.level(k)
        return mix(names[at] * _LEFT + names[at + (length - (1 << k))])

    def common_after(self, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
        """How many words from ``a`` and from ``b`` > ``a`` on are the same."""
        end, found = len(self.levels[0]), np.zeros(len(a), np.int64)
        for k in range(most.bit_length() - 1, -1, -1):
            names, inside = self.level(k), b + found + (1 << k) <= end
            x, y = np.where(inside, a + found, 0), np.where(inside, b + found, 0)
            found += (inside & (names[x] == names[y])) << k
        return found

    def common_before(self, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
        """How many words before ``a`` < ``b`` and before ``b`` are the same."""
        found = np.zeros(len(a), np.int64)
        for k in range(most.bit_length() - 1, -1, -1):
            names, inside = self.level(k), a - found >= 1 << k
            x, y = np.where(inside, a - found - (1 << k), 0), np.where(inside, b - found - (1 << k), 0)
            found += (inside & (names[x] == names[y])) << k
        return found


# ---- the synchronising set

def _least_ahead(values: np.ndarray, count: int) -> np.ndarray:
    """The least of ``values[i : i + count]`` for every i up to the last whole stretch."""
    least, width = values, 1
    while 2 * width <= count:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = count - width
    return np.minimum(least[:-rest], least[rest:]) if rest else least


def synchronising_set(names: np.ndarray, scale: int, periodic: np.ndarray) -> np.ndarray:
    """The chosen places at ``scale``; ``periodic`` marks stretches of ``scale`` words that take no part."""
    if len(names) <= scale:
        return np.empty(0, np.int64)
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    values = np.where(periodic, none, names)
    least = _least_ahead(values, scale + 1)
    n = len(least)
    return np.flatnonzero((least != none) & ((values[:n] == least) | (values[scale:scale + n] == least)))


def _contexts(scale: int) -> list[tuple[int, int]]:
    """Context lengths, each with the least period it serves, that cover periods of [4, 8) scales.

    The first chosen place of a run of period q lies within the first ``scale``
    words, or, where the run begins with a stretch of a period p <= scale / 3,
    at most q + p - 2 scale - 1 words behind its begin.  A context of L words
    from there and its repetition q words on lie in the run's 3 q words if
    L <= 2 q - scale + 1 and L <= q + 2 scale + 1 - p.
    """
    reach, out, least = 2 * scale + 1 - scale // 3, [], 4 * scale
    while least < 8 * scale:
        length = min(least + reach, 2 * least - scale + 1, max(8 * scale - 1, least))
        out.append((length, least))
        least = length + 1
    return out


def find_runs(words: np.ndarray, longest: int, live=None) -> np.ndarray:
    """All runs (begin, end, period) of at least three periods in ``words``, a text or several with marks between.

    ``longest`` is the number of words of the longest text.  ``live`` gives
    for a number of words how much of ``words`` the texts of as many words
    take, if texts stand in descending order of length.
    """
    names = Names(words)
    found = []
    for q in range(1, SMALL):
        same = np.concatenate([[False], words[:-q] == words[q:], [False]]) if len(words) > q else np.zeros(2, bool)
        edges = np.flatnonzero(same[1:] != same[:-1])
        begin, end = edges[::2], edges[1::2] + q
        long = end - begin >= 3 * q
        found.append(np.stack([begin[long], end[long], np.full(int(long.sum()), q)], axis=1))
    runs = _distinct(np.concatenate(found))
    k = 0
    while 12 << k <= longest:
        scale = 1 << k
        size = live(12 * scale) if live else len(words)
        level = names.level(k)[:size]
        periodic = np.zeros(size + 1, np.int64)
        inner = runs[(3 * runs[:, 2] <= scale) & (runs[:, 1] - runs[:, 0] >= scale)]
        np.add.at(periodic, np.minimum(inner[:, 0], size), 1)
        np.add.at(periodic, np.minimum(inner[:, 1] - scale + 1, size), -1)
        places = synchronising_set(level, scale, np.cumsum(periodic[:size]) > 0)
        pairs = []
        for length, least in _contexts(scale):
            names.level(length.bit_length() - 1)
            at = places[places + length <= size]
            code = names.of(at, length)
            order = np.argsort(code, kind="stable")
            a, b = at[order][:-1], at[order][1:]
            near = (code[order][:-1] == code[order][1:]) & (b - a >= least) & (b - a <= length)
            pairs.append(np.stack([a[near], b[near]], axis=1))
        pairs = np.concatenate(pairs)
        if len(pairs):
            a, b = pairs[:, 0], pairs[:, 1]
            begin = a - names.common_before(a, b, longest)
            end = b + names.common_after(a, b, longest)
            rows = np.stack([begin, end, b - a], axis=1)[end - begin >= 3 * (b - a)]
            rows = [r for r in np.unique(rows, axis=0).tolist() if np.array_equal(words[r[0]:r[1] - r[2]], words[r[0] + r[2]:r[1]])]
            if rows:
                runs = _distinct(np.concatenate([runs, np.array(rows, np.int64)]))
        k += 1
    return runs


def _distinct(runs: np.ndarray) -> np.ndarray:
    """By begin and end, with the smallest period of each."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    return runs[first]


# ---- texts

def word_places(column: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words (runs without ASCII white space): the place of each in the list of distinct words, the list, the counts."""
    lists = pc.ascii_split_whitespace(pa.array(texts_of(column), pa.binary()).cast(pa.large_string()))
    flat = lists.flatten().dictionary_encode()
    at = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    counts = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    empty = pc.index(flat.dictionary, "").as_py()
    if empty >= 0:  # white space at an end of a text
        real = at != empty
        before = np.concatenate([[0], np.cumsum(real)])
        counts = np.diff(before[np.concatenate([[0], np.cumsum(counts)])])
        at = at[real]
    return at, flat.dictionary, counts


def planted_period(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """From which word on, and with which period, a document is made periodic (one in ten, by its id)."""
    if doc_id is None or not n:
        return None
    code = zlib.crc32(str(doc_id).encode())
    if code % 10:
        return None
    g = code // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def runs_by_text(at: np.ndarray, counts: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """The (start, length, period) of each text's runs, by start, then period; texts lie one after another in ``at``."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in counts]
    begins = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    order = order[counts[order] >= LEAST_WORDS]
    long = int((counts[order] > LONG_WORDS).sum())
    for group in [*([i] for i in order[:long].tolist()), order[long:]]:
        if not len(group):
            continue
        group = np.asarray(group)
        n = counts[group]
        heads = np.cumsum(n + 1) - (n + 1)
        words = np.empty(int((n + 1).sum()), np.int64)
        words[ragged(heads, n)] = at[ragged(begins[group], n)]
        words[heads + n] = -2 - np.arange(len(group))  # a mark of its own behind each text
        live = lambda least, n=n: int((n[n >= least] + 1).sum())
        runs = find_runs(words, int(n[0]), live)
        runs = runs[runs[:, 1] - runs[:, 0] >= np.maximum(LEAST_WORDS, 3 * runs[:, 2])]
        owner = np.searchsorted(heads, runs[:, 0], side="right") - 1
        for i, head, (begin, end, period) in zip(group[owner].tolist(), heads[owner].tolist(), runs.tolist(), strict=True):
            out[i].append((begin - head, end - begin, period))
    for mine in out:
        mine.sort(key=lambda r: (r[0], r[2]))
    return out


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest length / period, compared exactly; ties go to the smallest start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _collapsed(at: np.ndarray, words: pa.Array, counts: np.ndarray, runs) -> list[bytes]:
    """Each text's words without the repetitions, joined by one blank."""
    begins = np.cumsum(counts) - counts
    change = np.zeros(len(at) + 1, np.int64)
    for begin, mine in zip(begins.tolist(), runs, strict=True):
        for start, length, period in mine:
            change[begin + start + period] += 1
            change[begin + start + length] -= 1
    kept = np.cumsum(change[:-1]) == 0
    ends = np.concatenate([[0], np.cumsum(kept)])[np.concatenate([[0], np.cumsum(counts)])]
    lists = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), words.take(pa.array(at[kept], pa.int64())))
    return pc.binary_join(lists, pa.scalar(" ", words.type)).cast(pa.large_binary()).to_pylist()


def _run(planted: bool):
    def run(batches):
        for piece in text_slices(batches, 1, 2 << 20):
            at, words, counts = word_places(piece.column(1))
            ids = piece.column(0).to_pylist()
            if planted:
                for doc_id, begin, n in zip(ids, (np.cumsum(counts) - counts).tolist(), counts.tolist(), strict=True):
                    if found := planted_period(doc_id, n):
                        a, p = found
                        at[begin + a:begin + n] = np.resize(at[begin + a:begin + min(a + p, n)], n - a)
            runs = runs_by_text(at, counts)
            best = [strongest(mine) for mine in runs]
            pick = lambda i: pa.array([None if b is None else b[i] for b in best], pa.int64())  # noqa: E731, B023
            sha = lambda texts: pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(counts, pa.int64()), pa.array(list(map(len, runs)), pa.int64()),
                 pick(0), pick(1), pick(2), pa.array([None if b is None else 1000 * b[1] // b[2] for b in best], pa.int64()),
                 sha("".join(f"{s},{n},{q}\n" for s, n, q in mine).encode() for mine in runs),
                 sha(_collapsed(at, words, counts, runs))],
                names=[x.split()[0] for x in SCHEMA.split(", ")])
    return lean_task(run)


def _spans(batches):
    for piece in text_slices(batches, 1, 2 << 20):
        at, _, counts = word_places(piece.column(1))
        rows = [(d, *r) for d, mine in zip(piece.column(0).to_pylist(), runs_by_text(at, counts), strict=True) for r in mine]
        columns = list(zip(*rows, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "length", "period"])


def _input(docs: DataFrame) -> DataFrame:
    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, start (word number), length, period: a row for each run of at least 24 words and three periods."""
    return _input(docs).mapInArrow(lean_task(_spans), "doc_id long, start long, length long, period long")


def run_table(docs: DataFrame, planted: bool = False) -> DataFrame:
    """One row per document: n_words, n_runs, the strongest run, digests of all runs and of the text without repetitions.

    With ``planted``, one document in ten is made periodic first (``planted_period``).
    """
    return _input(docs).mapInArrow(_run(planted), SCHEMA)
