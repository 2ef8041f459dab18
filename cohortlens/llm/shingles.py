"""Words and word shingles of texts as 64-bit hashes, in numpy."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from cohortlens.llm.shared import texts_of

#: Odd multipliers of the words' places in a shingle, derived from their number.
_PLACES = np.array([int.from_bytes(hashlib.sha256(b"place %d" % i).digest()[:8], "little") | 1 for i in range(64)],
                   np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (multiply and fold twice)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_codes(column: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Words (runs without ASCII white space, A-Z lowered) of a string column.

    Returns the place of every word in the list of distinct words, that list,
    and the number of words of each text.
    """
    texts = pa.array([t.lower() for t in texts_of(column)], pa.binary()).cast(pa.large_string())
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten().dictionary_encode()
    at = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    words = flat.dictionary.cast(pa.large_binary()).to_pylist()
    counts = np.diff(lists.offsets.to_numpy())
    if b"" in words:  # white space at an end of a text
        real = at != words.index(b"")
        ends = np.concatenate([[0], np.cumsum(real)])
        edges = np.concatenate([[0], np.cumsum(counts)])
        return at[real], words, np.diff(ends[edges])
    return at, words, counts


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """The ascending distinct shingle hashes of each text.

    A text of fewer words than ``size`` has its whole sequence as one shingle;
    a text without words (or null) has none.
    """
    at, words, counts = word_codes(column)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))[at]
    total = len(hashes)
    runs = np.zeros(max(total - size + 1, 0), np.uint64)
    for j in range(size):
        runs += hashes[j:j + len(runs)] * _PLACES[j]
    runs = mix(runs)
    ends = np.cumsum(counts)
    out = []
    for end, n in zip(ends.tolist(), counts.tolist(), strict=True):
        if n >= size:
            out.append(np.unique(runs[end - n:end - size + 1]))
        elif n:
            whole = (hashes[end - n:end] * _PLACES[:n]).sum(dtype=np.uint64) + np.uint64(n)
            out.append(mix(np.array([whole], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out
