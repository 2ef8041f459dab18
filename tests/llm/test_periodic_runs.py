import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np

from cohortlens.llm.periodic_runs import find_runs, periodic_runs, run_table, synchronising_set


def brute_runs(words, factor=3, least=1):
    """All maximal stretches by comparing words q apart, for every q; of equal stretches the smallest q."""
    found, n = {}, len(words)
    for q in range(1, n // factor + 1):
        k = 0
        while k < n - q:
            if words[k] != words[k + q]:
                k += 1
                continue
            first = k
            while k < n - q and words[k] == words[k + q]:
                k += 1
            begin, end = first, k + q
            if end - begin >= max(least, factor * q):
                found.setdefault((begin, end), q)
    return sorted((b, e, q) for (b, e), q in found.items())


def brute(doc_id, text):
    words = [w for w in re.split("[ \t-\r]+", text or "") if w]
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        a = (h // 10) % n
        p = 1 + (n - a) // (3 + (h // 10) % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = sorted(((b, e - b, q) for b, e, q in brute_runs(words, 3, 24)), key=lambda r: (r[0], r[2]))
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, n, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def periodic(rng, depth=0):
    """Words with repetitions inside repetitions."""
    if depth == 3 or rng.random() < 0.3:
        return [rng.randrange(3) for _ in range(rng.randint(1, 5))]
    root = periodic(rng, depth + 1) + [rng.randrange(4)] * rng.randint(0, 12)
    out = root * rng.randint(1, 6)
    if rng.random() < 0.5:
        out = out[rng.randint(0, len(out) // 3):len(out) - rng.randint(0, len(out) // 3)]
    return out + ([rng.randrange(4)] if rng.random() < 0.5 else [])


def test_all_runs_match_brute_force():
    rng = random.Random(11)
    for _ in range(700):
        words = [x for _ in range(rng.randint(1, 3)) for x in periodic(rng)][:700]
        got = sorted(map(tuple, find_runs(np.array(words, np.int64), len(words)).tolist()))
        assert got == brute_runs(words), words


def test_every_period_with_exactly_three_repetitions():
    rng = random.Random(4)
    for q in [*range(1, 70), 95, 96, 97, 127, 128, 129, 170, 171, 256, 300]:
        for kind in range(3):
            root = {0: [rng.randrange(10**6) for _ in range(q)], 1: [7] * (q - 1) + [8], 2: [1, 2, 2] * (q // 3) + [9] * (q % 3)}[kind]
            words = [100] + root * 3 + [101, 102]
            got = sorted(map(tuple, find_runs(np.array(words, np.int64), len(words)).tolist()))
            assert got == brute_runs(words), (q, kind)


def test_places_depend_on_their_context_alone():
    rng = np.random.default_rng(3)
    part = rng.integers(0, 1 << 60, 60).astype(np.uint64)
    names = np.concatenate([rng.integers(0, 1 << 60, 31).astype(np.uint64), part, rng.integers(0, 1 << 60, 9).astype(np.uint64), part])
    chosen = set(synchronising_set(names, 8, np.zeros(len(names), bool)).tolist())
    assert {i for i in range(52) if 31 + i in chosen} == {i for i in range(52) if 100 + i in chosen}
    assert all(chosen & set(range(i, i + 8)) for i in range(0, 140))


def texts(seed, n):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        if rng.random() < 0.5:
            words = [f"w{rng.randrange(50)}" for _ in range(rng.randint(0, 400))]
        else:
            words = [f"v{x}" for _ in range(4) for x in periodic(rng)]
        out.append((i, rng.choice([" ", "\n", " \t "]).join(words) + rng.choice(["", " "])))
    return out


def test_table_matches_brute_force(make_docs):
    rows = texts(5, 150) + [(901, None), (902, ""), (903, " \n "), (904, "One"), (905, "a " * 23), (906, "a " * 24),
                            (None, "x y " * 30), (None, None), (907, "Aa aa " * 20), (908, "é ü " * 12), (12, "again " * 30)]
    got = sorted(map(tuple, run_table(make_docs(rows, 4), planted=True).collect()), key=repr)
    assert got == sorted((brute(*r) for r in rows), key=repr)


def test_very_long_texts(make_docs):
    rng = random.Random(9)
    words = [f"w{rng.randrange(3000)}" for _ in range(70_000)]
    root = [f"w{rng.randrange(3000)}" for _ in range(9_000)]
    rows = [(1, " ".join(words + root * 4 + ["end"] + words[:500])), (2, "same " * 80_000), (3, "short text")]
    got = {r.doc_id: r for r in run_table(make_docs(rows)).collect()}
    # The words on either side may go on with the period.
    before = next(i for i in range(1, 9000) if words[-i] != root[-i])
    assert (got[1].n_runs, got[1].start, got[1].period) == (1, 70_001 - before, 9_000)
    assert got[1].length == 36_000 + before - 1
    assert (got[2].n_runs, got[2].length, got[2].period, got[2].exponent_milli) == (1, 80_000, 1, 80_000_000)
    assert got[3].n_runs == 0 and got[3].start is None


def test_runs_as_rows_and_empty_tables(make_docs):
    rows = texts(8, 40)
    want = sorted((d, s, n, q) for d, t in rows for b, e, q in brute_runs(t.split(), 3, 24) for s, n in [(b, e - b)])
    assert sorted(map(tuple, periodic_runs(make_docs(rows)).collect())) == want
    assert run_table(make_docs([])).collect() == periodic_runs(make_docs([])).collect() == []
