import random

import numpy as np

from cohortlens.llm.minmax_dedup import PERMUTATIONS, near_duplicates, signatures, similar
from test_jaccard_join import brute, corpus


def run(docs, **more):
    return sorted(map(tuple, near_duplicates(docs, **more).collect()), key=repr)


def want(rows, size=5, num=85):
    return sorted(((d, n, c, d == c) for d, n, c in brute(rows, size, num, 100)), key=repr)


def test_matches_brute_force(make_docs):
    rows = corpus(5, 260) + [(900, None), (901, ""), (902, " \t\n"), (903, "One Two"), (904, "one two"), (905, "two one"),
                             (906, "long " * 60_000)]
    assert run(make_docs(rows, 5)) == want(rows)


def chains(seed, n):
    """Copies of copies: neighbours are alike, the ends are not; many sets of one origin that do not link."""
    rng = random.Random(seed)
    words, out = [f"c{i}" for i in range(150)], []
    for i in range(n):
        if rng.random() < 0.6:
            words = list(words)
            words[rng.randrange(150)] = f"x{i}"
            out.append((i, " ".join(words)))
        else:
            far = list(words)
            for _ in range(rng.randint(2, 9)):
                far[rng.randrange(150)] = f"y{rng.random()}"
            out.append((i, " ".join(far)))
    return out


def test_chains_and_unlinked_variants(make_docs):
    rows = chains(2, 300)
    assert run(make_docs(rows, 4)) == want(rows)


def test_blocks_of_one_bucket(make_docs, monkeypatch):
    monkeypatch.setattr("cohortlens.llm.minmax_dedup.BLOCK", 8)
    rows = chains(7, 200)
    assert run(make_docs(rows, 4)) == want(rows)


def test_other_parameters(make_docs):
    rows = corpus(6, 160)
    assert run(make_docs(rows), size=3, num=90) == want(rows, 3, 90)


def test_null_ids_and_repeated_rows(make_docs):
    text = " ".join(f"v{i}" for i in range(40))
    rows = [(7, text), (7, text), (None, text), (None, "other words stand here all alone"), (9, text + " v40"),
            (11, "a b c d e f g"), (12, "a b c d e f g"), (12, "h i j k l m n"), (13, "h i j k l m n")]
    assert run(make_docs(rows)) == sorted(
        [(7, 36, 7, True), (7, 36, 7, True), (None, 36, 7, True), (None, 2, None, True), (9, 37, 7, False),
         (11, 3, 11, True), (12, 3, 11, False), (12, 3, 11, False), (13, 3, 11, False)], key=repr)


def test_empty_table(make_docs):
    assert run(make_docs([])) == [] and run(make_docs([(1, None), (2, "")])) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_agreement_is_an_unbiased_estimate():
    rng = np.random.default_rng(1)
    shares, squares = [], []
    for _ in range(300):
        pool = rng.integers(0, 1 << 63, 120).astype(np.uint64)
        x, y = np.sort(pool[:100]), np.sort(pool[20:])  # similarity 80 / 120
        a, b = signatures([x, y])
        same = a == b
        shares.append(same.mean())
        squares.append((same[:PERMUTATIONS] & same[PERMUTATIONS:]).mean())
    assert abs(np.mean(shares) - 2 / 3) < 0.01
    assert np.mean(squares) < (2 / 3) ** 2 + 0.005  # least and greatest agree together no oftener than apart
    assert np.var(shares) < 1.15 * (2 / 9) / (2 * PERMUTATIONS)
    assert similar(x, y, 66, 100) and not similar(x, y, 67, 100)
