import math
import random

import pytest

from cohortlens.llm.hard_negatives import hard_negatives


def brute(rows, every=100, positives=5, k=5, lower=80):
    usable = []
    for vec_id, vector, label in rows:
        if None in (vec_id, vector, label) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        usable.append((vec_id, [math.floor(256 * x) for x in vector], label))
    out = []
    for a_id, a, a_label in usable:
        if a_id % every:
            continue
        scored = [(sum(x * y for x, y in zip(a, v, strict=True)), i, label) for i, v, label in usable
                  if i != a_id and len(v) == len(a)]
        own = sorted([(-s, i) for s, i, label in scored if label == a_label])[:positives]
        others = sorted([(-s, i) for s, i, label in scored if label != a_label])
        for p, p_id in own:
            fit = [(-s, i) for s, i in others if lower * -p <= 100 * -s <= 100 * -p][:k]
            out += [(a_id, p_id, r, i, -p, s) for r, (s, i) in enumerate(fit, 1)]
    return sorted(out)


@pytest.fixture
def table(spark):
    def make(rows, parts=4):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
        for name in ("anchor", "score", "slot", "place", "list", "rank", "anchor_id"):
            df = df.selectExpr("*", f"'x' AS {name}")
        return df.repartition(parts) if rows else df
    return make


def vectors(seed, n, dim=8, labels=4, steps=None):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        v = [rng.uniform(-1, 1) for _ in range(dim)]
        if steps:  # few values: many ties
            v = [round(x * steps) / steps for x in v]
        out.append((i, v, rng.randrange(labels)))
    return out


def run(df, **more):
    return sorted(map(tuple, hard_negatives(df, **more).collect()))


def as_floats(rows):
    import numpy as np
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]


def test_matches_brute_force(table):
    rows = as_floats(vectors(1, 400))
    assert run(table(rows), every=10) == brute(rows, every=10)


def test_ties_and_hot_label(table):
    rows = as_floats(vectors(2, 400, dim=3, labels=2, steps=2))
    rows = [(i, v, 0 if i % 3 else label) for i, v, label in rows]
    got = run(table(rows), every=10)
    assert got == brute(rows, every=10) and len(got) > 300


def test_several_blocks_give_the_same(table):
    rows = as_floats(vectors(3, 300))
    assert run(table(rows), every=10, block_bytes=500) == brute(rows, every=10)


def test_other_limits(table):
    rows = as_floats(vectors(4, 300, dim=4))
    assert run(table(rows), every=20, positives=3, k=7, lower=50) == brute(rows, 20, 3, 7, 50)


def test_nulls_lengths_repeats_and_large_values(table):
    rows = as_floats(vectors(5, 120, dim=4, labels=2))
    rows += [(None, [1.0] * 4, 1), (500, None, 1), (600, [1.0, None, 1.0, 1.0], 0), (700, [1.0, float("nan"), 0.0, 0.0], 0),
             (800, [float("inf")] * 4, 1), (900, [0.5] * 4, None), (1000, [], 1), (1001, [], 0), (1002, [], 1),
             (1100, [0.5] * 7, 1), (1101, [0.25] * 7, 1), (1102, [0.2] * 7, 0), (100, [0.9] * 4, 1), (7, [0.9] * 4, 0),
             (7, [0.9] * 4, 0), (1200, [2.0 ** 20] * 4, 1), (1201, [2.0 ** 20] * 4, 1), (1202, [2.0 ** 20 - 1] * 4, 0)]
    too_long = [(1300, [3e38] * 4, 0)]
    assert run(table(rows + too_long), every=10) == brute(rows, every=10)


def test_empty_tables(table):
    assert run(table([])) == [] and run(table([(5, [1.0], 1), (200, None, 1)])) == []
    assert run(table([(100, [1.0], 1)])) == []
