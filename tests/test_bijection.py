import random

import numpy as np
from pyspark.sql import functions as F

from cohortlens.operators import ml
from cohortlens.operators.bijection import AGAIN, PRIME, ROUNDS, TIMES, domain, permutation_keys, permute


def by_hand(pos, n, keys):
    a, b = domain(n)
    mix = lambda x, k: ((((x + 1) * TIMES + k) % PRIME) ** 2 % PRIME * AGAIN + k) % PRIME
    x = pos
    while True:
        left, right = x % a, x // a
        for i in range(ROUNDS):
            if i % 2:
                right = (right + mix(left, keys[i])) % b
            else:
                left = (left + mix(right, keys[i])) % a
        x = left + a * right
        if x < n:
            return x


def test_every_size_gives_a_permutation(spark):
    for n in (1, 2, 3, 4, 5, 7, 10, 31, 100, 1023, 5000):
        keys = permutation_keys(42, 1, n)
        df = spark.range(n).select(F.col("id").alias("pos"), *[F.lit(k).cast("long").alias(f"k{i}") for i, k in enumerate(keys)])
        got = {r.pos: r.donor for r in permute(df, n).select("pos", "donor").collect()}
        assert sorted(got.values()) == list(range(n))
        assert all(got[p] == by_hand(p, n, keys) for p in range(0, n, max(1, n // 50)))


def test_permutations_differ_and_leave_few_fixed(spark):
    n, rng = 400, random.Random(1)
    fixed, places = [], []
    for r in range(40):
        keys = permutation_keys(7, 0, r)
        out = [by_hand(p, n, keys) for p in range(n)]
        fixed.append(sum(p == q for p, q in enumerate(out)))
        places.append(np.corrcoef(range(n), out)[0, 1])
    assert 0.2 < np.mean(fixed) < 3 and abs(np.mean(places)) < 0.05


def auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))


def test_importance_of_a_linear_model_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    n = 150
    y = rng.integers(0, 2, n)
    x = np.stack([y + rng.normal(size=n), rng.normal(size=n), rng.integers(0, 3, n).astype(float)], axis=1)
    ids = [f"r{i}" for i in range(n)]
    df = spark.createDataFrame([(ids[i], int(y[i]), *map(float, x[i])) for i in range(n)], "run_accession string, y int, a double, b double, c double")
    w = np.array([1.5, -0.25, 0.125])
    model = ml.LinearModel(None, 0.0, (0.5, *w), ("a", "b", "c"))
    got = {r.feature: r for r in ml.permutation_importance(df, ["a", "b", "c"], repeats=4, seed=9, model=model).collect()}
    import hashlib
    order = sorted(range(n), key=lambda i: (hashlib.md5(ids[i].encode()).hexdigest(), ids[i]))
    margin = 0.5 + x @ w
    for j, c in enumerate("abc"):
        drops = []
        for r in range(4):
            keys = permutation_keys(9, j, r)
            new = margin.copy()
            for p, i in enumerate(order):
                new[i] += w[j] * (x[order[by_hand(p, n, keys)], j] - x[i, j])
            drops.append(auc(y, margin) - auc(y, new))
        assert abs(got[c].importance_mean - np.mean(drops)) < 1e-9 and abs(got[c].importance_std - np.std(drops)) < 1e-9
    scored = ml.permutation_importance(df, ["a", "b", "c"], lambda d: d.withColumn("score", model.margin()), repeats=4, seed=9).collect()
    assert all(abs(r.importance_mean - got[r.feature].importance_mean) < 1e-9 for r in scored)


def test_components_match_a_plain_solver(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(200, 5)) @ rng.normal(size=(5, 5))
    x[:, 4] = 3.0
    df = spark.createDataFrame([(f"r{i}", *map(float, row)) for i, row in enumerate(x)], "run_accession string, a double, b double, c double, d double, e double")
    scores, ratio = ml.pca2(df, list("abcde"))
    z = (x - x.mean(0)) / np.where(x.std(0) > 0, x.std(0), 1.0)
    values, vectors = np.linalg.eigh(z.T @ z / len(z))
    assert np.allclose(ratio, values[::-1][:2] / values.sum(), atol=1e-9)
    for k, name in enumerate(("pc1", "pc2")):
        got = np.array([r[name] for r in sorted(scores.collect(), key=lambda r: int(r.run_accession[1:]))])
        want = z @ vectors[:, -1 - k]
        assert np.allclose(got, want, atol=1e-7) or np.allclose(got, -want, atol=1e-7)
    matrix = z.T @ z / len(z)
    lam, vec = ml.jacobi(matrix)
    assert np.abs(matrix @ vec - vec * lam).max() < 1e-10 and np.abs(vec.T @ vec - np.eye(5)).max() < 1e-10
    assert ml.pca2(df, ["a"]) == (None, [])
