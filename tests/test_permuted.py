import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import ml
from cohortlens.operators.bijection import permutation_keys, permute
from cohortlens.operators.permuted import permuted_aucs, sent_back


def auc(score, y):
    pos, neg = score[y == 1], score[y == 0]
    return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))


def donors(spark, n, seed, j, r):
    keys = permutation_keys(seed, j, r)
    rows = spark.range(n).select(F.col("id").alias("pos"), *[F.lit(k).alias(f"k{i}") for i, k in enumerate(keys)])
    return np.array([x["donor"] for x in permute(rows, n).orderBy("pos").collect()])


def test_values_are_sent_where_the_bijection_takes_them_from(spark):
    for n in (1, 2, 97, 1000):
        d = donors(spark, n, 3, 1, 2)
        assert (sent_back(d, permutation_keys(3, 1, 2), n) == np.arange(n)).all()


@pytest.mark.parametrize("size", [100, 10_000])
def test_many_blocks_and_buckets_give_the_aucs_of_the_permuted_rows(spark, size):
    rng = np.random.default_rng(2)
    n, seed, weights = 700, 9, [0.5, -1.25]
    y = rng.integers(0, 2, n)
    x = np.stack([np.where(rng.random(n) < 0.8, -6.0, rng.normal(size=n)), rng.normal(size=n) - y], axis=1)
    margin = 0.25 + x @ weights
    rows = spark.createDataFrame([(i, int(y[i]), float(margin[i]), *map(float, x[i])) for i in rng.permutation(n).tolist()],
                                 "pos long, y int, margin double, x0 double, x1 double").repartition(3)
    got = {(r.j, r.r): r.auc for r in permuted_aucs(rows, n, weights, 3, seed, 9, rows_per_bucket=size, block=64).collect()}
    assert len(got) == 7 and got[2, 0] == pytest.approx(auc(np.round(margin, 9), y), abs=1e-12)
    for j in (0, 1):
        for r in range(3):
            d = donors(spark, n, seed, j, r)
            want = auc(np.round(margin + weights[j] * (x[d, j] - x[:, j]), 9), y)
            assert got[j, r] == pytest.approx(want, abs=1e-12)


def test_optimality_sums_are_those_of_the_rows(spark):
    df = spark.createDataFrame([("a", 1, 2.0, 1.0), ("b", 0, None, 1.0), ("c", 0, 4.0, 1.0)], "run_accession string, y int, v double, flat double")
    table = spark.createDataFrame([("s", "m", "v", 0.5, 0.25, -1.0), ("s", "m", "flat", 0.0, 0.0, -1.0)],
                                  "feature_set string, model string, feature string, coefficient double, raw_coefficient double, raw_intercept double")
    got = {r.feature: r for r in ml.optimality_sums(df, table, ["v", "flat"]).collect()}
    v = np.array([2.0, 0.0, 4.0])
    gap = 1 / (1 + np.exp(1.0 - 0.25 * v)) - np.array([1, 0, 0])
    assert got["v"].n == 3 and got["v"].w == 0.5 and got["v"].free == pytest.approx(gap.sum())
    assert got["v"].g == pytest.approx((gap * (v - 2) / v.std()).sum()) and got["flat"].g == 0
