import math

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from cohortlens.operators import logistic as lg
from cohortlens.operators import ml
from cohortlens.operators.folds import assign_folds
from cohortlens.plans.q_models import _flag_cells


def frame(spark, n=300, seed=0):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    x = rng.normal(size=(n, 4))
    x[:, 0] += 0.8 * y
    x[:, 1] = (rng.random(n) < 0.3 + 0.3 * y).astype(float)
    x[:, 2] = 1e6 + 3 * x[:, 2]
    rows = [(f"r{i}", int(y[i]), *map(float, x[i]), 5.0) for i in range(n)]
    return spark.createDataFrame(rows, "run_accession string, y int, a double, b double, c double, d double, flat double"), x, y


def brute(x, y, penalty, C):
    """Proximal gradient steps with the scaled columns, until nothing moves."""
    z = np.concatenate([np.ones((len(x), 1)), (x - x.mean(0)) / np.where(x.std(0) > 0, x.std(0), 1.0)], axis=1)
    lam = 0.0 if math.isinf(C) else 1 / C
    step = 4.0 / np.linalg.eigvalsh(z.T @ z + (lam if penalty == "l2" else 0.0) * 4 * np.eye(z.shape[1])).max()
    w = v = np.zeros(z.shape[1])
    for k in range(20_000):
        g = z.T @ (1 / (1 + np.exp(-z @ v)) - y)
        if penalty == "l2":
            g[1:] += lam * v[1:]
        new = v - step * g
        if penalty == "l1":
            new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * lam, 0)
        v = new + k / (k + 3) * (new - w)
        if np.abs(new - w).max() < 1e-13 and k > 100:
            break
        w = new
    return w


def test_many_models_match_a_plain_solver(spark):
    df, x, y = frame(spark)
    x = np.concatenate([x, np.full((len(x), 1), 5.0)], axis=1)
    folds = assign_folds(df, 3, 2, 42)
    where = {(r.run_accession, r.repeat): r.fold for r in folds.collect()}
    sets = {"all": ["a", "b", "c", "d", "flat"], "two": ["d", "a"], "none": []}
    models = [ml.ModelSpec("l1", "logistic_l1", C=0.05), ml.ModelSpec("l2", "logistic_l2", C=1.0)]
    fits, cols, _ = ml.fit_logistic_models(df, sets, models, folds)
    assert len(fits) == 2 * 2 * 6 and all(f.done and f.violation <= 1e-8 * f.n for f in fits)
    for f in fits:
        own = [cols.index(c) for c in sets[f.feature_set]]
        train = np.array([where[f"r{i}", f.repeat] != f.fold for i in range(len(x))])
        want = brute(x[train][:, own], y[train], f.penalty, f.C)
        assert f.n == train.sum() and np.allclose(np.r_[f.intercept, f.weights], want, atol=2e-5)
    assert any((f.weights == 0).any() for f in fits if f.penalty == "l1")


def test_scores_cover_every_row_once_and_use_the_model_without_it(spark):
    df, x, y = frame(spark, 120, 3)
    folds = assign_folds(df, 4, 2, 7)
    models = [ml.ModelSpec("l2", "logistic_l2", C=1.0)]
    scores = ml.cross_validate(df, {"s": ["a", "b"]}, models, folds)
    got = scores.collect()
    assert sorted((r.run_accession, r.repeat, r.fold) for r in got) == sorted(
        (r.run_accession, r.repeat, r.fold) for r in folds.collect())
    fits, cols, _ = ml.fit_logistic_models(df, {"s": ["a", "b"]}, models, folds)
    by_place = {(f.repeat, f.fold): f for f in fits}
    for r in got[::17]:
        i = int(r.run_accession[1:])
        f = by_place[r.repeat, r.fold]
        assert r.score == pytest.approx(1 / (1 + math.exp(-(f.raw[0] + f.raw[1:] @ x[i, :2]))), abs=1e-9) and r.y == y[i]


def test_one_binary_column_gives_the_log_odds_ratio(spark):
    df, x, y = frame(spark, 400, 5)
    rows = lg.training_rows(df, ["b"], None, "run_accession")
    f = lg.fit_all(rows, [lg.Fit("s", (0,), "m", "l2", math.inf)], 1)[0]
    n = np.array([[((x[:, 1] == v) & (y == k)).sum() for k in (0, 1)] for v in (0, 1)], float)
    assert f.raw[1] == pytest.approx(math.log(n[1, 1] * n[0, 0] / (n[1, 0] * n[0, 1])), abs=1e-8)
    assert f.raw[0] == pytest.approx(math.log(n[0, 1] / n[0, 0]), abs=1e-8)


def test_nulls_one_class_and_no_rows(spark):
    df = spark.createDataFrame([("a", 1, None), ("b", 1, float("nan")), ("c", 0, 2.0), ("d", 0, 1.0)], "run_accession string, y int, v double")
    f = lg.fit_all(lg.training_rows(df, ["v"], None, "run_accession"), [lg.Fit("s", (0,), "m", "l2", 1.0)], 1)[0]
    assert f.done and f.means[0] == 0.75 and f.weights[0] < 0
    one = lg.fit_all(lg.training_rows(df.where("y = 1"), ["v"], None, "run_accession"), [lg.Fit("s", (0,), "m", "l1", 1.0)], 1)[0]
    assert one.done and one.weights[0] == 0 and np.isfinite(one.intercept)
    none = lg.fit_all(lg.training_rows(df.where("y = 5"), ["v"], None, "run_accession"), [lg.Fit("s", (0,), "m", "l1", 1.0)], 1)[0]
    assert none.done and none.n == 0


def test_forest_rows_are_bounded(spark):
    df, _, _ = frame(spark, 300, 2)
    spec = ml.ModelSpec("f", "random_forest", num_trees=5, max_depth=4, max_fit_rows=100)
    model, use, score = ml.fit(df, ["a", "b"], spec)
    assert score(df).count() == 300 and score(df).agg(F.max("score")).first()[0] <= 1


def test_a_forest_scores_in_a_session_that_has_observed_a_query(spark):
    seen = Observation("rows")
    spark.range(10).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 10
    df, _, _ = frame(spark, 60, 2)
    _, _, score = ml.fit(df, ["a", "b"], ml.ModelSpec("f", "random_forest", num_trees=2, max_depth=2))
    assert score(df).where("score between 0 and 1").count() == 60


def test_flag_cells_count_rows_without_repeating_them(spark):
    rows = [(0, f, y, a, b) for f in (0, 1) for y, a, b in ((0, 1, 0), (0, 0, None), (1, 1, 1), (1, 1, 0))]
    df = spark.createDataFrame(rows, "repeat int, fold int, y int, a int, b int").repartition(3)
    cells = _flag_cells(df, ["a", "b"])
    got = {(r.feature, r.fold): (r.n00, r.n01, r.n10, r.n11) for r in cells.collect()}
    assert got == {(n, f): v for f in (0, 1) for n, v in (("a", (1, 0, 1, 2)), ("b", (1, 1, 0, 1)))}
    # One generator, over the counts: none stands below the first aggregate.
    plan = cells._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1 and plan.index("Generate") < plan.rindex("Aggregate")
