import math

import numpy as np
from pyspark.sql import functions as F

from cohortlens.operators import ml
from cohortlens.operators.evaluation import eval_summary
from cohortlens.operators.folds import assign_folds


def _frame(spark, n=240):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, n)
    x1 = y * 2.0 + rng.normal(size=n)          # informative
    x2 = rng.normal(size=n)                    # noise
    rows = [(f"r{i}", int(y[i]), float(x1[i]), float(x2[i]), 1.0) for i in range(n)]
    return spark.createDataFrame(rows, "run_accession string, y int, x1 double, x2 double, const double")


def test_fit_cv_importance_pca(spark):
    df = _frame(spark)
    l1 = ml.ModelSpec("logistic_l1", "logistic_l1", C=2.0)
    model, use, score = ml.fit(df, ["x1", "x2", "const"], l1)
    coef = dict(zip(use, model.coefficients.toArray()))
    assert coef["x1"] > 0 and coef["const"] == 0.0
    co = {r.feature: r for r in ml.coefficients(model, use, spark).collect()}
    assert co["x1"].direction == "cancer-associated" and co["const"].direction == "healthy-associated"
    folds = assign_folds(df, 3, 1, 42)
    rf = ml.ModelSpec("random_forest", "random_forest", num_trees=10, max_depth=5)
    oof = ml.cross_validate(df, {"s": ["x1", "x2", "const"]}, [l1, rf], folds, threads=2)
    assert oof.count() == 2 * 240
    summ = {r.model: r for r in eval_summary(ml.cv_aucs(oof)).collect()}
    assert summ["logistic_l1"].auc_mean > 0.75 and summ["random_forest"].auc_mean > 0.7
    imp = {r.feature: r for r in ml.permutation_importance(df, use, score, repeats=3).collect()}
    assert imp["const"].importance_mean == 0.0 and imp["const"].importance_std == 0.0
    assert imp["x1"].importance_mean > imp["x2"].importance_mean
    scores, ratio = ml.pca2(df.withColumn("label", F.lit("x")), ["x1", "x2", "const"])
    assert scores.count() == 240 and 0.4 < ratio[0] <= 1.0 and ratio[0] >= ratio[1]


def test_standardize_population_std(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "a double, b double")
    out = ml.standardize(df, ["a", "b"]).collect()
    vals = [0.0 if r.a is None else r.a for r in out]
    a = np.array([1.0, 3.0, 0.0])
    assert np.allclose(sorted(vals), sorted((a - a.mean()) / a.std()))
    assert all(r.b == 0.0 for r in out)


def test_entry_and_registry(spark):
    import __spark_entry__ as ent
    df = ent.entry(spark)
    assert df.count() > 0
    assert "F_nucleatum_species_abundance" in df.columns
    q, o = ent.queries(), ent.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 60
    assert not math.isnan(len(q))


def test_analyse_composite(spark):
    from cohortlens.plans.analysis import analyse
    rng = np.random.default_rng(1)
    n = 120
    y = rng.integers(0, 2, n)
    rows = []
    for i in range(n):
        v = float(y[i] * 1.5 + rng.normal())
        rows.append((f"s{i}", f"r{i}", "cancer" if y[i] else "healthy", v, float(rng.normal()),
                     float(rng.normal()), int(rng.integers(0, 5)), float(rng.normal()), float(v > 0.7),
                     float(rng.normal()), int(rng.random() > 0.5)))
    schema = ("sample_id string, run_accession string, label string, F_nucleatum_species_abundance double, "
              "Fusobacterium_genus_abundance double, total_bacterial_abundance double, "
              "number_of_detected_species int, Shannon_diversity double, panel_a_log10 double, "
              "panel_b_log10 double, panel_a_present int")
    df = spark.createDataFrame(rows, schema)
    out = analyse(df, models=(ml.ModelSpec("logistic_l1", "logistic_l1", C=2.0),), k=3, repeats=1,
                  sensitivity_folds=(3,), perm_repeats=2, threads=2)
    assert out["model_comparison_results"].count() == 6
    assert out["cv_comparison_results"].count() == 12
    assert out["presence_effect_sizes"].count() == 1
    assert {"feature", "p_value", "importance_mean", "feature_type"} <= set(out["effect_importance"].columns)
    assert out["feature_importance"].count() > 0
