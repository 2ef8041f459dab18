import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import stats as ss
from cohortlens.operators.prefix import prefix_sum

# Published presence effects (healthy mean, cancer mean,
# p-value) of the two cohorts; class sizes 20/20 and 40/40.
GOLDEN_20 = [
    (0.95, 0.70, 0.041961), (0.00, 0.20, 0.039817), (0.60, 0.75, 0.325443),
    (0.90, 1.00, 0.162449), (0.80, 0.90, 0.393874), (0.85, 0.75, 0.446592),
    (0.65, 0.75, 0.506466), (0.95, 1.00, 0.342112), (0.00, 0.05, 0.342112),
    (0.90, 0.95, 0.573359), (0.80, 0.85, 0.696281), (0.95, 0.95, 1.000000),
    (0.90, 0.90, 1.000000),
]
GOLDEN_40 = [
    (0.45, 0.15, 0.003693), (0.90, 0.70, 0.026753), (0.275, 0.45, 0.106955),
    (0.90, 0.775, 0.134056), (0.925, 0.825, 0.181755), (0.975, 0.875, 0.093598),
    (0.85, 0.75, 0.269558), (0.80, 0.725, 0.437330), (0.85, 0.775, 0.397088),
    (0.65, 0.725, 0.475785), (0.875, 0.825, 0.538872), (0.80, 0.75, 0.599256),
    (0.775, 0.725, 0.612333), (0.60, 0.65, 0.650371), (0.975, 0.925, 0.314030),
    (0.95, 0.90, 0.404797), (0.85, 0.80, 0.563608), (1.00, 0.975, 0.329560),
    (0.15, 0.125, 0.753099), (0.275, 0.30, 0.810841), (0.825, 0.80, 0.781370),
    (0.975, 0.975, 1.000000), (0.40, 0.40, 1.000000),
]


def _presence_frame(spark, golden, n):
    rows, cols = [], []
    for i, (h, c, _) in enumerate(golden):
        cols.append(f"f{i}")
    for cls, idx in ((0, 0), (1, 1)):
        for k in range(n):
            vals = []
            for (h, c, _) in golden:
                share = h if cls == 0 else c
                vals.append(1 if k < round(share * n) else 0)
            rows.append((f"{cls}-{k}", cls, *vals))
    schema = "run_accession string, y int, " + ", ".join(f"{c} int" for c in cols)
    return spark.createDataFrame(rows, schema), cols


@pytest.mark.parametrize("golden,n", [(GOLDEN_20, 20), (GOLDEN_40, 40)])
def test_published_presence_p_values(spark, golden, n):
    df, cols = _presence_frame(spark, golden, n)
    eff = {r.feature: r for r in ss.univariate_effects(df, cols, "presence").collect()}
    for i, (h, c, p) in enumerate(golden):
        r = eff[f"f{i}"]
        assert math.isclose(r.healthy_mean, h, abs_tol=1e-12)
        assert math.isclose(r.cancer_mean, c, abs_tol=1e-12)
        assert abs(r.p_value - p) < 2e-6, (i, r.p_value, p)


def test_constant_feature_skipped_and_null_p(spark):
    df = spark.createDataFrame([(0, 1.0, 1.0), (1, 1.0, None), (0, 1.0, 2.0), (1, 1.0, 3.0)],
                               "y int, const double, withnull double")
    eff = {r.feature: r for r in ss.univariate_effects(df, ["const", "withnull"], "x").collect()}
    assert "const" not in eff
    assert eff["withnull"].p_value is None


def _auc_brute(y, s):
    pos = [a for a, b in zip(s, y) if b == 1]
    neg = [a for a, b in zip(s, y) if b == 0]
    tot = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg)
    return tot / (len(pos) * len(neg))


def test_auc_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400).tolist()
    s = (rng.integers(0, 30, 400) / 10.0).tolist()  # many ties
    df = spark.createDataFrame(list(zip(range(400), y, s)), "id long, y int, score double")
    auc = ss.roc_auc(df).first().auc
    assert math.isclose(auc, _auc_brute(y, s), rel_tol=1e-12)


def _roc_reference(y, s):
    """Brute-force ROC points with the drop-intermediate rule."""
    y, s = np.asarray(y), np.asarray(s)
    order = np.argsort(-s, kind="mergesort")
    ys, ss_ = y[order], s[order]
    idx = np.where(np.diff(ss_))[0]
    thr_idx = np.r_[idx, ys.size - 1]
    tps = np.cumsum(ys)[thr_idx]
    fps = 1 + thr_idx - tps
    keep = np.where(np.r_[True, np.logical_or(np.diff(fps, 2), np.diff(tps, 2)), True])[0]
    return list(zip(fps[keep] / fps[-1], tps[keep] / tps[-1], ss_[thr_idx][keep]))


def test_roc_curve_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 300).tolist()
    s = (rng.integers(0, 40, 300) / 40.0).tolist()
    df = spark.createDataFrame(list(zip(y, s)), "y int, score double")
    got = [(r.fpr, r.tpr, r.threshold) for r in ss.roc_curve(df).orderBy("idx").collect()]
    assert got[0] == (0.0, 0.0, None)
    ref = _roc_reference(y, s)
    assert len(got) - 1 == len(ref)
    for a, b in zip(got[1:], ref):
        assert all(math.isclose(x, z, abs_tol=1e-12) for x, z in zip(a, b))


def test_prefix_sum_equals_window(spark):
    rng = np.random.default_rng(7)
    rows = [(int(k), float(v), int(c)) for k, v, c in zip(rng.integers(0, 3, 500), rng.permutation(500), rng.integers(1, 5, 500))]
    df = spark.createDataFrame(rows, "k long, v double, c long")
    a = {(r.k, r.v): r.c_cum for r in prefix_sum(df, ["v"], ["c"], ["k"], num_partitions=7).collect()}
    b = {(r.k, r.v): r.c_cum for r in prefix_sum(df, ["v"], ["c"], ["k"], strategy="window").collect()}
    assert a == b
    g = {r.v: r.c_cum for r in prefix_sum(df, [F.col("v").desc()], ["c"], num_partitions=5).collect()}
    tot = sum(r[2] for r in rows)
    assert g[max(g)] == [r for r in rows if r[1] == max(g)][0][2]
    assert g[min(g)] == tot


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(11)
    vals = np.round(rng.normal(size=301), 2)
    df = spark.createDataFrame([(int(i % 2), float(v)) for i, v in enumerate(vals)], "g long, value double")
    q = {(r.g, r.prob): r.quantile for r in ss.exact_quantiles(df, ["g"], (0.025, 0.25, 0.5, 0.975)).collect()}
    for g in (0, 1):
        sub = vals[np.arange(301) % 2 == g]
        for p in (0.025, 0.25, 0.5, 0.975):
            assert math.isclose(q[(g, p)], float(np.percentile(sub, p * 100)), abs_tol=1e-12)


def test_confusion_and_report(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.5), (1, 0.9), (1, 0.2), (1, 0.7)], "y int, score double")
    cm = {(r.y_true, r.y_pred): r["count"] for r in ss.confusion(df).collect()}
    assert cm == {(0, 0): 1, (0, 1): 1, (1, 0): 1, (1, 1): 2}
    rep = {r["class"]: r for r in ss.class_report(df).collect()}
    assert math.isclose(rep["cancer"].precision, 2 / 3) and math.isclose(rep["cancer"].recall, 2 / 3)
    assert math.isclose(rep["healthy"].precision, 0.5) and rep["healthy"].support == 2
    assert math.isclose(rep["accuracy"].f1, 3 / 5) and rep["accuracy"].support == 5
    only_neg = spark.createDataFrame([(0, 0.1)], "y int, score double")
    r = {x["class"]: x for x in ss.class_report(only_neg).collect()}
    assert r["cancer"].precision == 0.0 and r["cancer"].f1 == 0.0


def test_describe_and_box(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([("a", v) for v in vals], "label string, x double")
    d = ss.class_describe(df, ["x"]).first()
    assert d["count"] == 5 and d.q50 == 3.0 and math.isclose(d["std"], float(np.std(vals, ddof=1)))
    b = ss.box_stats(df, ["x"]).first()
    assert b.q1 == 2.0 and b.q3 == 4.0 and b.whisker_high == 4.0 and b.n_outliers == 1
