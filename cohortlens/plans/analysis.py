"""Composite group analysis (C6): the notebook's outputs as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators import evaluation as ev
from cohortlens.operators import ml
from cohortlens.operators import stats as ss
from cohortlens.operators.folds import assign_folds


def analyse(features: DataFrame, models: Sequence[ml.ModelSpec] = ml.DEFAULT_MODELS,
            k: int = 5, repeats: int = 10, seed: int = 42, single_seed: int = 42,
            sensitivity_folds: Sequence[int] = (3, 5, 8), perm_repeats: int = 50,
            threads: int = ml.MAX_DRIVER_THREADS) -> dict[str, DataFrame]:
    """Binary labels -> effects -> CV of every (set, model) -> best model ->
    coefficients, permutation importance, effect x importance, PCA.

    Returns the seven result tables of the reference plus the PCA scores."""
    from cohortlens.session import cut_lineage
    df = cut_lineage(ss.binary_labels(features))
    groups = ss.feature_groups(df.columns)
    df = ss.coerce_numeric(df, groups["all"])
    sets = ss.feature_sets(df.columns)
    presence = ss.univariate_effects(df, groups["panel_present"], "presence")
    log = ss.univariate_effects(df, groups["panel_log"], "log10_abundance")

    folds = assign_folds(df, k, repeats, seed)
    n_feat = {s: len(c) for s, c in sets.items()}
    size = df.sparkSession.createDataFrame(list(n_feat.items()), "feature_set string, n_features int")
    oof = ml.cross_validate(df, sets, models, folds, threads=threads)
    comparison = (ev.eval_summary(ml.cv_aucs(oof)).join(F.broadcast(size), "feature_set")
                  .orderBy(F.col("auc_mean").desc(), "feature_set", "model"))
    best = ev.best_model_per_set(comparison)
    single_folds = assign_folds(df, k, 1, single_seed)
    single_rows = []
    for r in best.collect():  # one row per feature set
        spec = next(m for m in models if m.name == r["model"])
        single_rows.append(ml.cross_validate(df, {r["feature_set"]: sets[r["feature_set"]]}, [spec],
                                             single_folds, threads=threads))
    single = single_rows[0]
    for x in single_rows[1:]:
        single = single.unionByName(x)
    cv_cmp = ev.cv_compare(ev.eval_summary(ml.cv_aucs(single)), best)

    l1 = next((m for m in models if m.kind == "logistic_l1"), models[0])
    sens = []
    for kk in sensitivity_folds:
        f = assign_folds(df, kk, repeats, seed)
        s = ev.eval_summary(ml.cv_aucs(ml.cross_validate(df, sets, [l1], f, threads=threads)))
        sens.append(s.withColumn("cv_scheme", F.lit(f"{kk}fold_x{repeats}")))
    sensitivity = sens[0]
    for s in sens[1:]:
        sensitivity = sensitivity.unionByName(s)

    top = ev.best_overall(comparison).first()
    spec = next(m for m in models if m.name == top["model"])
    cols = sets[top["feature_set"]]
    model, use, score = ml.fit(df, cols, spec)
    perm = ml.permutation_importance(df, use, score, repeats=perm_repeats, seed=seed)
    # A forest has no coefficients; its feature importance is the permutation table.
    importance = ml.coefficients(model, use, df.sparkSession) if spec.scaled else perm
    effects = (presence.withColumn("feature_type", F.lit("presence"))
               .unionByName(log.withColumn("feature_type", F.lit("log10_abundance"))))
    pca_scores, ratio = ml.pca2(df, cols)
    out = {
        "model_comparison_results": comparison,
        "cv_comparison_results": cv_cmp,
        "cv_sensitivity_results": sensitivity,
        "presence_effect_sizes": presence.orderBy(*ss.effect_order(presence)),
        "log_effect_sizes": log.orderBy(*ss.effect_order(log)),
        "permutation_importance": perm,
        "effect_importance": effects.join(perm, "feature", "inner"),
    }
    out["feature_importance"] = importance
    if pca_scores is not None:
        out["pca_scores"] = pca_scores.withColumn("explained_variance_1", F.lit(ratio[0])) \
                                      .withColumn("explained_variance_2", F.lit(ratio[1]))
    return out
