"""Group comparison statistics: descriptive summaries, exact quantiles,
rank-sum effects, ROC/AUC, confusion matrix and classification report.

Everything is grouped aggregation plus the distributed prefix sum; no
statistic gathers a group's values into one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.columns import erfc
from cohortlens.operators.prefix import prefix_sum
from cohortlens.operators.quantiles import BINS_BROADCAST_MAX, quantile_columns
from cohortlens.operators.salted import salted_join
from cohortlens.session import cut_lineage

CORE = ("F_nucleatum_species_abundance", "Fusobacterium_genus_abundance",
        "total_bacterial_abundance", "number_of_detected_species", "Shannon_diversity",
        "sequencing_depth_proxy")
DIVERSITY = ("Shannon_diversity", "number_of_detected_species", "total_bacterial_abundance")
SUMMARY = ("sequencing_depth_proxy", "number_of_detected_species", "Shannon_diversity",
           "total_bacterial_abundance")
FUSO = ("Fusobacterium_genus_abundance", "F_nucleatum_species_abundance")


# ---- projection helpers (F6-F8) ----------------------------------------------
def binary_labels(df: DataFrame, negative: str = "healthy", positive: str = "cancer") -> DataFrame:
    """keep the two classes; y = 0 / 1."""
    return (df.filter(F.col("label").isin(negative, positive))
              .withColumn("y", F.when(F.col("label") == positive, 1).otherwise(0)))


def feature_groups(columns: Sequence[str]) -> dict[str, list[str]]:
    """F8: column groups by name (only existing columns, order kept)."""
    cols = list(columns)
    core = [c for c in CORE if c in cols]
    div = [c for c in DIVERSITY if c in cols]
    raw = [c for c in cols if c.startswith("panel_") and not c.endswith("_log10")
           and not c.endswith("_present")]
    log = [c for c in cols if c.startswith("panel_") and c.endswith("_log10")]
    pres = [c for c in cols if c.startswith("panel_") and c.endswith("_present")]
    return {"core": core, "diversity": div, "panel_raw": raw, "panel_log": log,
            "panel_present": pres, "all": list(dict.fromkeys(core + log + pres))}


def feature_sets(columns: Sequence[str]) -> dict[str, list[str]]:
    """The six fixed feature sets of the group analysis."""
    g = feature_groups(columns)
    return {
        "fuso_only": [c for c in FUSO if c in columns],
        "diversity_only": g["diversity"],
        "panel_log": g["panel_log"],
        "panel_presence": g["panel_present"],
        "panel_log_plus_diversity": g["panel_log"] + g["diversity"],
        "panel_presence_plus_diversity": g["panel_present"] + g["diversity"],
    }


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """invalid numbers and NaN -> NULL (try_cast; plain cast raises under ANSI)."""
    return df.withColumns({c: F.nanvl(F.col(f"`{c}`").try_cast("double"), F.lit(None)) for c in cols})


def to_long(df: DataFrame, cols: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """Unpivot numeric columns to (ids..., feature, value DOUBLE)."""
    return df.unpivot(list(ids), [F.col(f"`{c}`").cast("double").alias(c) for c in cols],
                      "feature", "value")


# ---- descriptive (A13-A17) ---------------------------------------------------
def label_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("label").agg(F.count("*").alias("count"))


def feature_sanity(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per feature missing, distinct non-null, mean, sample std."""
    long = to_long(df, cols)
    v = F.col("value")
    return long.groupBy("feature").agg(
        F.count_if(v.isNull()).alias("missing"),
        F.count_distinct(v).alias("n_unique"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"))


def null_counts(df: DataFrame, top: int = 15) -> DataFrame:
    """Nulls per column, largest first (name breaks ties), top n."""
    sums = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    long = sums.unpivot([], [F.col(f"`{c}`") for c in df.columns], "column", "nulls")
    return long.orderBy(F.col("nulls").desc(), F.col("column")).limit(top)


def exact_quantiles(long: DataFrame, keys: Sequence[str], probs: Sequence[float],
                    value: str = "value") -> DataFrame:
    """The quantiles of ``quantile_columns`` in long form: (keys..., prob, quantile)."""
    names = [f"__q{i}" for i in range(len(probs))]
    wide = quantile_columns(long, keys, probs, names, value)
    rows = F.array(*[F.struct(F.lit(float(p)).alias("prob"), F.col(n).alias("quantile")) for p, n in zip(probs, names)])
    return wide.select(*keys, F.inline(rows))


def class_describe(df: DataFrame, cols: Sequence[str], label: str = "label") -> DataFrame:
    """Per (label, feature) count, mean, std, min, 25%, 50%, 75%, max."""
    long = to_long(df, cols, [label])
    v = F.col("value")
    base = long.groupBy(label, "feature").agg(
        F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max"))
    q = quantile_columns(long, [label, "feature"], (0.25, 0.5, 0.75), ("q25", "q50", "q75"))
    return base.join(q, [label, "feature"], "left").select(
        label, "feature", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def box_stats(df: DataFrame, cols: Sequence[str], label: str = "label") -> DataFrame:
    """Quartiles, 1.5 IQR whiskers (most extreme points inside the
    fences) and outlier counts per (label, feature)."""
    long = to_long(df, cols, [label]).filter(F.col("value").isNotNull())
    q = quantile_columns(long, [label, "feature"], (0.25, 0.5, 0.75), ("q1", "median", "q3"))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    lo_f = F.col("q1") - 1.5 * F.col("iqr")
    hi_f = F.col("q3") + 1.5 * F.col("iqr")
    v = F.col("value")
    # One row per (class, feature): broadcast where there are few, else the
    # values of a large (class, feature) are dealt over several tasks.
    q = cut_lineage(q)
    j = (long.join(F.broadcast(q), [label, "feature"]) if q.count() <= BINS_BROADCAST_MAX
         else salted_join(long, q, [label, "feature"]))
    agg = j.groupBy(label, "feature").agg(
        F.min(F.when(v >= lo_f, v)).alias("whisker_low"),
        F.max(F.when(v <= hi_f, v)).alias("whisker_high"),
        F.count_if((v < lo_f) | (v > hi_f)).alias("n_outliers"),
        F.count("*").alias("n"))
    return q.join(agg, [label, "feature"]).select(
        label, "feature", "n", "q1", "median", "q3", "iqr", "whisker_low", "whisker_high", "n_outliers")


# ---- rank-sum machinery (M1, M2) ---------------------------------------------
def rank_sums(long: DataFrame, keys: Sequence[str], value: str = "value", y: str = "y", most: int | None = None) -> DataFrame:
    """Per key (of ``most`` rows at most, where that is known): N0, N1, R0 (= rank sum of class 0, tied ranks averaged),
    R1 and the tie term sum(t^3 - t).  Works on distinct values only."""
    keys = list(keys)
    v = F.col(value)
    counts = long.groupBy(*keys, value).agg(
        F.count_if(F.col(y) == 0).cast("double").alias("n0"),
        F.count_if(F.col(y) == 1).cast("double").alias("n1"))
    counts = counts.withColumn("t", F.col("n0") + F.col("n1"))
    cum = prefix_sum(counts, [value], ["t"], keys, rows=long if most is None else most)
    avg_rank = F.col("t_cum") - F.col("t") + (F.col("t") + 1) / 2
    return cum.groupBy(*keys).agg(
        F.sum("n0").alias("N0"), F.sum("n1").alias("N1"),
        F.sum(F.col("n0") * avg_rank).alias("R0"), F.sum(F.col("n1") * avg_rank).alias("R1"),
        F.sum(F.col("t") * F.col("t") * F.col("t") - F.col("t")).alias("tie"))


def mann_whitney_p(N0: Column, N1: Column, R0: Column, tie: Column) -> Column:
    """Two-sided asymptotic p with tie and continuity correction."""
    N = N0 + N1
    U0 = R0 - N0 * (N0 + 1) / 2
    U = F.greatest(U0, N0 * N1 - U0)
    s = F.sqrt(N0 * N1 / 12 * ((N + 1) - tie / (N * (N - 1))))
    z = (U - N0 * N1 / 2 - 0.5) / s
    return F.least(F.lit(1.0), erfc(z / F.lit(math.sqrt(2.0))))


#: A class of at most so many values, without ties, gets the exact p-value.
EXACT_SIZE = 8


def exact_rank_sum_p(n0: int, n1: int, u: float) -> float:
    """Two-sided exact p of U = ``u`` (the larger one) without ties.

    Counts the ways in which the smaller class can take its ranks, one rank at
    a time: ways[k][s] of k ranks with a rank sum of s above the least one."""
    import numpy as np
    k, top = int(min(n0, n1)), int(n0 * n1)
    ways = np.zeros((k + 1, top + 1))
    ways[0, 0] = 1.0
    for rank in range(int(n0 + n1)):
        # Taking this rank as the j-th adds rank - (j - 1) to U.
        for j in range(min(k, rank + 1), 0, -1):
            step = rank - (j - 1)
            if step <= top:
                ways[j, step:] += ways[j - 1, :top + 1 - step]
    share = ways[k] / ways[k].sum()
    return float(min(1.0, 2 * share[int(math.ceil(u)):].sum()))


def _with_exact_p(effects: DataFrame) -> DataFrame:
    """Replace the asymptotic p of small classes without ties (columns N0, N1, R0, tie, p)."""
    small = (F.least("N0", "N1") <= EXACT_SIZE) & (F.least("N0", "N1") > 0) & (F.col("tie") == 0)
    u0 = F.col("R0") - F.col("N0") * (F.col("N0") + 1) / 2
    effects = effects.withColumn("U", F.greatest(u0, F.col("N0") * F.col("N1") - u0))
    # As many rows as there are features.
    cases = effects.filter(small).select("N0", "N1", "U").distinct().collect()
    if not cases:
        return effects
    rows = [(r["N0"], r["N1"], r["U"], exact_rank_sum_p(int(r["N0"]), int(r["N1"]), r["U"])) for r in cases]
    table = effects.sparkSession.createDataFrame(rows, "e0 double, e1 double, eu double, exact_p double")
    return effects.join(F.broadcast(table), small & (F.col("N0") == F.col("e0")) & (F.col("N1") == F.col("e1"))
                        & (F.col("U") == F.col("eu")), "left").withColumn("p", F.coalesce("exact_p", "p"))


def univariate_effects(df: DataFrame, cols: Sequence[str], source: str, y: str = "y") -> DataFrame:
    """Per feature healthy/cancer means, difference, absolute
    difference and rank-sum p; constant features skipped; a feature with
    nulls gets a NULL p (NaN propagates in the reference test)."""
    cols = [c for c in cols if c in df.columns]
    long = to_long(df.select(y, *[F.col(f"`{c}`") for c in cols]), cols, [y])
    v = F.col("value")
    means = long.groupBy("feature").agg(
        F.avg(F.when(F.col(y) == 0, v)).alias("healthy_mean"),
        F.avg(F.when(F.col(y) == 1, v)).alias("cancer_mean"),
        F.count_distinct(v).alias("n_unique"),
        F.count_if(v.isNull()).alias("n_null"))
    rs = rank_sums(long.filter(v.isNotNull()), ["feature"], "value", y)
    p = mann_whitney_p(F.col("N0"), F.col("N1"), F.col("R0"), F.col("tie"))
    out = means.filter(F.col("n_unique") > 1).join(rs, "feature", "left").withColumn("p", p)
    # A feature with nulls has no p-value, so the class sizes decide for all of them.
    sizes = df.agg(F.count_if(F.col(y) == 0), F.count_if(F.col(y) == 1)).first()
    if min(sizes) <= EXACT_SIZE:
        out = _with_exact_p(out)
    diff = F.col("cancer_mean") - F.col("healthy_mean")
    return out.select(
        "feature", F.lit(source).alias("feature_source"), "healthy_mean", "cancer_mean",
        diff.alias("mean_diff"), F.abs(diff).alias("abs_diff"),
        F.when(F.col("n_null") == 0, F.col("p")).alias("p_value"))


def effect_order(effects: DataFrame) -> list[Column]:
    """abs_diff desc (rounded to 12 digits: equal differences tie), p asc,
    feature asc."""
    return [F.round("abs_diff", 12).desc(), F.col("p_value").asc_nulls_last(), F.col("feature")]


def top_effects(effects: DataFrame, n: int = 15) -> DataFrame:
    return effects.orderBy(*effect_order(effects)).limit(n)


def direction_table(log_effects: DataFrame, presence_effects: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` log effects, or presence effects where there are none: means, differences, p."""
    use = presence_effects if log_effects.isEmpty() else log_effects
    return use.orderBy(*effect_order(use)).limit(n).select(
        "feature", "healthy_mean", "cancer_mean", "mean_diff", "abs_diff", "p_value")


def least_varying(sanity: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` features with the fewest distinct values (name breaks ties)."""
    return sanity.orderBy("n_unique", "feature").limit(n)


def roc_auc(scores: DataFrame, keys: Sequence[str] = (), score: str = "score", y: str = "y", most: int | None = None) -> DataFrame:
    """M2: AUC = (R1 - N1(N1+1)/2) / (N0 N1), ties counted half."""
    rs = rank_sums(scores.select(*keys, F.col(score).alias("value"), y), keys, "value", y, most)
    auc = (F.col("R1") - F.col("N1") * (F.col("N1") + 1) / 2) / (F.col("N0") * F.col("N1"))
    return rs.select(*keys, auc.alias("auc"), F.col("N1").cast("bigint").alias("n_pos"),
                     F.col("N0").cast("bigint").alias("n_neg"))


def roc_curve(scores: DataFrame, score: str = "score", y: str = "y") -> DataFrame:
    """M3: (fpr, tpr, threshold) at distinct thresholds, descending, with
    intermediate points dropped where both increments repeat, and a leading
    (0, 0) point at threshold +inf (reported as NULL)."""
    s = F.col(score)
    pts = scores.groupBy(score).agg(F.count_if(F.col(y) == 1).alias("dtp"),
                                    F.count_if(F.col(y) == 0).alias("dfp"))
    pts = pts.withColumn("one", F.lit(1))
    cum = prefix_sum(pts, [s.desc()], ["dtp", "dfp", "one"], measure=-s)
    cum = cum.withColumnRenamed("one_cum", "idx")
    tot = scores.agg(F.count_if(F.col(y) == 1).alias("P"), F.count_if(F.col(y) == 0).alias("Nn"),
                     F.count_distinct(s).alias("K")).first()
    P, Nn, K = tot["P"], tot["Nn"], tot["K"]
    nxt = cum.select((F.col("idx") - 1).alias("idx"), F.col("dtp").alias("ntp"),
                     F.col("dfp").alias("nfp"))
    j = cum.join(nxt, "idx", "left")
    keep = ((F.col("idx") == 1) | (F.col("idx") == K) | F.col("ntp").isNull()
            | (F.col("ntp") != F.col("dtp")) | (F.col("nfp") != F.col("dfp")))
    pts_kept = j.filter(keep).select(
        (F.col("dfp_cum") / F.lit(float(Nn) if Nn else float("nan"))).alias("fpr"),
        (F.col("dtp_cum") / F.lit(float(P) if P else float("nan"))).alias("tpr"),
        s.cast("double").alias("threshold"), F.col("idx").cast("bigint").alias("idx"))
    origin = scores.sparkSession.createDataFrame([(0.0, 0.0, None, 0)],
                                                 "fpr double, tpr double, threshold double, idx bigint")
    return origin.unionByName(pts_kept)


def confusion(scores: DataFrame, threshold: float = 0.5, score: str = "score", y: str = "y") -> DataFrame:
    """2x2 counts at an inclusive threshold; empty cells are 0."""
    pred = F.when(F.col(score) >= threshold, 1).otherwise(0)
    counts = scores.groupBy(F.col(y).cast("int").alias("y_true"), pred.alias("y_pred")).agg(
        F.count("*").alias("count"))
    cells = scores.sparkSession.createDataFrame([(0, 0), (0, 1), (1, 0), (1, 1)],
                                                "y_true int, y_pred int")
    return (cells.join(counts, ["y_true", "y_pred"], "left")
                 .select("y_true", "y_pred", F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def class_report(scores: DataFrame, threshold: float = 0.5, names=("healthy", "cancer"),
                 score: str = "score", y: str = "y") -> DataFrame:
    """Precision, recall, F1, support per class, accuracy, macro and
    weighted averages; zero denominators give 0."""
    c = confusion(scores, threshold, score, y)
    cell = {}
    agg = c.agg(*[F.sum(F.when((F.col("y_true") == t) & (F.col("y_pred") == p), F.col("count")))
                  .alias(f"c{t}{p}") for t in (0, 1) for p in (0, 1)])
    for t in (0, 1):
        for p in (0, 1):
            cell[(t, p)] = F.col(f"c{t}{p}").cast("double")

    def safe(num, den):
        return F.when(den > 0, num / den).otherwise(F.lit(0.0))

    rows = []
    total = cell[(0, 0)] + cell[(0, 1)] + cell[(1, 0)] + cell[(1, 1)]
    prec, rec, f1, sup = {}, {}, {}, {}
    for k in (0, 1):
        o = 1 - k
        tp, fp, fn = cell[(k, k)], cell[(o, k)], cell[(k, o)]
        prec[k] = safe(tp, tp + fp)
        rec[k] = safe(tp, tp + fn)
        f1[k] = safe(2 * prec[k] * rec[k], prec[k] + rec[k])
        sup[k] = tp + fn
        rows.append(F.struct(F.lit(names[k]).alias("class"), prec[k].alias("precision"),
                             rec[k].alias("recall"), f1[k].alias("f1"), sup[k].alias("support")))
    acc = safe(cell[(0, 0)] + cell[(1, 1)], total)
    rows.append(F.struct(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                         F.lit(None).cast("double").alias("recall"), acc.alias("f1"), total.alias("support")))
    rows.append(F.struct(F.lit("macro avg").alias("class"), ((prec[0] + prec[1]) / 2).alias("precision"),
                         ((rec[0] + rec[1]) / 2).alias("recall"), ((f1[0] + f1[1]) / 2).alias("f1"),
                         total.alias("support")))
    wavg = [safe(m[0] * sup[0] + m[1] * sup[1], total) for m in (prec, rec, f1)]
    rows.append(F.struct(F.lit("weighted avg").alias("class"), wavg[0].alias("precision"),
                         wavg[1].alias("recall"), wavg[2].alias("f1"), total.alias("support")))
    return agg.select(F.inline(F.array(*rows))).withColumn("support", F.col("support").cast("bigint"))
