"""Queries: descriptive statistics, rank-sum effects, ROC/AUC, confusion."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.operators import stats as ss
from cohortlens.plans.catalog import register
from cohortlens.plans.oracle import add_cte, mw_p_sql, sql
from cohortlens.plans.q_features import _features
from cohortlens.sources import tables as tb

CORE6 = ["F_nucleatum_species_abundance", "Fusobacterium_genus_abundance",
         "total_bacterial_abundance", "number_of_detected_species", "Shannon_diversity",
         "sequencing_depth_proxy"]

_core_union = "\nUNION ALL\n".join(
    f"SELECT run_accession, label, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM core" for c in CORE6)
add_cte("flong", ("core", "pv", "md"), _core_union + """
UNION ALL
SELECT p.run_accession, m.label, p.col || '_log10', log10(p.v + 1e-6) FROM pv p JOIN md m USING (run_accession)
UNION ALL
SELECT p.run_accession, m.label, p.col || '_present', CASE WHEN p.v >= 1e-4 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
FROM pv p JOIN md m USING (run_accession)""")
add_cte("blong", ("flong",), """
SELECT run_accession, label, CASE WHEN label = 'cancer' THEN 1 ELSE 0 END AS y, feature, value
FROM flong WHERE label IN ('healthy', 'cancer')""")


_STAGED_MATRIX: dict = {}


def _binary(spark, sf):
    """The two-class feature matrix, written once per session and table
    folder to the shared checkpoint folder: the group analysis starts from a
    stored matrix, as the reference's notebook reads the feature CSV, and
    every statistic reuses it instead of re-deriving the features."""
    from cohortlens.session import write_staged
    key = (spark.sparkContext.applicationId, sf)
    if key not in _STAGED_MATRIX:
        _STAGED_MATRIX[key] = write_staged(ss.binary_labels(_features(spark, sf).targeted), "two-class-matrix")
    return _STAGED_MATRIX[key]


#: The features are sums of doubles, whose last bits go by the order of the
#: rows; the queries settle them before two engines compare equal values.
SETTLED_DIGITS = 9


def _settled(df, cols):
    return df.withColumns({c: F.round(F.col(f"`{c}`").cast("double"), SETTLED_DIGITS) for c in cols})


def _effects_sql(suffix: str, source: str) -> str:
    return sql(["blong"], f"""
, e AS (SELECT * REPLACE (round(value, 9) AS value) FROM blong WHERE feature LIKE 'panel\\_%{suffix}' ESCAPE '\\'),
cnt AS (SELECT feature, value, count_if(y = 0)::DOUBLE AS n0, count_if(y = 1)::DOUBLE AS n1
        FROM e WHERE value IS NOT NULL GROUP BY ALL),
rk AS (SELECT *, n0 + n1 AS t, sum(n0 + n1) OVER (PARTITION BY feature ORDER BY value
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM cnt),
rs AS (SELECT feature, sum(n0) AS N0, sum(n1) AS N1, sum(n0 * (cum - t + (t + 1) / 2)) AS R0,
              sum(t * t * t - t) AS tie FROM rk GROUP BY feature),
mn AS (SELECT feature, avg(CASE WHEN y = 0 THEN value END) AS hm, avg(CASE WHEN y = 1 THEN value END) AS cm,
              count(DISTINCT value) AS nu, count_if(value IS NULL) AS nn FROM e GROUP BY feature)
SELECT feature, '{source}' AS feature_source, round(hm, 6) AS healthy_mean, round(cm, 6) AS cancer_mean,
       round(cm - hm, 6) AS mean_diff, round(abs(cm - hm), 6) AS abs_diff,
       CASE WHEN nn = 0 THEN round({mw_p_sql()}, 6) END AS p_value
FROM mn LEFT JOIN rs USING (feature) WHERE nu > 1""").replace("\n, e AS", ",\ne AS", 1)


@register("label_counts", sql(["core"], """
SELECT label, count(*) AS count FROM core WHERE label IN ('healthy', 'cancer') GROUP BY label"""))
def q_label_counts(spark, sf):
    """Class sizes after keeping the two labels."""
    return ss.label_counts(_binary(spark, sf))


@register("feature_sanity", sql(["blong"], """
SELECT feature, count_if(value IS NULL) AS missing, count(DISTINCT round(value, 9)) AS n_unique,
       round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std FROM blong GROUP BY feature"""))
def q_feature_sanity(spark, sf):
    """Missing, distinct, mean and sample std of every model feature."""
    df = _binary(spark, sf)
    cols = ss.feature_groups(df.columns)["all"]
    return ss.feature_sanity(_settled(ss.coerce_numeric(df, cols), cols), cols)


_CORE_ALL = ["sample_id", "run_accession", "label", "age_group", "library_name", *CORE6]


@register("null_counts", sql(["core", "pv", "md"], "SELECT * FROM (" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", count_if({c} IS NULL) AS nulls FROM core WHERE label IN ('healthy', 'cancer')"""
    for c in _CORE_ALL) + """
UNION ALL
SELECT p.col || s.suffix, count_if(p.v IS NULL) FROM pv p JOIN md m USING (run_accession),
  (VALUES (''), ('_log10'), ('_present')) s(suffix)
WHERE m.label IN ('healthy', 'cancer') GROUP BY ALL) u
ORDER BY nulls DESC, "column" LIMIT 15"""))
def q_null_counts(spark, sf):
    """Null count per column, top 15 (count desc, name asc)."""
    return ss.null_counts(_binary(spark, sf).drop("y"))


@register("class_describe", sql(["blong"], """
SELECT label, feature, count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
       round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS q25,
       round(quantile_cont(value, 0.5), 6) AS q50, round(quantile_cont(value, 0.75), 6) AS q75,
       round(max(value), 6) AS max
FROM blong WHERE feature IN ('sequencing_depth_proxy', 'number_of_detected_species', 'Shannon_diversity',
                             'total_bacterial_abundance')
GROUP BY label, feature"""))
def q_class_describe(spark, sf):
    """Per class count/mean/std/min/quartiles/max of the summary columns."""
    return ss.class_describe(_binary(spark, sf), list(ss.SUMMARY))


@register("box_stats", sql(["blong"], """
, b AS (SELECT * FROM blong WHERE value IS NOT NULL AND feature IN ('sequencing_depth_proxy',
        'number_of_detected_species', 'Shannon_diversity', 'total_bacterial_abundance')),
q AS (SELECT label, feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
             quantile_cont(value, 0.75) AS q3 FROM b GROUP BY ALL)
SELECT q.label, q.feature, count(*) AS n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(q3 - q1, 6) AS iqr,
       round(min(CASE WHEN value >= q1 - 1.5 * (q3 - q1) THEN value END), 6) AS whisker_low,
       round(max(CASE WHEN value <= q3 + 1.5 * (q3 - q1) THEN value END), 6) AS whisker_high,
       count_if(value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM b JOIN q USING (label, feature) GROUP BY q.label, q.feature, q1, median, q3""").replace("\n, b AS", ",\nb AS", 1))
def q_box_stats(spark, sf):
    """Quartiles, whiskers at 1.5 IQR and outlier counts per class."""
    return ss.box_stats(_binary(spark, sf), list(ss.SUMMARY))


@register("effects_presence", _effects_sql("\\_present", "presence"))
def q_effects_presence(spark, sf):
    """Presence features: class means, difference, rank-sum p."""
    df = _binary(spark, sf)
    cols = ss.feature_groups(df.columns)["panel_present"]
    return ss.univariate_effects(_settled(df, cols), cols, "presence")


@register("effects_log", _effects_sql("\\_log10", "log10_abundance"))
def q_effects_log(spark, sf):
    """log10 features: class means, difference, rank-sum p."""
    df = _binary(spark, sf)
    cols = ss.feature_groups(df.columns)["panel_log"]
    return ss.univariate_effects(_settled(df, cols), cols, "log10_abundance")


@register("top_effects", "SELECT * FROM (" + _effects_sql("\\_log10", "log10_abundance")
          + ") x ORDER BY round(abs_diff, 12) DESC, p_value ASC NULLS LAST, feature LIMIT 15")
def q_top_effects(spark, sf):
    """15 largest log effects (abs diff desc, p asc, name)."""
    df = _binary(spark, sf)
    cols = ss.feature_groups(df.columns)["panel_log"]
    eff = ss.univariate_effects(_settled(df, cols), cols, "log10_abundance")
    return ss.top_effects(eff, 15)


@register("direction_table", "SELECT feature, healthy_mean, cancer_mean, mean_diff, abs_diff, p_value FROM ("
          + _effects_sql("\\_log10", "log10_abundance")
          + ") x ORDER BY round(abs_diff, 12) DESC, p_value ASC NULLS LAST, feature LIMIT 20")
def q_direction_table(spark, sf):
    """Means, difference and p of the 20 largest log effects (presence effects where there are none)."""
    df = _binary(spark, sf)
    groups = ss.feature_groups(df.columns)
    df = _settled(df, groups["panel_log"] + groups["panel_present"])
    return ss.direction_table(ss.univariate_effects(df, groups["panel_log"], "log10_abundance"),
                              ss.univariate_effects(df, groups["panel_present"], "presence"))


@register("least_varying", sql(["blong"], """
SELECT feature, count_if(value IS NULL) AS missing, count(DISTINCT round(value, 9)) AS n_unique,
       round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std FROM blong GROUP BY feature
ORDER BY n_unique, feature LIMIT 20"""))
def q_least_varying(spark, sf):
    """The 20 features with the fewest distinct values."""
    df = _binary(spark, sf)
    cols = ss.feature_groups(df.columns)["all"]
    return ss.least_varying(ss.feature_sanity(_settled(ss.coerce_numeric(df, cols), cols), cols))


add_cte("auc_cnt", ("scores",), """
SELECT score, count_if(y = 1)::DOUBLE AS n1, count_if(y = 0)::DOUBLE AS n0 FROM scores GROUP BY score""")


@register("roc_auc", sql(["auc_cnt"], """
, rk AS (SELECT *, n0 + n1 AS t, sum(n0 + n1) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM auc_cnt)
SELECT round((sum(n1 * (cum - t + (t + 1) / 2)) - sum(n1) * (sum(n1) + 1) / 2) / (sum(n0) * sum(n1)), 6) AS auc,
       CAST(sum(n1) AS BIGINT) AS n_pos, CAST(sum(n0) AS BIGINT) AS n_neg FROM rk""").replace("\n, rk AS", ",\nrk AS", 1))
def q_roc_auc(spark, sf):
    """M2: pooled ROC AUC of event scores, ties counted half."""
    return ss.roc_auc(tb.scores(spark, sf))


@register("roc_curve", sql(["auc_cnt"], """
, c AS (SELECT score, n1 AS dtp, n0 AS dfp,
        sum(n1) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
        sum(n0) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
        row_number() OVER (ORDER BY score DESC) AS idx,
        lead(n1) OVER (ORDER BY score DESC) AS ntp, lead(n0) OVER (ORDER BY score DESC) AS nfp FROM auc_cnt),
tot AS (SELECT sum(n1) AS P, sum(n0) AS N, count(*) AS K FROM auc_cnt)
SELECT 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr, NULL::DOUBLE AS threshold, CAST(0 AS BIGINT) AS idx
UNION ALL
SELECT round(fp / N, 6), round(tp / P, 6), round(score, 6), CAST(idx AS BIGINT) FROM c, tot
WHERE idx = 1 OR idx = K OR ntp IS NULL OR ntp <> dtp OR nfp <> dfp""").replace("\n, c AS", ",\nc AS", 1))
def q_roc_curve(spark, sf):
    """ROC points at distinct thresholds, intermediate points dropped."""
    return ss.roc_curve(tb.scores(spark, sf))


@register("confusion", sql(["scores"], """
SELECT c.y_true, c.y_pred, CAST(coalesce(n.cnt, 0) AS BIGINT) AS count
FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) c(y_true, y_pred)
LEFT JOIN (SELECT y AS y_true, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS y_pred, count(*) AS cnt
           FROM scores GROUP BY ALL) n USING (y_true, y_pred)"""))
def q_confusion(spark, sf):
    """Confusion matrix of event scores at 0.5 (inclusive)."""
    return ss.confusion(tb.scores(spark, sf))


@register("class_report", sql(["scores"], """
, m AS (SELECT count_if(y = 0 AND score < 0.5)::DOUBLE AS c00, count_if(y = 0 AND score >= 0.5)::DOUBLE AS c01,
               count_if(y = 1 AND score < 0.5)::DOUBLE AS c10, count_if(y = 1 AND score >= 0.5)::DOUBLE AS c11 FROM scores),
k AS (SELECT 'healthy' AS class, c00 AS tp, c10 AS fp, c01 AS fn, c00 + c01 AS sup, c00 + c01 + c10 + c11 AS tot FROM m
      UNION ALL SELECT 'cancer', c11, c01, c10, c10 + c11, c00 + c01 + c10 + c11 FROM m),
p AS (SELECT class, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS pr,
             CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS rc, sup, tot FROM k),
f AS (SELECT *, CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END AS f1 FROM p)
SELECT class, round(pr, 6) AS precision, round(rc, 6) AS recall, round(f1, 6) AS f1, CAST(sup AS BIGINT) AS support FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round((c00 + c11) / (c00 + c01 + c10 + c11), 6), CAST(c00 + c01 + c10 + c11 AS BIGINT) FROM m
UNION ALL SELECT 'macro avg', round(avg(pr), 6), round(avg(rc), 6), round(avg(f1), 6), CAST(max(tot) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round(sum(pr * sup) / max(tot), 6), round(sum(rc * sup) / max(tot), 6),
                 round(sum(f1 * sup) / max(tot), 6), CAST(max(tot) AS BIGINT) FROM f""").replace("\n, m AS", ",\nm AS", 1))
def q_class_report(spark, sf):
    """precision/recall/F1/support per class, accuracy, macro/weighted."""
    return ss.class_report(tb.scores(spark, sf))
