"""Queries: metadata, abundance, panel and targeted features."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.operators.salted import salted_join
from cohortlens.operators import abundance as ab
from cohortlens.operators import features as fe
from cohortlens.operators import panel as pn
from cohortlens.operators.metadata import clean_metadata, first_runs, subset_runs
from cohortlens.plans.catalog import register
from cohortlens.plans.features import build_features
from cohortlens.functions.columns import panel_column_name
from cohortlens.plans.oracle import (PANEL_CFG_KEPT, add_cte, first_tok, sql, strip)
from cohortlens.sources import tables as tb

TOP_N = 6


def _md(spark, sf):
    return clean_metadata(tb.metadata(spark, sf))


def _long(spark, sf):
    cfg = tb.binding_config()
    return ab.exclude_taxa(ab.abundance_long(tb.species_abundance(spark, sf),
                                             tb.genus_abundance(spark, sf)), cfg.excluded_taxa)


def _reports(spark, sf):
    return ab.parse_reports(tb.taxonomy_reports(spark, sf))


def _features(spark, sf, top_n=TOP_N):
    cfg = tb.binding_config(top_n=top_n)
    return build_features(_md(spark, sf), tb.species_abundance(spark, sf),
                          tb.genus_abundance(spark, sf), _reports(spark, sf),
                          tb.qc_documents(spark, sf), cfg)


# ---- SQL building blocks for the feature oracles ---------------------------
add_cte("ss", ("long",), """
SELECT run_accession, taxon, sum(coalesce(relative_abundance, 0.0)) AS v
FROM long WHERE level = 'species' GROUP BY ALL""")
add_cte("hg", ("long",), "SELECT DISTINCT run_accession FROM long WHERE level = 'genus'")
add_cte("fb", ("long", "hg"), f"""
SELECT run_accession, sample_id, 'genus' AS level, {first_tok('taxon')} AS taxon,
       sum(coalesce(relative_abundance, 0.0)) AS relative_abundance
FROM long WHERE level = 'species' AND run_accession NOT IN (SELECT run_accession FROM hg)
GROUP BY ALL""")
add_cte("gmap", ("long", "fb"), """
SELECT run_accession, taxon, sum(coalesce(relative_abundance, 0.0)) AS v
FROM long WHERE level = 'genus' GROUP BY ALL
UNION ALL
SELECT run_accession, taxon, sum(relative_abundance) FROM fb GROUP BY ALL""")
add_cte("tscore", ("long",), """
SELECT level, taxon, avg(relative_abundance) AS mean_abundance,
       avg(CASE WHEN relative_abundance > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS prevalence
FROM long GROUP BY ALL""")
add_cte("picks", ("tscore", "long"), f"""
SELECT level, taxon, 'mean_x_prevalence' AS metric, score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT level, taxon, mean_abundance * prevalence AS score,
         row_number() OVER (PARTITION BY level ORDER BY mean_abundance * prevalence DESC, taxon) AS rank,
         (SELECT count(DISTINCT level) FROM long) AS nlev
  FROM tscore) s
WHERE rank <= CASE WHEN nlev = 2 AND level = 'species' THEN CAST(ceil({TOP_N} / 2) AS BIGINT)
                   WHEN nlev = 2 THEN CAST(floor({TOP_N} / 2) AS BIGINT) ELSE {TOP_N} END""")
_cfg_rows = ", ".join(f"({i}, '{t}')" for i, t in enumerate(PANEL_CFG_KEPT))
add_cte("panel", ("picks",), f"""
SELECT row_number() OVER (ORDER BY pos) AS position, taxon FROM (
  SELECT taxon, min(row(part, place)) AS pos FROM (
    SELECT 0 AS part, pos AS place, taxon FROM (VALUES {_cfg_rows}) c(pos, taxon)
    UNION ALL
    SELECT CASE WHEN level = 'species' THEN 1 ELSE 2 END, rank, taxon FROM picks) u
  GROUP BY taxon) m""")
add_cte("pv", ("md", "panel", "ss", "gmap"), """
SELECT m.run_accession, p.position, p.taxon, 'panel_' || replace(p.taxon, ' ', '_') AS col,
       coalesce(s.v, g.v, 0.0) AS v
FROM md m CROSS JOIN panel p
LEFT JOIN ss s ON s.run_accession = m.run_accession AND s.taxon = p.taxon
LEFT JOIN gmap g ON g.run_accession = m.run_accession AND g.taxon = p.taxon""")
add_cte("prof", ("long", "ss", "gmap"), """
SELECT r.run_accession,
       coalesce((SELECT v FROM ss WHERE ss.run_accession = r.run_accession AND ss.taxon = 'small ring'), 0.0) AS f_nuc,
       coalesce((SELECT v FROM gmap g WHERE g.run_accession = r.run_accession AND g.taxon = 'small'), 0.0) AS fuso,
       r.n_species, r.shannon
FROM (SELECT run_accession,
             count_if(level = 'species' AND relative_abundance > 0) AS n_species,
             coalesce(0.0 - sum(CASE WHEN level = 'species' AND relative_abundance > 0
                                THEN relative_abundance * ln(relative_abundance) END), 0.0) AS shannon
      FROM long GROUP BY run_accession) r""")
add_cte("dom", ("reports",), f"""
SELECT run_accession, max(CASE WHEN {strip('name')} = 'STANDARD' THEN percentage / 100 END) AS tb
FROM reports GROUP BY run_accession""")
add_cte("depth", ("qc_parsed",), """
SELECT run_accession, coalesce(max(total_reads_after), 0) AS d FROM qc_parsed GROUP BY run_accession""")
add_cte("core", ("md", "prof", "dom", "depth"), """
SELECT m.sample_id, m.run_accession, m.label, m.age_group, m.library_name,
       coalesce(p.f_nuc, 0.0) AS F_nucleatum_species_abundance,
       coalesce(p.fuso, 0.0) AS Fusobacterium_genus_abundance,
       coalesce(d.tb, 0.0) AS total_bacterial_abundance,
       CAST(coalesce(p.n_species, 0) AS BIGINT) AS number_of_detected_species,
       coalesce(p.shannon, 0.0) AS Shannon_diversity,
       CAST(coalesce(q.d, 0) AS BIGINT) AS sequencing_depth_proxy
FROM md m LEFT JOIN prof p USING (run_accession) LEFT JOIN dom d USING (run_accession)
LEFT JOIN depth q USING (run_accession)""")
# Wide columns are written out: the configured panel is known beforehand.
def _wide_sql() -> str:
    out = []
    for taxon in PANEL_CFG_KEPT:
        col, value = panel_column_name(taxon), f"max(CASE WHEN taxon = '{taxon}' THEN v END)"
        out += [f'round({value}, 6) AS "{col}"', f'round(log10({value} + 1e-6), 6) AS "{col}_log10"',
                f'CAST(CASE WHEN {value} >= 1e-4 THEN 1 ELSE 0 END AS INTEGER) AS "{col}_present"']
    return ", ".join(out)


# Automatic picks go by their place, so that the columns are the same for all tables.
def _auto_sql() -> str:
    out = []
    for i in range(1, TOP_N + 1):
        value = f"max(CASE WHEN place = {i} THEN v END)"
        out += [f"max(CASE WHEN place = {i} THEN taxon END) AS auto_{i}_taxon", f"round({value}, 6) AS auto_{i}",
                f"round(log10({value} + 1e-6), 6) AS auto_{i}_log10",
                f"CAST(CASE WHEN {value} >= 1e-4 THEN 1 WHEN {value} IS NOT NULL THEN 0 END AS INTEGER) AS auto_{i}_present"]
    return ", ".join(out)


_cfg_list = ", ".join(f"'{t}'" for t in PANEL_CFG_KEPT)
add_cte("auto_panel", ("panel",), f"""
SELECT taxon, row_number() OVER (ORDER BY position) AS place FROM panel WHERE taxon NOT IN ({_cfg_list})""")
add_cte("features", ("core", "pv", "auto_panel"), f"""
SELECT c.*, w.* EXCLUDE (run_accession), u.* EXCLUDE (run_accession)
FROM core c JOIN (SELECT run_accession, {_wide_sql()} FROM pv GROUP BY run_accession) w USING (run_accession)
LEFT JOIN (SELECT run_accession, {_auto_sql()} FROM pv JOIN auto_panel USING (taxon) GROUP BY run_accession) u USING (run_accession)""")
CORE_ROUNDED = """sample_id, run_accession, label, age_group, library_name,
  round(F_nucleatum_species_abundance, 6) AS F_nucleatum_species_abundance,
  round(Fusobacterium_genus_abundance, 6) AS Fusobacterium_genus_abundance,
  round(total_bacterial_abundance, 6) AS total_bacterial_abundance,
  number_of_detected_species, round(Shannon_diversity, 6) AS Shannon_diversity,
  sequencing_depth_proxy"""


# ---- metadata ---------------------------------------------------------------
@register("metadata_clean", sql(["md_clean"], "SELECT * FROM md_clean"))
def q_metadata_clean(spark, sf):
    """Trim, lower, drop incomplete, first row per run (dirty input)."""
    md = clean_metadata(tb.dirty_metadata(spark, sf))
    return md.select("run_accession", "sample_id", "label", "age_group", "library_name", "ordinal")


@register("metadata_subset", sql(["md", "stage_log"], """
SELECT run_accession, sample_id, label, age_group, library_name FROM md
WHERE run_accession IN (SELECT run_accession FROM stage_log)"""))
def q_metadata_subset(spark, sf):
    """keep the runs named by another table (here: runs with a stage log)."""
    runs = tb.stage_log(spark, sf).select("run_accession")
    md = subset_runs(_md(spark, sf), runs)
    return md.select("run_accession", "sample_id", "label", "age_group", "library_name")


@register("first_runs", sql(["md"], """
SELECT run_accession, sample_id, ordinal FROM md ORDER BY ordinal LIMIT 100"""))
def q_first_runs(spark, sf):
    """the first 100 runs in file order (the limit is the operator)."""
    return first_runs(_md(spark, sf), 100).select("run_accession", "sample_id", "ordinal")


# ---- abundance --------------------------------------------------------------
@register("abundance_long", sql(["long"], """
SELECT run_accession, sample_id, level, taxon, round(relative_abundance, 6) AS relative_abundance
FROM long"""))
def q_abundance_long(spark, sf):
    """Species + genus tables, renamed, tagged, human taxa removed."""
    return _long(spark, sf)


@register("run_taxon_sum", sql(["long"], """
SELECT run_accession, level, taxon, round(sum(coalesce(relative_abundance, 0.0)), 6) AS relative_abundance
FROM long GROUP BY ALL"""))
def q_run_taxon_sum(spark, sf):
    """A3: duplicates inside a run summed, per level."""
    return ab.run_taxon_sum(_long(spark, sf))


@register("genus_fallback", sql(["fb"], """
SELECT run_accession, sample_id, level, taxon, round(relative_abundance, 6) AS relative_abundance FROM fb"""))
def q_genus_fallback(spark, sf):
    """A10: genus rows derived from species for runs without genus rows."""
    return ab.genus_fallback(_long(spark, sf))


for _metric, _expr in (("mean", "mean_abundance"), ("prevalence", "prevalence"),
                       ("product", "mean_abundance * prevalence")):
    def _mk(metric_key, metric_name):
        def q(spark, sf):
            return ab.score_taxa(_long(spark, sf), metric_name)
        q.__doc__ = f"A2: taxon score ({metric_name}) over each taxon's own rows."
        return q
    _names = {"mean": "mean_abundance", "prevalence": "prevalence", "product": "mean_x_prevalence"}
    register(f"taxon_score_{_metric}", sql(["tscore"], f"""
SELECT level, taxon, round(mean_abundance, 6) AS mean_abundance, round(prevalence, 6) AS prevalence,
       round({_expr}, 6) AS score FROM tscore"""))(_mk(_metric, _names[_metric]))


@register("auto_panel", sql(["picks"], """
SELECT level, taxon, metric, round(score, 6) AS score, rank FROM picks"""))
def q_auto_panel(spark, sf):
    """Top-6 split 3/3 across levels, ranked by score desc, taxon asc."""
    return pn.auto_panel(_long(spark, sf), TOP_N, "both", "mean_x_prevalence")


@register("panel_merge", sql(["panel"], "SELECT CAST(position AS INTEGER) AS position, taxon FROM panel"))
def q_panel_merge(spark, sf):
    """Configured taxa, then species picks, then genus picks; first kept."""
    cfg = tb.binding_config(top_n=TOP_N)
    picks = pn.auto_panel(_long(spark, sf), TOP_N, "both", cfg.auto_panel_metric)
    return (pn.merge_panel(spark, cfg.panel_taxa, picks, cfg.excluded_taxa)
              .select(F.col("position").cast("int").alias("position"), "taxon"))


_TAXA = sorted(a + b for a in tb.TAXON_FIRST for b in ("", *(f" {x}" for x in tb.TAXON_SECOND)))


@register("abundance_matrix", sql(["long"], "SELECT sample_id, " + ", ".join(
    f"""round(coalesce(sum(CASE WHEN taxon = '{t}' THEN relative_abundance END), 0.0), 6) AS "{t}\"""" for t in _TAXA)
    + " FROM long GROUP BY sample_id"))
def q_abundance_matrix(spark, sf):
    """A1: sample x taxon, summed over runs and both levels, zero-filled (taxa of the tables' vocabulary)."""
    return ab.abundance_matrix(_long(spark, sf), _TAXA)


@register("abundance_sparse", sql(["long"], """
, numbers AS (SELECT taxon, row_number() OVER (ORDER BY taxon) - 1 AS number FROM (SELECT DISTINCT taxon FROM long) t),
sums AS (SELECT sample_id, taxon, sum(coalesce(relative_abundance, 0.0)) AS v FROM long GROUP BY ALL)
SELECT sample_id, string_agg(number, ',' ORDER BY number) AS indices, round(sum(v), 6) AS total,
       round(max(v), 6) AS largest FROM sums JOIN numbers USING (taxon) GROUP BY sample_id""").replace("\n, numbers AS", ",\nnumbers AS", 1))
def q_abundance_sparse(spark, sf):
    """A1: sample vectors over densely numbered taxa, without a header on the driver."""
    v = ab.abundance_vectors(_long(spark, sf))
    return v.select("sample_id", F.array_join(F.transform("indices", lambda i: i.cast("string")), ",").alias("indices"),
                    F.aggregate("values", F.lit(0.0), lambda a, b: a + b).alias("total"), F.array_max("values").alias("largest"))


@register("diversity", sql(["long"], """
SELECT run_accession, round(coalesce(0.0 - sum(CASE WHEN level = 'species' AND relative_abundance > 0
       THEN relative_abundance * ln(relative_abundance) END), 0.0), 6) AS Shannon_diversity
FROM long GROUP BY run_accession"""))
def q_diversity(spark, sf):
    """A5: Shannon diversity per run with abundance rows."""
    return fe.prepare_long(_long(spark, sf)).groupBy("run_accession").agg(fe.shannon_expr().alias("Shannon_diversity"))


@register("detected_species", sql(["long"], """
SELECT run_accession, count_if(level = 'species' AND relative_abundance > 0) AS number_of_detected_species
FROM long GROUP BY run_accession"""))
def q_detected(spark, sf):
    """A4: species rows with abundance > 0 per run."""
    return (fe.prepare_long(_long(spark, sf)).groupBy("run_accession")
            .agg(fe.detected_expr().alias("number_of_detected_species")))


@register("domain_abundance", sql(["dom"], """
SELECT run_accession, round(coalesce(tb, 0.0), 6) AS total_bacterial_abundance FROM dom"""))
def q_domain(spark, sf):
    """Domain share per run from the taxonomy reports; none -> 0."""
    d = fe.domain_abundance(_reports(spark, sf), tb.BINDING_DOMAIN)
    return d.select("run_accession", F.coalesce("total_bacterial_abundance", F.lit(0.0))
                    .alias("total_bacterial_abundance"))


@register("depth_proxy", sql(["depth"], """
SELECT run_accession, CAST(d AS BIGINT) AS sequencing_depth_proxy FROM depth"""))
def q_depth(spark, sf):
    """After-filter reads from nested QC JSON; missing/malformed -> 0."""
    return fe.depth_proxy(tb.qc_documents(spark, sf))


@register("targeted_features", sql(["features"], f"SELECT {CORE_ROUNDED}, * EXCLUDE (sample_id, run_accession, label, age_group, library_name, F_nucleatum_species_abundance, Fusobacterium_genus_abundance, total_bacterial_abundance, number_of_detected_species, Shannon_diversity, sequencing_depth_proxy) FROM features"))
def q_targeted(spark, sf):
    """C1 (flagship): targeted feature matrix of the configured panel and, by place, of all automatic picks."""
    out = _features(spark, sf)
    auto = [t for t in out.panel if t not in PANEL_CFG_KEPT]
    cols = [F.col(f"`{c}`") for c in out.targeted.columns if not c.startswith("panel_")]
    cols += [F.col(f"`{panel_column_name(t)}{end}`") for t in PANEL_CFG_KEPT for end in ("", "_log10", "_present")]
    for i in range(TOP_N):
        name = panel_column_name(auto[i]) if i < len(auto) else None
        for end, kind in (("", "double"), ("_log10", "double"), ("_present", "int")):
            cols.append((F.col(f"`{name}{end}`") if name else F.lit(None)).cast(kind).alias(f"auto_{i + 1}{end}"))
        cols.append(F.lit(auto[i] if name else None).cast("string").alias(f"auto_{i + 1}_taxon"))
    return out.targeted.select(*cols)


@register("panel_values", sql(["pv"], """
SELECT run_accession, taxon, round(v, 6) AS value, round(log10(v + 1e-6), 6) AS value_log10,
       CAST(CASE WHEN v >= 1e-4 THEN 1 ELSE 0 END AS INTEGER) AS present FROM pv"""))
def q_panel_values(spark, sf):
    """Panel values in long form (species, else genus, else 0)."""
    out = _features(spark, sf)
    from cohortlens.functions.columns import panel_column_name
    t = out.targeted
    items = []
    for taxon in out.panel:
        c = panel_column_name(taxon)
        items.append(F.struct(F.lit(taxon).alias("taxon"), F.col(f"`{c}`").alias("value"),
                              F.col(f"`{c}_log10`").alias("value_log10"),
                              F.col(f"`{c}_present`").alias("present")))
    return t.select("run_accession", F.inline(F.array(*items)))


@register("detection_counts", sql(["pv"], """
SELECT col || '_present' AS feature, CAST(sum(CASE WHEN v >= 1e-4 THEN 1 ELSE 0 END) AS BIGINT) AS detected
FROM pv GROUP BY col"""))
def q_detection_counts(spark, sf):
    """Detected samples per panel taxon, descending."""
    return fe.detection_counts(_features(spark, sf).targeted)


@register("focal_histogram", sql(["core"], """
SELECT CAST(b.bin AS INTEGER) AS bin, round(r.lo + (b.bin - 1) * ((r.hi - r.lo) / 20), 6) AS lower,
       round(r.lo + b.bin * ((r.hi - r.lo) / 20), 6) AS upper, CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM range(1, 21) b(bin)
CROSS JOIN (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
                   CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi
            FROM (SELECT F_nucleatum_species_abundance AS x FROM core) t) r
LEFT JOIN (SELECT bin, count(*) AS n FROM (
    SELECT CAST(least(floor((x - lo) / (hi - lo) * 20) + 1, 20) AS BIGINT) AS bin
    FROM (SELECT F_nucleatum_species_abundance AS x FROM core) t,
         (SELECT CASE WHEN min(F_nucleatum_species_abundance) = max(F_nucleatum_species_abundance)
                      THEN min(F_nucleatum_species_abundance) - 0.5 ELSE min(F_nucleatum_species_abundance) END AS lo,
                 CASE WHEN min(F_nucleatum_species_abundance) = max(F_nucleatum_species_abundance)
                      THEN max(F_nucleatum_species_abundance) + 0.5 ELSE max(F_nucleatum_species_abundance) END AS hi
          FROM core) rr) u GROUP BY bin) c ON c.bin = b.bin"""))
def q_focal_histogram(spark, sf):
    """20 equal-width bins of the focal species abundance."""
    return fe.focal_histogram(_features(spark, sf, top_n=0).targeted)


# ---- reports and per-run abundance files ------------------------------------
@register("report_parse", sql(["reports", "md"], f"""
SELECT r.run_accession, m.sample_id, round(percentage, 6) AS percentage, clade_reads, taxon_reads,
       rank_code, taxid, {strip('name')} AS name
FROM reports r LEFT JOIN md m USING (run_accession)"""))
def q_report_parse(spark, sf):
    """Six typed columns, names stripped, sample attached from metadata."""
    r = _reports(spark, sf)
    md = _md(spark, sf).select("run_accession", "sample_id")
    return salted_join(r, md, "run_accession", "left").select(
        "run_accession", "sample_id", "percentage", "clade_reads", "taxon_reads", "rank_code",
        "taxid", "name")


@register("report_by_rank", sql(["reports", "md"], f"""
SELECT r.run_accession, {strip('name')} AS name, round(percentage, 6) AS percentage, rank_code,
       CASE WHEN rank_code = 'S' THEN 'species' ELSE 'genus' END AS level, m.sample_id
FROM reports r LEFT JOIN md m USING (run_accession) WHERE rank_code IN ('S', 'G')"""))
def q_report_by_rank(spark, sf):
    """Species and genus rows of all reports, exact rank codes."""
    return ab.abundance_by_rank(tb.taxonomy_reports(spark, sf), _md(spark, sf))


@register("abundance_combine", sql(["sp", "md"], """
SELECT s.run_accession, m.sample_id, name, taxid AS taxonomy_id, 'S' AS taxonomy_lvl,
       CAST(q AS BIGINT) AS kraken_assigned_reads, CAST(0 AS BIGINT) AS added_reads,
       CAST(q AS BIGINT) AS new_est_reads, round(fraction_total_reads, 6) AS fraction_total_reads,
       '_species' AS level_suffix
FROM sp s JOIN md m USING (run_accession)"""))
def q_abundance_combine(spark, sf):
    """Per-run estimate rows of metadata runs, run+sample prepended."""
    return ab.combine_abundance(tb.bracken_tables(spark, sf), _md(spark, sf), "S")
