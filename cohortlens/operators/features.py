"""Per-run features from long abundance, taxonomy reports and QC reports.

All per-run quantities come out of one pass over the long abundance table:
sums by (run, name), then one map of values a run.  The genus fallback, panel
lookups with species precedence, detection counts and diversity need no
per-run join and no second pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.functions.columns import (first_token, log10_pseudo, panel_column_name,
                                          presence_flag, trim_ws)

QC_SCHEMA = T.StructType([
    T.StructField("summary", T.StructType([
        T.StructField("before_filtering", T.StructType([
            T.StructField("total_reads", T.StringType())])),
        T.StructField("after_filtering", T.StructType([
            T.StructField("total_reads", T.StringType())])),
    ]))])

CORE_COLUMNS = ("F_nucleatum_species_abundance", "Fusobacterium_genus_abundance",
                "total_bacterial_abundance", "number_of_detected_species",
                "Shannon_diversity", "sequencing_depth_proxy")
ID_COLUMNS = ("sample_id", "run_accession", "label", "age_group", "library_name")

def _is_s() -> Column:
    return F.col("__is_s")


def _is_g() -> Column:
    return F.col("__is_g")


def _val() -> Column:
    return F.col("__v")


def prepare_long(long: DataFrame) -> DataFrame:
    """Per-row helpers computed once (not once per aggregate)."""
    return long.select(
        "run_accession", "taxon", "relative_abundance",
        (F.col("level") == "species").alias("__is_s"),
        (F.col("level") == "genus").alias("__is_g"),
        F.coalesce(F.col("relative_abundance"), F.lit(0.0)).alias("__v"),
        first_token(F.col("taxon")).alias("__tok"))


def shannon_expr() -> Column:
    """-sum(x ln x) over species rows with x > 0; natural log; not renormalised."""
    x = F.col("relative_abundance")
    return F.coalesce(F.lit(0.0) - F.sum(F.when(_is_s() & (x > 0), x * F.ln(x))), F.lit(0.0))


def detected_expr() -> Column:
    """Number of species rows with abundance > 0 (rows, not distinct taxa)."""
    return F.count_if(_is_s() & (F.col("relative_abundance") > 0)).cast("bigint")


def _entries(wanted: Sequence[str]) -> Column:
    """What a row adds to its run's map of values, one entry for each name it counts for.

    Names: ``s:`` species, ``d:`` a species' first word (the genus it stands
    for where a run has no genus rows), ``g:`` genus; only those of ``wanted``
    taxa, else null.  The entry with an empty name carries the row's own sums."""
    x = F.col("relative_abundance")
    found = _is_s() & (x > 0)
    own = lambda name, v, n, h, g: F.struct(name.alias("name"), v.alias("v"), n.alias("n"), h.alias("h"), g.alias("g"))
    no, zero = F.lit(False), F.lit(0.0)
    named = lambda test, mark, column: F.when(
        test & F.col(column).isin(list(wanted)), own(F.concat(F.lit(mark), F.col(column)), _val(), F.lit(0), zero, no))
    return F.array(
        own(F.lit(""), zero, F.when(found, 1).otherwise(0), F.when(found, x * F.ln(x)).otherwise(zero), _is_g()),
        named(_is_s(), "s:", "taxon"), named(_is_s(), "d:", "__tok"), named(_is_g(), "g:", "taxon"))


def run_profile(long: DataFrame, panel: Sequence[str], focal_species: str,
                focal_genus: str) -> DataFrame:
    """One row per run with abundance rows: focal values, detected species,
    Shannon and the panel values (species wins by key presence, then genus
    with fallback, else 0).

    Rows are summed by (run, name) first, a plain aggregate of any number of
    taxa; the sums of a run, as many as the panel names, become one map, and
    every value is a lookup in it."""
    wanted = sorted({*panel, focal_species, focal_genus})
    entries = prepare_long(long).select("run_accession", F.inline(_entries(wanted))).where("name is not null")
    sums = entries.groupBy("run_accession", "name").agg(
        F.sum("v").alias("v"), F.sum("n").alias("n"), F.sum("h").alias("h"), F.max("g").alias("g"))
    runs = sums.groupBy("run_accession").agg(
        F.sum("n").cast("bigint").alias("number_of_detected_species"), (F.lit(0.0) - F.sum("h")).alias("Shannon_diversity"),
        F.max("g").alias("__genus"),
        F.map_from_entries(F.collect_list(F.when(F.col("name") != "", F.struct("name", "v")))).alias("__values"))
    value = lambda mark, taxon: F.try_element_at("__values", F.lit(mark + taxon))
    genus = lambda taxon: F.when(F.col("__genus"), value("g:", taxon)).otherwise(value("d:", taxon))
    return runs.select(
        "run_accession", F.coalesce(value("s:", focal_species), F.lit(0.0)).alias("F_nucleatum_species_abundance"),
        F.coalesce(genus(focal_genus), F.lit(0.0)).alias("Fusobacterium_genus_abundance"),
        "number_of_detected_species", "Shannon_diversity",
        *[F.coalesce(value("s:", t), genus(t), F.lit(0.0)).alias(f"__p{i}") for i, t in enumerate(panel)])


def domain_abundance(reports: DataFrame, domain: str) -> DataFrame:
    """max(percentage/100) over report rows named ``domain``, per run."""
    hit = trim_ws(F.col("name")) == domain
    return (reports.groupBy("run_accession")
                   .agg(F.max(F.when(hit, F.col("percentage") / 100.0))
                        .alias("total_bacterial_abundance")))


def qc_parse(docs: DataFrame) -> DataFrame:
    """JSON documents -> before/after read totals; NULL when absent/malformed."""
    parsed = docs.withColumn("__j", F.from_json(F.col("json"), QC_SCHEMA))
    return parsed.select(
        "run_accession",
        F.col("__j.summary.before_filtering.total_reads").try_cast("bigint")
         .alias("total_reads_before"),
        F.col("__j.summary.after_filtering.total_reads").try_cast("bigint")
         .alias("total_reads_after"))


def depth_proxy(docs: DataFrame) -> DataFrame:
    """After-filter reads per run; anything missing or wrong -> 0."""
    q = qc_parse(docs)
    return (q.groupBy("run_accession")
             .agg(F.coalesce(F.max("total_reads_after"), F.lit(0)).cast("bigint")
                  .alias("sequencing_depth_proxy")))


def targeted_features(md: DataFrame, long: DataFrame, reports: DataFrame | None,
                      qc_docs: DataFrame | None, panel: Sequence[str], focal_species: str,
                      focal_genus: str, domain: str, pseudocount: float,
                      threshold: float) -> DataFrame:
    """Targeted feature matrix: one row per metadata run, fixed column order."""
    prof = run_profile(long, panel, focal_species, focal_genus)
    lib = F.col("library_name") if "library_name" in md.columns else F.lit("")
    base = md.select("sample_id", "run_accession", "label", "age_group",
                     lib.alias("library_name"))
    out = base.join(prof, "run_accession", "left")
    if reports is not None:
        # A run without a row of the domain gets 0 below, with or without other rows.
        hits = reports.filter(F.col("name").contains(domain) & (trim_ws(F.col("name")) == domain))
        out = out.join(domain_abundance(hits, domain), "run_accession", "left")
    else:
        out = out.withColumn("total_bacterial_abundance", F.lit(None).cast("double"))
    if qc_docs is not None:
        out = out.join(depth_proxy(qc_docs), "run_accession", "left")
    else:
        out = out.withColumn("sequencing_depth_proxy", F.lit(None).cast("bigint"))
    cols = [F.col(c) for c in ID_COLUMNS]
    cols += [
        F.coalesce("F_nucleatum_species_abundance", F.lit(0.0)).alias("F_nucleatum_species_abundance"),
        F.coalesce("Fusobacterium_genus_abundance", F.lit(0.0)).alias("Fusobacterium_genus_abundance"),
        F.coalesce("total_bacterial_abundance", F.lit(0.0)).alias("total_bacterial_abundance"),
        F.coalesce("number_of_detected_species", F.lit(0)).cast("bigint").alias("number_of_detected_species"),
        F.coalesce("Shannon_diversity", F.lit(0.0)).alias("Shannon_diversity"),
        F.coalesce("sequencing_depth_proxy", F.lit(0)).cast("bigint").alias("sequencing_depth_proxy"),
    ]
    # Taxa that share a column name: the column keeps the first one's place and
    # holds the last one's value.
    last = {panel_column_name(taxon): i for i, taxon in enumerate(panel)}
    for name in dict.fromkeys(map(panel_column_name, panel)):
        i = last[name]
        v = F.coalesce(F.col(f"__p{i}"), F.lit(0.0))
        cols += [v.alias(name), log10_pseudo(v, pseudocount).alias(f"{name}_log10"),
                 presence_flag(v, threshold).alias(f"{name}_present")]
    return out.select(*cols)


def detection_counts(features: DataFrame) -> DataFrame:
    """Samples detected per panel taxon (sum of each *_present flag), desc."""
    flags = [c for c in features.columns if c.endswith("_present")]
    if not flags:
        return features.sparkSession.createDataFrame([], "feature string, detected bigint")
    sums = features.agg(*[F.sum(F.col(f"`{c}`")).cast("bigint").alias(c) for c in flags])
    long = sums.unpivot([], [F.col(f"`{c}`") for c in flags], "feature", "detected")
    return long.orderBy(F.col("detected").desc(), F.col("feature"))


def focal_histogram(features: DataFrame, col: str = "F_nucleatum_species_abundance",
                    bins: int = 20) -> DataFrame:
    """Equal-width histogram of one column: (bin 1..bins, lower, upper, count).

    Last bin is closed; min == max spreads the range by +-0.5.  The range is
    a one-row aggregate read back as two literals."""
    spark = features.sparkSession
    x = F.col(f"`{col}`")
    row = features.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    if row is None or row["lo"] is None:
        return spark.createDataFrame([], "bin int, lower double, upper double, count bigint")
    lo, hi = float(row["lo"]), float(row["hi"])
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(hi - lo) * F.lit(bins)) + 1, F.lit(bins))
    counts = features.select(b.alias("bin")).groupBy("bin").agg(F.count("*").alias("count"))
    skeleton = spark.range(1, bins + 1).select(F.col("id").alias("bin"))
    width = (hi - lo) / bins
    return (skeleton.join(counts, "bin", "left")
                    .select(F.col("bin").cast("int").alias("bin"),
                            (F.lit(lo) + (F.col("bin") - 1) * F.lit(width)).alias("lower"),
                            (F.lit(lo) + F.col("bin") * F.lit(width)).alias("upper"),
                            F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))
