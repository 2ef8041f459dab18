"""Queries through files: bound tables are written to the shared folder, read back by the readers and compared."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cohortlens.operators import abundance as ab
from cohortlens.operators import stats as ss
from cohortlens.operators.metadata import clean_metadata
from cohortlens.plans.catalog import register
from cohortlens.plans.oracle import sql
from cohortlens.plans.q_features import CORE_ROUNDED, _features
from cohortlens.plans.q_stats import CORE6
from cohortlens.session import checkpoint_dir
from cohortlens.sources import files, sinks
from cohortlens.sources import tables as tb


def _folder(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("metadata_csv", sql(["md"], """
SELECT run_accession, sample_id, label, age_group, library_name FROM md"""))
def q_metadata_csv(spark, sf):
    """Cohort metadata through CSV files, read by a glob and cleaned."""
    path = _folder(spark, "metadata")
    sinks.write_table(tb.metadata(spark, sf).drop("ordinal"), path, "csv")
    md = clean_metadata(files.read_metadata(spark, f"{path}/*.csv"))
    return md.select("run_accession", "sample_id", "label", "age_group", "library_name")


@register("abundance_csv", sql(["long"], """
SELECT run_accession, sample_id, level, taxon, round(relative_abundance, 6) AS relative_abundance FROM long"""))
def q_abundance_csv(spark, sf):
    """Combined species and genus CSVs through files."""
    path = _folder(spark, "abundance")
    for level, df in (("species", tb.species_abundance(spark, sf)), ("genus", tb.genus_abundance(spark, sf))):
        zero = F.lit(0).cast("bigint")
        sinks.write_table(df.select(
            "run_accession", "sample_id", "name", zero.alias("taxonomy_id"), F.lit(level[0].upper()).alias("taxonomy_lvl"),
            zero.alias("kraken_assigned_reads"), zero.alias("added_reads"), zero.alias("new_est_reads"),
            "fraction_total_reads"), f"{path}/bracken_abundance_{level}.csv", "csv")
    return ab.exclude_taxa(files.read_abundance_levels(spark, path), tb.binding_config().excluded_taxa)


@register("stage_log_csv", sql(["stage_log"], """
SELECT run_accession, status, original_reads, subsampled_reads FROM stage_log WHERE stage = 'subsample'"""))
def q_stage_log_csv(spark, sf):
    """A stage's log through CSV files."""
    path = _folder(spark, "stage-log-csv")
    log = tb.stage_log(spark, sf).filter(F.col("stage") == "subsample").select(
        "run_accession", "status", "original_reads", "subsampled_reads", F.lit(0.1).alias("fraction"))
    sinks.write_table(log, path, "csv")
    return files.read_stage_log(spark, path, "subsample").select(
        "run_accession", "status", "original_reads", "subsampled_reads")


@register("feature_csv", sql(["core"], f"""
SELECT * REPLACE ({", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in CORE6)}) FROM (SELECT {CORE_ROUNDED} FROM core)"""))
def q_feature_csv(spark, sf):
    """The feature matrix as a cohort's CSV output, read back and coerced."""
    path = _folder(spark, "features")
    sinks.write_cohort_outputs({"targeted_features": _features(spark, sf, top_n=0).targeted}, path, "bound", "csv")
    back = files.read_feature_matrix(spark, f"{path}/targeted_features/cohort=bound")
    return ss.coerce_numeric(back, CORE6).select("sample_id", "run_accession", "label", "age_group", "library_name", *CORE6)
