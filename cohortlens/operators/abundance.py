"""Abundance tables: long form, human-taxon exclusion, scores, matrix, fallback."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions.columns import first_token, level_suffix, normalize_taxon, trim_ws
from cohortlens.operators.prefix import prefix_sum
from cohortlens.operators.salted import salted_join

LONG_SCHEMA = "run_accession string, sample_id string, level string, taxon string, relative_abundance double"
REPORT_SCHEMA = ("run_accession string, percentage double, clade_reads bigint, "
                 "taxon_reads bigint, rank_code string, taxid bigint, name string")
# Above this many distinct taxa the matrix stays long (Spark's pivot limit).
BLOCK_COLUMNS = 2000
#: Rows of the long table whose samples one task turns into matrix rows, about.
ROWS_PER_TASK = 500_000


def empty_long(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LONG_SCHEMA)


def _to_long(df: DataFrame | None, level: str) -> DataFrame | None:
    if df is None:
        return None
    renamed = df.withColumnsRenamed({"name": "taxon", "fraction_total_reads": "relative_abundance"})
    return renamed.select("run_accession", "sample_id", F.lit(level).alias("level"),
                          F.col("taxon").cast("string").alias("taxon"),
                          F.col("relative_abundance").cast("double").alias("relative_abundance"))


def abundance_long(species: DataFrame | None, genus: DataFrame | None,
                   spark: SparkSession | None = None) -> DataFrame:
    """Species and genus tables -> one long table tagged by ``level``.

    A missing table is an empty typed table (never a one-newline file)."""
    parts = [p for p in (_to_long(species, "species"), _to_long(genus, "genus")) if p is not None]
    if not parts:
        return empty_long(spark)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def exclude_taxa(df: DataFrame, names: Sequence[str], col: str = "taxon") -> DataFrame:
    """Drop rows whose normalised taxon name is in ``names`` (normalised too).

    The set is configuration-sized, so it is an in-expression hash set, not a
    join."""
    norm = sorted({" ".join(str(n).strip().lower().replace("_", " ").split()) for n in names})
    if not norm:
        return df
    return df.filter(~F.coalesce(normalize_taxon(F.col(col)).isin(norm), F.lit(False)))


def is_excluded(taxon: str, names: Sequence[str]) -> bool:
    norm = {" ".join(str(n).strip().lower().replace("_", " ").split()) for n in names}
    return " ".join(str(taxon).strip().lower().replace("_", " ").split()) in norm


def run_taxon_sum(long: DataFrame) -> DataFrame:
    """Per (run, level, taxon) sum: duplicates inside a run are added."""
    return (long.groupBy("run_accession", "level", "taxon")
                .agg(F.sum(F.coalesce("relative_abundance", F.lit(0.0))).alias("relative_abundance")))


def genus_fallback(long: DataFrame) -> DataFrame:
    """Genus rows for runs that have species rows and no genus rows.

    genus = first whitespace token of the species name, summed per
    (run, sample, genus)."""
    genus_runs = long.filter(F.col("level") == "genus").select("run_accession").distinct()
    species = long.filter(F.col("level") == "species")
    orphan = species.join(genus_runs, "run_accession", "left_anti")
    return (orphan.groupBy("run_accession", "sample_id", first_token(F.col("taxon")).alias("taxon"))
                  .agg(F.sum(F.coalesce("relative_abundance", F.lit(0.0))).alias("relative_abundance"))
                  .select("run_accession", "sample_id", F.lit("genus").alias("level"),
                          "taxon", "relative_abundance"))


def score_taxa(long: DataFrame, metric: str = "mean_x_prevalence") -> DataFrame:
    """Per (level, taxon): mean, prevalence (share of rows > 0) and score.

    Over the taxon's own rows only, as in the reference (absent runs are not
    zeros)."""
    x = F.col("relative_abundance")
    agg = long.groupBy("level", "taxon").agg(
        F.avg(x).alias("mean_abundance"),
        F.avg(F.when(x > 0, 1.0).otherwise(0.0)).alias("prevalence"))
    if metric == "mean_abundance":
        score = F.col("mean_abundance")
    elif metric == "prevalence":
        score = F.col("prevalence")
    else:
        score = F.col("mean_abundance") * F.col("prevalence")
    return agg.withColumn("score", score)


def matrix_taxa(long: DataFrame) -> list[str]:
    """Sorted distinct taxa: the header of the wide matrix."""
    return [r[0] for r in long.select("taxon").distinct().orderBy("taxon").collect()]


def abundance_matrix(long: DataFrame, taxa: Sequence[str] | None = None) -> DataFrame:
    """sample x taxon matrix, values summed over runs and levels, 0 fill.

    Rows come from the abundance table (not the metadata).  The header is
    part of the schema; for vocabularies too wide for one schema see
    ``matrix_blocks`` and ``abundance_matrix_long``.

    The summed cells are dealt by sample into tasks of a bounded number, so
    what a task holds while it turns them does not grow with the table."""
    if taxa is None:
        taxa = matrix_taxa(long)
    tasks = max(long.sparkSession.sparkContext.defaultParallelism, -(-long.count() // ROWS_PER_TASK))
    cells = abundance_matrix_long(long).repartition(tasks, "sample_id")
    wide = cells.groupBy("sample_id").pivot("taxon", list(taxa)).agg(F.first("value"))
    return wide.na.fill(0.0, subset=list(taxa)) if taxa else wide


def matrix_blocks(long: DataFrame, taxa: Sequence[str] | None = None, width: int = BLOCK_COLUMNS):
    """The wide matrix as (taxa, frame) blocks of at most ``width`` columns, all taxa covered.

    Every block has a row for each sample; blocks join on ``sample_id``."""
    taxa = matrix_taxa(long) if taxa is None else list(taxa)
    for k in range(0, len(taxa), width):
        yield taxa[k:k + width], abundance_matrix(long, taxa[k:k + width])


def abundance_matrix_long(long: DataFrame) -> DataFrame:
    """Sparse (sample, taxon, value) form of the matrix for very many taxa."""
    return (long.groupBy("sample_id", "taxon")
                .agg(F.sum(F.coalesce("relative_abundance", F.lit(0.0))).alias("value")))


def parse_reports(reports: DataFrame) -> DataFrame:
    """Taxonomy report rows with stripped names (the run is already a column)."""
    return reports.withColumn("name", trim_ws(F.col("name")))


def abundance_by_rank(reports: DataFrame, md: DataFrame | None = None) -> DataFrame:
    """Species (S) and genus (G) rows of the reports; exact rank codes only."""
    r = parse_reports(reports).filter(F.col("rank_code").isin("S", "G"))
    out = r.select("run_accession", "name", "percentage", "rank_code",
                   F.when(F.col("rank_code") == "S", "species").otherwise("genus").alias("level"))
    if md is not None:
        out = salted_join(out, md.select("run_accession", "sample_id"), "run_accession", "left")
    return out


def combine_abundance(tables: DataFrame, md: DataFrame, level: str = "S") -> DataFrame:
    """Per-run abundance rows of metadata runs, with run and sample prepended
    and the level's file suffix as a column."""
    joined = salted_join(tables, md.select("run_accession", "sample_id"), "run_accession")
    rest = [c for c in tables.columns if c != "run_accession"]
    return joined.select("run_accession", "sample_id", *rest,
                         level_suffix(F.lit(level)).alias("level_suffix"))


def taxon_numbers(long: DataFrame) -> DataFrame:
    """A dense number from 0 for every taxon, in the order of the names' bytes; any number of taxa."""
    taxa = long.select("taxon").where("taxon is not null").distinct().withColumn("one", F.lit(1))
    # The first six bytes as a number never fall along the order.
    head = F.conv(F.substring(F.rpad(F.hex(F.encode("taxon", "UTF-8")), 12, "0"), 1, 12), 16, 10).cast("bigint")
    return prefix_sum(taxa, ["taxon"], ["one"], measure=head).select("taxon", (F.col("one_cum") - 1).cast("int").alias("number"))


def abundance_vectors(long: DataFrame) -> DataFrame:
    """A1 in sparse form: per sample the ascending numbers of its taxa and their summed abundances.

    The header stays a table (``taxon_numbers``); nothing of it comes to the driver."""
    sums = long.where("taxon is not null").groupBy("sample_id", "taxon").agg(
        F.sum(F.coalesce("relative_abundance", F.lit(0.0))).alias("value"))
    numbers = taxon_numbers(long).withColumnRenamed("taxon", "t")
    held = sums.join(numbers, F.col("taxon") == F.col("t")).groupBy("sample_id").agg(
        F.sort_array(F.collect_list(F.struct("number", "value"))).alias("held"))
    return held.select("sample_id", F.col("held.number").alias("indices"), F.col("held.value").alias("values"))
