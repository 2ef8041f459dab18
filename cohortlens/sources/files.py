"""File sources with fixed schemas (CSV, TSV, JSON documents, FASTQ text).

Every scan declares its schema; the run accession comes from the file name
(``_metadata.file_path``) where the reference keys files by run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators.abundance import LONG_SCHEMA, abundance_long
from cohortlens.operators.metadata import REQUIRED_METADATA_COLUMNS, require_columns
from cohortlens.functions.columns import trim_ws

# Column names and types of the tool output formats read here.
REPORT_COLUMNS = "percentage double, clade_reads bigint, taxon_reads bigint, rank_code string, taxid bigint, name string"
ESTIMATE_COLUMNS = ("name string, taxonomy_id bigint, taxonomy_lvl string, kraken_assigned_reads bigint, "
                    "added_reads bigint, new_est_reads bigint, fraction_total_reads double")
STAGE_LOG_SCHEMAS = {
    "download": "run_accession string, status string, message string",
    "subsample": "run_accession string, status string, original_reads bigint, subsampled_reads bigint, fraction double",
    "qc": ("run_accession string, status string, json_report string, html_report string, "
           "total_reads_before bigint, total_reads_after bigint"),
    "kraken": "run_accession string, sample_id string, status string",
    "bracken": "run_accession string, sample_id string, status string",
}


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob names anything but empty files."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(p)
    return found is not None and any(f.isDirectory() or f.getLen() > 0 for f in found)


def _per_run_files(spark: SparkSession, paths, pattern: str):
    """A reader and the paths of per-run files; None when nothing is there.

    One path may be a folder or a glob: the reader lists it and takes the files
    named like ``pattern``.  A list of files goes to the reader as it is."""
    reader = spark.read.option("ignoreMissingFiles", True).option("pathGlobFilter", pattern)
    if isinstance(paths, str):
        return reader, ([paths] if _exists(spark, paths) else None)
    listed = [p for p in paths if _exists(spark, p)]
    return reader, listed or None


def _file_order():
    """Order of rows over several files: file, place in the file.

    Files are packed into partitions by size, so the row id alone is no order."""
    return F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
                    F.monotonically_increasing_id().alias("row"))


def _run_from_file(suffix_regex: str):
    return F.regexp_extract(F.col("_metadata.file_name"), f"^(.*?){suffix_regex}$", 1)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header, every column a string, file order as ``ordinal``.

    Raises FileNotFoundError for a missing file and ValueError naming the
    missing required columns."""
    if not _exists(spark, path):
        raise FileNotFoundError(f"Metadata CSV not found: {path}")
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    require_columns(df, REQUIRED_METADATA_COLUMNS)
    return df.select("*", _file_order().alias("ordinal"))


def read_taxonomy_reports(spark: SparkSession, paths) -> DataFrame:
    """Headerless six-column TSV per run ``{run}.report.tsv``; names
    stripped; empty or missing files contribute nothing."""
    reader, paths = _per_run_files(spark, paths, "*.report.tsv")
    if not paths:
        return spark.createDataFrame([], "run_accession string, " + REPORT_COLUMNS)
    df = reader.schema(REPORT_COLUMNS).option("sep", "\t").option("header", False).csv(paths)
    return df.select(_run_from_file(r"\.report\.tsv").alias("run_accession"),
                     "percentage", "clade_reads", "taxon_reads", "rank_code", "taxid",
                     trim_ws(F.col("name")).alias("name"))


def read_abundance_estimates(spark: SparkSession, paths, level: str = "species") -> DataFrame:
    """S3: per-run estimate TSVs ``{run}.bracken_<level>.tsv`` with header."""
    reader, paths = _per_run_files(spark, paths, f"*.bracken_{level}.tsv")
    if not paths:
        return spark.createDataFrame([], "run_accession string, " + ESTIMATE_COLUMNS)
    df = reader.schema(ESTIMATE_COLUMNS).option("sep", "\t").option("header", True).csv(paths)
    return df.select(_run_from_file(rf"\.bracken_{level}\.tsv").alias("run_accession"), *df.columns)


def read_abundance_levels(spark: SparkSession, directory: str) -> DataFrame:
    """Combined species and genus CSVs -> long table; a missing or
    zero-byte file is an empty table."""
    schema = "run_accession string, sample_id string, " + ESTIMATE_COLUMNS
    out = {}
    for level in ("species", "genus"):
        p = f"{directory}/bracken_abundance_{level}.csv"
        out[level] = (spark.read.schema(schema).option("header", True).csv(p)
                      if _exists(spark, p) else None)
    if out["species"] is None and out["genus"] is None:
        return spark.createDataFrame([], LONG_SCHEMA)
    return abundance_long(out["species"], out["genus"], spark)


def read_qc_documents(spark: SparkSession, paths) -> DataFrame:
    """One JSON document per file ``{run}.fastp.json`` as text; parsing
    (and the malformed -> NULL rule) is ``stages.qc_parse_reports``."""
    reader, paths = _per_run_files(spark, paths, "*.fastp.json")
    if not paths:
        return spark.createDataFrame([], "run_accession string, json string")
    df = reader.text(paths, wholetext=True)
    return df.select(_run_from_file(r"\.fastp\.json").alias("run_accession"),
                     F.col("value").alias("json"))


def read_stage_log(spark: SparkSession, path: str, stage: str) -> DataFrame:
    """A stage's CSV log with its fixed schema; absent -> empty typed."""
    schema = STAGE_LOG_SCHEMAS[stage]
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema).option("header", True).csv(path)
                 .select("*", _file_order().alias("ordinal")))


def read_feature_matrix(spark: SparkSession, path: str) -> DataFrame:
    """Feature matrix CSV (strings; numeric coercion is F7)."""
    df = spark.read.option("header", True).csv(path)
    require_columns(df, ("sample_id", "run_accession", "label"), "Feature matrix")
    return df


def list_files(spark: SparkSession, directory: str, glob: str = "*") -> DataFrame:
    """Distributed file listing (names only; contents are not read)."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
          .option("recursiveFileLookup", True).load(directory))
    return df.select(F.regexp_extract("path", r"[^/]+$", 0).alias("file_name"), "length")
