"""Stage accounting: failures, skip-existing, read-file layout, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.operators.features import QC_SCHEMA
from cohortlens.operators.metadata import first_per_key

# Status vocabulary of the stage logs and the read-file name pattern.
DONE_STATUSES = ("downloaded", "subsampled", "qc_done", "kraken_done", "bracken_done",
                 "skipped_existing")
FASTQ_NAME = r"^(.+?)(?:_([12]))?\.fastq(\.gz)?$"


def stage_failures(log: DataFrame) -> DataFrame:
    """Rows whose status is 'failed' or starts with 'failed: '; message split off."""
    st = F.col("status")
    failed = (st == "failed") | st.startswith("failed: ")
    return log.filter(failed).withColumn(
        "message", F.regexp_extract(st, r"^failed(?:: (.*))?$", 1))


def completed_runs(log: DataFrame, stage: str | None = None) -> DataFrame:
    lg = log if stage is None else log.filter(F.col("stage") == stage)
    return lg.filter(F.col("status").isin(*DONE_STATUSES)).select("run_accession").distinct()


def _with_output(done: DataFrame, outputs: DataFrame | None) -> DataFrame:
    """Completed runs whose output (run_accession, length) is there and not empty, if outputs are given."""
    if outputs is None:
        return done
    return done.join(outputs.filter(F.col("length") > 0).select("run_accession").distinct(), "run_accession", "left_semi")


def pending_runs(md: DataFrame, log: DataFrame, stage: str | None = None, outputs: DataFrame | None = None) -> DataFrame:
    """Metadata runs without a completed (or skipped) entry, or with an empty output: still to do."""
    return md.join(_with_output(completed_runs(log, stage), outputs), "run_accession", "left_anti")


def skipped_runs(md: DataFrame, log: DataFrame, stage: str | None = None, outputs: DataFrame | None = None) -> DataFrame:
    """Metadata runs with a completed entry (and output): logged skipped_existing on rerun."""
    return (md.join(_with_output(completed_runs(log, stage), outputs), "run_accession", "left_semi")
              .withColumn("status", F.lit("skipped_existing")))


def first_log_rows(log: DataFrame, order_cols=("ts", "event_id")) -> DataFrame:
    """First log row of every run (file order = ``order_cols``)."""
    return first_per_key(log, ["run_accession"], list(order_cols))


def parse_file_names(listing: DataFrame) -> DataFrame:
    """file_name -> run, mate (0 = single), gz flag; non-FASTQ names dropped."""
    name = F.col("file_name")
    return (listing.filter(name.rlike(FASTQ_NAME)).select(
        "file_name",
        F.regexp_extract(name, FASTQ_NAME, 1).alias("run_accession"),
        F.coalesce(F.nullif(F.regexp_extract(name, FASTQ_NAME, 2), F.lit("")).cast("int"),
                   F.lit(0)).alias("mate"),
        (F.regexp_extract(name, FASTQ_NAME, 3) != "").alias("gz")))


def resolve_layout(md: DataFrame, listing: DataFrame) -> DataFrame:
    """Per metadata run: plain pair > plain single > gz pair > gz single.

    One grouped pass over the listing; runs without any layout get a
    failed status (the reference raises per run and logs the failure)."""
    f = parse_file_names(listing)

    def pick(mate, gz):
        return F.max(F.when((F.col("mate") == mate) & (F.col("gz") == gz), F.col("file_name")))

    per = f.groupBy("run_accession").agg(
        pick(1, False).alias("p1"), pick(2, False).alias("p2"), pick(0, False).alias("ps"),
        pick(1, True).alias("g1"), pick(2, True).alias("g2"), pick(0, True).alias("gs"))
    plain_pair = F.col("p1").isNotNull() & F.col("p2").isNotNull()
    gz_pair = F.col("g1").isNotNull() & F.col("g2").isNotNull()
    layout = (F.when(plain_pair, "paired").when(F.col("ps").isNotNull(), "single")
              .when(gz_pair, "paired_gz").when(F.col("gs").isNotNull(), "single_gz"))
    r1 = (F.when(plain_pair, F.col("p1")).when(F.col("ps").isNotNull(), F.col("ps"))
          .when(gz_pair, F.col("g1")).when(F.col("gs").isNotNull(), F.col("gs")))
    r2 = F.when(plain_pair, F.col("p2")).when(F.col("ps").isNotNull(), F.lit(None)).when(gz_pair, F.col("g2"))
    out = md.select("run_accession").join(per, "run_accession", "left")
    return out.select(
        "run_accession", layout.alias("layout"), r1.alias("r1"), r2.cast("string").alias("r2"),
        F.when(layout.isNull(), F.concat(F.lit("failed: No FASTQ files found for "),
                                         F.col("run_accession"))).otherwise("ok").alias("status"))


def raw_exists(md: DataFrame, listing: DataFrame, match: str = "exact") -> DataFrame:
    """Run has raw files?  ``exact``: parsed run id; ``prefix``: the glob
    ``{run}*.fastq*`` (so R1 also matches R10_1.fastq).  Prefix mode is an
    equi-join on every prefix of the name before '.fastq' (bounded fan-out:
    name length), never a theta join."""
    if match == "exact":
        runs = parse_file_names(listing).select("run_accession").distinct()
    else:
        name = F.col("file_name")
        cut = F.locate(".fastq", name)  # first occurrence, 1-based
        last = F.length(name) - F.locate("qtsaf.", F.reverse(name)) - 5  # start of last '.fastq'
        runs = (listing.filter(cut > 0)
                .select(F.explode(F.transform(F.sequence(F.lit(1), last),
                                              lambda i: F.substring(name, 1, i))).alias("run_accession"))
                .distinct())
    flag = runs.withColumn("raw_exists", F.lit(True))
    return (md.select("run_accession").join(flag, "run_accession", "left")
              .select("run_accession", F.coalesce("raw_exists", F.lit(False)).alias("raw_exists")))


def stage_summary(md: DataFrame, sub_log: DataFrame, qc_log: DataFrame, listing: DataFrame,
                  match: str = "exact", order_cols=("ts", "event_id")) -> DataFrame:
    """Per metadata run: raw files exist, subsampled reads and QC reads after
    from the latest log row with a count (NULL when the run has none): logs are
    append-only, so a retry adds a row behind the failed attempt's."""
    def latest(log, count):
        row = F.max(F.struct(*order_cols, count)).alias("row")
        return log.filter(F.col(count).isNotNull()).groupBy("run_accession").agg(row).select(
            "run_accession", f"row.{count}")
    sub = latest(sub_log, "subsampled_reads")
    qc = latest(qc_log, "total_reads_after")
    out = (md.select("run_accession", "sample_id")
             .join(raw_exists(md, listing, match), "run_accession", "left")
             .join(sub.select("run_accession", "subsampled_reads"), "run_accession", "left")
             .join(qc.select("run_accession", F.col("total_reads_after").alias("qc_reads_after")),
                   "run_accession", "left"))
    return out.select("run_accession", "sample_id", "raw_exists", "subsampled_reads", "qc_reads_after")


def qc_parse_reports(docs: DataFrame) -> DataFrame:
    """Nested QC JSON -> (valid, before, after); unreadable text -> valid false."""
    schema = T.StructType(QC_SCHEMA.fields + [T.StructField("_corrupt_record", T.StringType())])
    j = F.from_json(F.col("json"), schema, {"mode": "PERMISSIVE",
                                             "columnNameOfCorruptRecord": "_corrupt_record"})
    p = docs.select("run_accession", j.alias("j"))
    valid = p.j.isNotNull() & p.j["_corrupt_record"].isNull()
    return p.select(
        "run_accession", valid.alias("valid"),
        F.col("j.summary.before_filtering.total_reads").try_cast("bigint").alias("before"),
        F.col("j.summary.after_filtering.total_reads").try_cast("bigint").alias("after"))


def qc_summary(md: DataFrame, docs: DataFrame) -> DataFrame:
    """QC stage rows: qc_done with read totals (missing key -> 0, unreadable
    report -> NULL); runs without a report -> failed."""
    q = qc_parse_reports(docs)
    out = md.select("run_accession").join(q, "run_accession", "left")
    has = F.col("valid").isNotNull()
    return out.select(
        "run_accession",
        F.when(has, "qc_done").otherwise("failed: missing QC report").alias("status"),
        F.when(F.col("valid"), F.coalesce("before", F.lit(0))).cast("bigint").alias("total_reads_before"),
        F.when(F.col("valid"), F.coalesce("after", F.lit(0))).cast("bigint").alias("total_reads_after"))
