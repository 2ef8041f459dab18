"""Queries: stage logs, skip-existing, layout, stage and QC summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.operators import stages as st
from cohortlens.operators.metadata import clean_metadata
from cohortlens.plans.catalog import register
from cohortlens.plans.oracle import add_cte, sql
from cohortlens.sources import tables as tb

DONE = "('downloaded', 'subsampled', 'qc_done', 'kraken_done', 'bracken_done', 'skipped_existing')"
NAME_RE = r"'^(.+?)(?:_([12]))?\.fastq(\.gz)?$'"


def _md(spark, sf):
    return clean_metadata(tb.metadata(spark, sf))


add_cte("first_sub", ("stage_log",), """
SELECT run_accession, subsampled_reads FROM stage_log WHERE stage = 'subsample' AND subsampled_reads IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY run_accession ORDER BY ts DESC, event_id DESC) = 1""")
add_cte("first_qc", ("stage_log",), """
SELECT run_accession, total_reads_after FROM stage_log WHERE stage = 'qc' AND total_reads_after IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY run_accession ORDER BY ts DESC, event_id DESC) = 1""")
add_cte("files", ("listing",), f"""
SELECT file_name, regexp_extract(file_name, {NAME_RE}, 1) AS run_accession,
       coalesce(TRY_CAST(nullif(regexp_extract(file_name, {NAME_RE}, 2), '') AS INTEGER), 0) AS mate,
       regexp_extract(file_name, {NAME_RE}, 3) <> '' AS gz
FROM listing WHERE regexp_matches(file_name, {NAME_RE})""")


@register("stage_failures", sql(["stage_log"], """
SELECT stage, run_accession, status, regexp_extract(status, '^failed(?:: (.*))?$', 1) AS message, event_id
FROM stage_log WHERE status = 'failed' OR starts_with(status, 'failed: ')"""))
def q_stage_failures(spark, sf):
    """failed rows of the stage log with their message."""
    f = st.stage_failures(tb.stage_log(spark, sf))
    return f.select("stage", "run_accession", "status", "message", "event_id")


@register("pending_runs", sql(["md", "stage_log"], f"""
SELECT run_accession, sample_id FROM md WHERE run_accession NOT IN (
  SELECT run_accession FROM stage_log WHERE stage = 'subsample' AND status IN {DONE})"""))
def q_pending(spark, sf):
    """metadata runs still to subsample (no completed/skipped entry)."""
    return st.pending_runs(_md(spark, sf), tb.stage_log(spark, sf), "subsample").select(
        "run_accession", "sample_id")


@register("skipped_runs", sql(["md", "stage_log"], f"""
SELECT run_accession, sample_id, 'skipped_existing' AS status FROM md WHERE run_accession IN (
  SELECT run_accession FROM stage_log WHERE stage = 'subsample' AND status IN {DONE})"""))
def q_skipped(spark, sf):
    """metadata runs whose subsample output exists (skipped on rerun)."""
    return st.skipped_runs(_md(spark, sf), tb.stage_log(spark, sf), "subsample").select(
        "run_accession", "sample_id", "status")


@register("first_log_rows", sql(["stage_log"], """
SELECT run_accession, stage, status, event_id FROM stage_log
QUALIFY row_number() OVER (PARTITION BY run_accession ORDER BY ts, event_id) = 1"""))
def q_first_log(spark, sf):
    """First log row per run (log order = ts, event_id)."""
    return st.first_log_rows(tb.stage_log(spark, sf)).select("run_accession", "stage", "status", "event_id")


@register("layout", sql(["md", "files"], """
SELECT run_accession,
  CASE WHEN p1 IS NOT NULL AND p2 IS NOT NULL THEN 'paired' WHEN ps IS NOT NULL THEN 'single'
       WHEN g1 IS NOT NULL AND g2 IS NOT NULL THEN 'paired_gz' WHEN gs IS NOT NULL THEN 'single_gz' END AS layout,
  CASE WHEN p1 IS NOT NULL AND p2 IS NOT NULL THEN p1 WHEN ps IS NOT NULL THEN ps
       WHEN g1 IS NOT NULL AND g2 IS NOT NULL THEN g1 WHEN gs IS NOT NULL THEN gs END AS r1,
  CASE WHEN p1 IS NOT NULL AND p2 IS NOT NULL THEN p2 WHEN ps IS NOT NULL THEN NULL
       WHEN g1 IS NOT NULL AND g2 IS NOT NULL THEN g2 END AS r2,
  CASE WHEN coalesce(p1, ps, g1, gs) IS NULL AND NOT (p2 IS NOT NULL AND g2 IS NOT NULL AND false)
            AND NOT ((p1 IS NOT NULL AND p2 IS NOT NULL) OR ps IS NOT NULL OR (g1 IS NOT NULL AND g2 IS NOT NULL) OR gs IS NOT NULL)
       THEN 'failed: No FASTQ files found for ' || run_accession
       WHEN NOT ((p1 IS NOT NULL AND p2 IS NOT NULL) OR ps IS NOT NULL OR (g1 IS NOT NULL AND g2 IS NOT NULL) OR gs IS NOT NULL)
       THEN 'failed: No FASTQ files found for ' || run_accession ELSE 'ok' END AS status
FROM md LEFT JOIN (
  SELECT run_accession,
    max(CASE WHEN mate = 1 AND NOT gz THEN file_name END) AS p1,
    max(CASE WHEN mate = 2 AND NOT gz THEN file_name END) AS p2,
    max(CASE WHEN mate = 0 AND NOT gz THEN file_name END) AS ps,
    max(CASE WHEN mate = 1 AND gz THEN file_name END) AS g1,
    max(CASE WHEN mate = 2 AND gz THEN file_name END) AS g2,
    max(CASE WHEN mate = 0 AND gz THEN file_name END) AS gs
  FROM files GROUP BY run_accession) f USING (run_accession)"""))
def q_layout(spark, sf):
    """Read-file layout per run by precedence; none -> failed."""
    return st.resolve_layout(_md(spark, sf), tb.file_listing(spark, sf))


@register("stage_summary", sql(["md", "files", "first_sub", "first_qc"], """
SELECT m.run_accession, m.sample_id, coalesce(r.x, false) AS raw_exists, s.subsampled_reads,
       q.total_reads_after AS qc_reads_after
FROM md m
LEFT JOIN (SELECT DISTINCT run_accession, true AS x FROM files) r USING (run_accession)
LEFT JOIN first_sub s USING (run_accession)
LEFT JOIN first_qc q USING (run_accession)"""))
def q_stage_summary(spark, sf):
    """Raw files exist (exact), first subsample and QC log counts."""
    log = tb.stage_log(spark, sf)
    return st.stage_summary(_md(spark, sf), log.filter(F.col("stage") == "subsample"),
                            log.filter(F.col("stage") == "qc"), tb.file_listing(spark, sf))


@register("stage_summary_prefix", sql(["md", "listing", "first_sub", "first_qc"], """
SELECT m.run_accession, m.sample_id, coalesce(r.x, false) AS raw_exists, s.subsampled_reads,
       q.total_reads_after AS qc_reads_after
FROM md m
LEFT JOIN (SELECT DISTINCT prefix AS run_accession, true AS x FROM (
    SELECT substr(file_name, 1, CAST(i AS INTEGER)) AS prefix FROM (
      SELECT file_name, unnest(range(1, length(file_name) - strpos(reverse(file_name), 'qtsaf.') - 5 + 1)) AS i
      FROM listing WHERE strpos(file_name, '.fastq') > 0) a) b) r USING (run_accession)
LEFT JOIN first_sub s USING (run_accession)
LEFT JOIN first_qc q USING (run_accession)"""))
def q_stage_summary_prefix(spark, sf):
    """J6 parity mode: glob-style prefix match ({run}*.fastq*)."""
    log = tb.stage_log(spark, sf)
    return st.stage_summary(_md(spark, sf), log.filter(F.col("stage") == "subsample"),
                            log.filter(F.col("stage") == "qc"), tb.file_listing(spark, sf),
                            match="prefix")


@register("qc_summary", sql(["md", "qc_docs"], """
SELECT m.run_accession,
  CASE WHEN d.json IS NOT NULL THEN 'qc_done' ELSE 'failed: missing QC report' END AS status,
  CASE WHEN json_valid(d.json) THEN coalesce(TRY_CAST(json_extract_string(d.json, '$.summary.before_filtering.total_reads') AS BIGINT), 0) END AS total_reads_before,
  CASE WHEN json_valid(d.json) THEN coalesce(TRY_CAST(json_extract_string(d.json, '$.summary.after_filtering.total_reads') AS BIGINT), 0) END AS total_reads_after
FROM md m LEFT JOIN qc_docs d USING (run_accession)"""))
def q_qc_summary(spark, sf):
    """Per-run QC totals; missing key -> 0, unreadable -> NULL."""
    return st.qc_summary(_md(spark, sf), tb.qc_documents(spark, sf))


@register("stage_failures_stream", sql(["stage_log"], """
SELECT stage, run_accession, status, regexp_extract(status, '^failed(?:: (.*))?$', 1) AS message, event_id
FROM stage_log WHERE status = 'failed' OR starts_with(status, 'failed: ')"""))
def q_stage_failures_stream(spark, sf):
    """F4 as Structured Streaming: the stage log lands as files in the shared
    folder and a streaming query keeps the failures (drained availableNow)."""
    import uuid

    from cohortlens.session import checkpoint_dir
    from cohortlens.streaming import stage_monitor as sm
    src = f"{checkpoint_dir(spark).rstrip('/')}/stage-log-{uuid.uuid4().hex}"
    tb.stage_log(spark, sf).write.parquet(src)
    out = sm.drain_to_table(sm.failures_stream(sm.read_stage_log_stream(spark, src)))
    return out.select("stage", "run_accession", "status", "message", "event_id")
