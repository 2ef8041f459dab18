"""Composite stage plans: subsampling with skip-existing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators import reads as rd
from cohortlens.operators.salted import salted_join
from cohortlens.operators.stages import pending_runs, skipped_runs


def subsample_runs(md: DataFrame, reads: DataFrame, log: DataFrame | None = None,
                   fraction: float | None = 0.1, target: int | None = None, seed: int = 42,
                   skip_existing: bool = True) -> tuple[DataFrame, DataFrame]:
    """Returns (sampled reads, subsample log).

    Runs with a completed subsample entry are logged ``skipped_existing``;
    the others are sampled (fixed fraction, or per-run fraction from a
    target count) and logged with original/kept counts; runs without reads
    are logged as failed."""
    if skip_existing and log is not None:
        skipped = skipped_runs(md, log, "subsample").select("run_accession", "status")
        todo = pending_runs(md, log, "subsample").select("run_accession")
    else:
        skipped = None
        todo = md.select("run_accession")
    todo_reads = salted_join(reads, todo, "run_accession", "left_semi")
    slog = rd.sample_log(todo_reads, fraction=fraction, target=target, seed=seed)
    missing = (todo.join(slog.select("run_accession"), "run_accession", "left_anti")
               .withColumn("status", F.concat(F.lit("failed: No FASTQ files found for "),
                                              F.col("run_accession"))))
    out = slog.unionByName(missing, allowMissingColumns=True)
    if skipped is not None:
        out = out.unionByName(skipped, allowMissingColumns=True)
    sampled = (rd.sample_target(todo_reads, target, seed) if target is not None
               else rd.sample_reads(todo_reads, fraction if fraction is not None else 0.1, seed))
    # Where a run has second mates, its trailing first mates without one go.
    paired = sampled.filter(F.col("mate") == 2).select("run_accession").distinct()
    ends = sampled.filter(F.col("mate") == 2).select("run_accession", "rec_id")
    lone = (salted_join(sampled.filter(F.col("mate") == 1), paired, "run_accession", "left_semi")
            .join(ends, ["run_accession", "rec_id"], "left_anti").select("run_accession", "mate", "rec_id"))
    sampled = sampled.join(lone, ["run_accession", "mate", "rec_id"], "left_anti")
    return sampled, out.select("run_accession", "status", "original_reads", "subsampled_reads", "fraction")
