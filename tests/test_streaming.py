import os

from cohortlens.operators.stages import stage_failures
from cohortlens.streaming import stage_monitor as sm


def test_stream_matches_batch(spark, tmp_dir):
    rows = [("qc", f"R{i}", "failed: x" if i % 3 == 0 else "qc_done", None, i, None, None, None, None)
            for i in range(30)]
    df = spark.createDataFrame(rows, sm.STAGE_LOG_STREAM_SCHEMA)
    src = os.path.join(tmp_dir, "log")
    df.repartition(3).write.parquet(src)
    stream = sm.read_stage_log_stream(spark, src, max_files_per_trigger=1)
    got = {r.run_accession for r in sm.drain_to_table(sm.failures_stream(stream)).collect()}
    assert got == {r.run_accession for r in stage_failures(df).collect()}
    counts = {(r.stage, r.status): r.n for r in
              sm.drain_to_table(sm.status_counts_stream(stream), mode="complete").collect()}
    assert counts == {("qc", "failed: x"): 10, ("qc", "qc_done"): 20}
