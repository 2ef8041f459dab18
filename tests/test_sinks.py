import os

from cohortlens.sources import sinks


def test_failures_file_only_when_failures(spark, tmp_dir):
    path = os.path.join(tmp_dir, "failures")
    bad = spark.createDataFrame([("R1", "failed: x"), ("R2", "downloaded")], "run_accession string, status string")
    assert sinks.write_failures(bad, path) is True
    assert spark.read.option("header", True).csv(path).count() == 1
    good = spark.createDataFrame([("R2", "downloaded")], "run_accession string, status string")
    assert sinks.write_failures(good, path) is False
    assert not os.path.exists(path)


def test_stage_log_append_and_cohort_outputs(spark, tmp_dir):
    log = spark.createDataFrame([("R1", "subsampled")], "run_accession string, status string")
    p = os.path.join(tmp_dir, "stage_log")
    sinks.append_stage_log(log, p, "subsample")
    sinks.append_stage_log(log, p, "subsample")
    sinks.append_stage_log(log, p, "qc")
    got = spark.read.parquet(p)
    assert got.count() == 3 and {r.stage for r in got.collect()} == {"subsample", "qc"}
    root = os.path.join(tmp_dir, "out")
    sinks.write_cohort_outputs({"effects": log}, root, "A")
    sinks.write_cohort_outputs({"effects": log}, root, "B")
    assert {r.cohort for r in spark.read.parquet(f"{root}/effects").collect()} == {"A", "B"}
    sinks.write_table(log, os.path.join(tmp_dir, "t.csv"), fmt="csv")
    assert spark.read.option("header", True).csv(os.path.join(tmp_dir, "t.csv")).count() == 1


def test_an_attempt_is_appended_once(spark, tmp_dir):
    import pytest
    from pyspark.sql import functions as F
    schema, p = "run_accession string, status string", os.path.join(tmp_dir, "log")
    rows = lambda *r: spark.createDataFrame([(x, "subsampled") for x in r], schema)
    assert sinks.read_stage_log(spark, p, schema).count() == 0
    assert sinks.commit_stage_log(rows("R1", "R2"), p, "subsample", "day1") is True
    assert sinks.commit_stage_log(rows("R1", "R2"), p, "subsample", "day1") is False
    # A try that fails in between leaves nothing that is read; the next one takes its place.
    broken = rows("R3").withColumn("status", F.raise_error(F.lit("executor lost")).cast("string"))
    with pytest.raises(Exception, match="executor lost"):
        sinks.commit_stage_log(broken, p, "qc", "day2")
    assert sinks.read_stage_log(spark, p, schema).count() == 2
    rows("R9").withColumn("stage", F.lit("qc")).write.mode("overwrite").parquet(f"{p}/rows/attempt=day2")
    assert sinks.read_stage_log(spark, p, schema).count() == 2  # written, but not in the manifest
    assert sinks.commit_stage_log(rows("R3"), p, "qc", "day2") is True
    got = sorted((r.run_accession, r.stage, r.attempt) for r in sinks.read_stage_log(spark, p, schema).collect())
    assert got == [("R1", "subsample", "day1"), ("R2", "subsample", "day1"), ("R3", "qc", "day2")]
    with pytest.raises(ValueError, match="attempt"):
        sinks.commit_stage_log(rows("R1"), p, "qc", "../x")
