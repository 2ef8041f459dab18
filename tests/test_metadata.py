import pytest

from cohortlens.operators.metadata import clean_metadata, first_runs, subset_runs
from cohortlens.sources.files import read_metadata

COLS = "run_accession string, sample_id string, label string, age_group string, library_name string, ordinal long"


def test_duplicate_rows_collapse(spark):
    md = spark.createDataFrame([("R1", "S1", "healthy", "young", "L", 0),
                                ("R1", "S1", "healthy", "young", "L", 1)], COLS)
    assert clean_metadata(md).count() == 1


def test_trim_lower_first_row_and_drops(spark):
    md = spark.createDataFrame([
        ("  R1 ", " S9", " HEALTHY ", "Old ", None, 0),   # first R1 (after trim)
        ("R1", "S1", "cancer", "young", "L", 1),
        ("R2", "S2", None, "young", "L", 2),               # null label: dropped
        ("R2", "S3", "Cancer", "YOUNG", "L", 3),           # so this is R2's first row
        ("   ", "S4", "cancer", "young", "L", 4),          # blank run: dropped
        ("\tR3\n", "S5", "unknown", "old", "L", 5),
    ], COLS)
    rows = {r.run_accession: r for r in clean_metadata(md).collect()}
    assert set(rows) == {"R1", "R2", "R3"}
    assert (rows["R1"].sample_id, rows["R1"].label, rows["R1"].age_group) == ("S9", "healthy", "old")
    assert (rows["R2"].sample_id, rows["R2"].label, rows["R2"].age_group) == ("S3", "cancer", "young")
    assert rows["R3"].label == "unknown"


def test_missing_required_columns(spark, tmp_dir):
    p = f"{tmp_dir}/md.csv"
    with open(p, "w") as f:
        f.write("run_accession,label\nR1,healthy\n")
    with pytest.raises(ValueError, match="required columns"):
        read_metadata(spark, p)
    with pytest.raises(FileNotFoundError):
        read_metadata(spark, f"{tmp_dir}/absent.csv")


def test_read_metadata_file_order(spark, tmp_dir):
    p = f"{tmp_dir}/md.csv"
    with open(p, "w") as f:
        f.write("run_accession,sample_id,label,age_group,extra\n")
        f.write("R2,S2,cancer,old,x\nR1,S1,healthy,young,y\nR2,S9,cancer,old,z\n")
    md = clean_metadata(read_metadata(spark, p))
    got = {r.run_accession: (r.sample_id, r.extra) for r in md.collect()}
    assert got == {"R2": ("S2", "x"), "R1": ("S1", "y")}
    assert [r.run_accession for r in first_runs(md, 1).collect()] == ["R2"]


def test_subset_runs(spark):
    md = spark.createDataFrame([("R1", "S1", "healthy", "young", "L", 0),
                                ("R2", "S2", "cancer", "old", "L", 1)], COLS)
    assert subset_runs(md, []).count() == 2
    assert [r.run_accession for r in subset_runs(md, ["R2"]).collect()] == ["R2"]
    other = spark.createDataFrame([("R1",)], "r string")
    assert [r.run_accession for r in subset_runs(md, other).collect()] == ["R1"]
