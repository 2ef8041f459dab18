import gzip
import os

from pyspark.sql import functions as F

from cohortlens.operators import reads as rd
from cohortlens.operators import stages as st
from cohortlens.operators.folds import assign_folds, fold_balance
from cohortlens.sources import files as fs


def test_failures_and_skip(spark):
    log = spark.createDataFrame([("R1", "downloaded"), ("R2", "failed"), ("R3", "failed: boom"),
                                 ("R4", "skipped_existing"), ("R5", "failedx")],
                                "run_accession string, status string")
    f = {r.run_accession: r.message for r in st.stage_failures(log).collect()}
    assert f == {"R2": "", "R3": "boom"}
    md = spark.createDataFrame([(f"R{i}",) for i in range(1, 7)], "run_accession string")
    pend = sorted(r.run_accession for r in st.pending_runs(md, log).collect())
    assert pend == ["R2", "R3", "R5", "R6"]


def test_layout_precedence(spark):
    md = spark.createDataFrame([(r,) for r in ("A", "B", "C", "D", "E")], "run_accession string")
    listing = spark.createDataFrame([(n,) for n in (
        "A_1.fastq", "A_2.fastq", "A.fastq", "A.fastq.gz",   # plain pair wins
        "B_1.fastq", "B.fastq.gz", "B_1.fastq.gz", "B_2.fastq.gz",  # broken plain pair -> gz pair
        "C.fastq.gz", "C.fastq",                             # plain single
        "D.fastq.gz", "notes.txt")], "file_name string")
    got = {r.run_accession: (r.layout, r.r1, r.r2, r.status) for r in st.resolve_layout(md, listing).collect()}
    assert got["A"] == ("paired", "A_1.fastq", "A_2.fastq", "ok")
    assert got["B"] == ("paired_gz", "B_1.fastq.gz", "B_2.fastq.gz", "ok")
    assert got["C"] == ("single", "C.fastq", None, "ok")
    assert got["D"] == ("single_gz", "D.fastq.gz", None, "ok")
    assert got["E"][0] is None and got["E"][3].startswith("failed: No FASTQ files found for E")


def test_raw_exists_exact_and_prefix(spark):
    md = spark.createDataFrame([("R1",), ("R10",), ("R2",)], "run_accession string")
    listing = spark.createDataFrame([("R10_1.fastq",)], "file_name string")
    ex = {r.run_accession: r.raw_exists for r in st.raw_exists(md, listing).collect()}
    pr = {r.run_accession: r.raw_exists for r in st.raw_exists(md, listing, "prefix").collect()}
    assert ex == {"R1": False, "R10": True, "R2": False}
    assert pr == {"R1": True, "R10": True, "R2": False}


def test_qc_summary_rules(spark):
    md = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "run_accession string")
    docs = spark.createDataFrame([("a", "{}"), ("b", '{"summary": {"bef'),
                                  ("c", '{"summary": {"before_filtering": {"total_reads": 7}}}')],
                                 "run_accession string, json string")
    got = {r.run_accession: (r.status, r.total_reads_before, r.total_reads_after)
           for r in st.qc_summary(md, docs).collect()}
    assert got["a"] == ("qc_done", 0, 0)
    assert got["b"] == ("qc_done", None, None)
    assert got["c"] == ("qc_done", 7, 0)
    assert got["d"][0].startswith("failed")


def _reads_df(spark, n=2000, mates=(1, 2)):
    rows = [(f"R{i % 7}", m, i, f"@r{i}/{m}", "ACGT", "+", "@III") for i in range(n) for m in mates]
    return spark.createDataFrame(rows, "run_accession string, mate int, rec_id long, header string, seq string, plus string, qual string")


def test_sampling_is_partition_independent_paired_and_nested(spark):
    reads = _reads_df(spark)
    a = {(r.run_accession, r.mate, r.rec_id) for r in rd.sample_reads(reads, 0.3).collect()}
    b = {(r.run_accession, r.mate, r.rec_id) for r in rd.sample_reads(reads.repartition(13), 0.3).collect()}
    assert a == b and 0 < len(a) < 4000
    by = {}
    for run, mate, rec in a:
        by.setdefault((run, rec), set()).add(mate)
    assert all(m == {1, 2} for m in by.values())
    small = {(r.run_accession, r.mate, r.rec_id) for r in rd.sample_reads(reads, 0.1).collect()}
    assert small <= a
    log = rd.sample_log(reads, fraction=0.3).agg(F.sum("subsampled_reads")).first()[0]
    assert log == len(a) // 2


def test_target_sampling_fraction(spark):
    reads = _reads_df(spark, 200, (1,))
    fr = {r.run_accession: r.fraction for r in rd.target_fractions(reads, 10).collect()}
    n = {r.run_accession: r.original_reads for r in rd.run_totals(reads).collect()}
    assert all(abs(fr[k] - min(1.0, 10 / n[k])) < 1e-15 for k in fr)
    assert {r.fraction for r in rd.target_fractions(reads, 10**6).collect()} == {1.0}


def test_read_reads_text_plain_gz_multiblock(spark, tmp_dir):
    recs = [(f"@r{i}", "ACGT" * (i % 5 + 1), "+", "@" + "I" * (4 * (i % 5 + 1) - 1)) for i in range(3000)]
    p1 = os.path.join(tmp_dir, "RUNA_1.fastq")
    with open(p1, "w") as f:
        for r in recs:
            f.write("\n".join(r) + "\n")
    p2 = os.path.join(tmp_dir, "RUNA_2.fastq.gz")
    with gzip.open(p2, "wt") as f:
        for r in recs[:1000]:
            f.write("\n".join(r) + "\n")
        f.write("@partial\nACGT\n")  # trailing partial record
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # many blocks per file
    try:
        got = rd.read_reads(spark, [p1, p2]).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    m1 = {r.rec_id: r for r in got if r.mate == 1}
    m2 = {r.rec_id: r for r in got if r.mate == 2}
    assert len(m1) == 3000 and len(m2) == 1000
    assert all(m1[i].header == recs[i][0] and m1[i].qual == recs[i][3] for i in range(3000))
    assert {r.run_accession for r in got} == {"RUNA"}
    assert len(rd.pair_reads(rd.read_reads(spark, [p1, p2])).collect()) == 1000


def test_file_sources(spark, tmp_dir):
    rep = os.path.join(tmp_dir, "R1.report.tsv")
    with open(rep, "w") as f:
        f.write("50.0\t100\t100\tD\t2\tBacteria\n5.0\t10\t10\tS\t851\t      Fusobacterium nucleatum\n")
    empty = os.path.join(tmp_dir, "R2.report.tsv")
    open(empty, "w").close()
    r = fs.read_taxonomy_reports(spark, [rep, empty, os.path.join(tmp_dir, "R3.report.tsv")]).collect()
    assert {(x.run_accession, x.name) for x in r} == {("R1", "Bacteria"), ("R1", "Fusobacterium nucleatum")}
    js = os.path.join(tmp_dir, "R1.fastp.json")
    with open(js, "w") as f:
        f.write('{\n "summary": {"after_filtering": {"total_reads": 9}}\n}\n')
    docs = fs.read_qc_documents(spark, [js])
    assert st.qc_parse_reports(docs).first().after == 9
    assert fs.read_stage_log(spark, os.path.join(tmp_dir, "none.csv"), "qc").count() == 0


def test_folds_balanced(spark):
    df = spark.createDataFrame([(f"r{i}", int(i % 3 == 0)) for i in range(103)], "run_accession string, y int")
    folds = assign_folds(df, k=5, repeats=3, seed=42)
    assert folds.count() == 103 * 3
    bal = fold_balance(folds).groupBy("repeat", "y").agg((F.max("n") - F.min("n")).alias("d")).collect()
    assert max(r.d for r in bal) <= 1
    again = {(r.run_accession, r.repeat, r.fold) for r in assign_folds(df.repartition(7), 5, 3, 42).collect()}
    assert again == {(r.run_accession, r.repeat, r.fold) for r in folds.collect()}
