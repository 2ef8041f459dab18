"""Cases that earlier versions got wrong."""
import math

from pyspark.sql import functions as F

from cohortlens.config import FeatureConfig
from cohortlens.operators import abundance as ab
from cohortlens.operators import panel as pn
from cohortlens.operators import reads as rd
from cohortlens.operators import stages as sg
from cohortlens.operators import stats as ss
from cohortlens.operators.features import targeted_features
from cohortlens.operators.metadata import clean_metadata
from cohortlens.sources import files

LONG = "run_accession string, sample_id string, level string, taxon string, relative_abundance double"


def test_small_values_keep_their_feature(spark):
    rows = [(0, 1e-10), (0, 2e-10), (1, 3e-10), (1, 4e-10)]
    df = spark.createDataFrame(rows, "y int, panel_x_log10 double")
    assert ss.univariate_effects(df, ["panel_x_log10"], "log10_abundance").count() == 1
    assert ss.feature_sanity(df, ["panel_x_log10"]).first().n_unique == 4


def test_text_nan_is_null(spark):
    df = spark.createDataFrame([("1",), ("nan",), ("x",), ("3",)], "v string")
    got = ss.feature_sanity(ss.coerce_numeric(df, ["v"]), ["v"]).first()
    assert (got.missing, got["mean"]) == (2, 2.0)


def test_wide_matrix_has_no_cap_and_blocks_cover_it(spark):
    long = spark.createDataFrame([("r", "s", "species", f"t{i:03d}", 1.0) for i in range(30)], LONG)
    blocks = list(ab.matrix_blocks(long, width=7))
    assert [t for taxa, _ in blocks for t in taxa] == ab.matrix_taxa(long) and len(blocks) == 5
    assert sum(sum(v for k, v in df.first().asDict().items() if k != "sample_id") for _, df in blocks) == 30


def test_panel_order_with_many_species(spark):
    picks = spark.createDataFrame([("species", "late", "m", 1.0, 1_500_000), ("genus", "g", "m", 1.0, 1)], pn.PANEL_SCHEMA)
    rows = pn.merge_panel(spark, ["c"], picks, []).orderBy("position").collect()
    assert [r.taxon for r in rows] == ["c", "late", "g"]


def test_colliding_columns_take_the_last_taxon(spark):
    cfg = FeatureConfig()
    md = spark.createDataFrame([("s", "r", "healthy", "young", "")], "sample_id string, run_accession string, label string, age_group string, library_name string")
    long = spark.createDataFrame([("r", "s", "species", "cold widget", 0.4), ("r", "s", "species", "other", 0.6)], LONG)
    row = targeted_features(md, long, None, None, ["cold_widget", "cold widget"], cfg.focal_species, cfg.focal_genus,
                            cfg.domain, cfg.pseudocount, cfg.presence_threshold).first()
    assert row.panel_cold_widget == 0.4


def test_stage_summary_after_a_retry(spark):
    md = spark.createDataFrame([("r", "s")], "run_accession string, sample_id string")
    sub = spark.createDataFrame([("r", 1, 1, None), ("r", 2, 2, 50)], "run_accession string, ts long, event_id long, subsampled_reads long")
    qc = spark.createDataFrame([("r", 1, 1, 7), ("r", 2, 2, None)], "run_accession string, ts long, event_id long, total_reads_after long")
    none = spark.createDataFrame([], "file_name string, run_accession string, mate int, gz boolean")
    row = sg.stage_summary(md, sub, qc, none).first()
    assert (row.subsampled_reads, row.qc_reads_after) == (50, 7)


def test_globs_and_folders(spark, tmp_dir):
    for run in ("a", "b"):
        with open(f"{tmp_dir}/{run}.report.tsv", "w") as f:
            f.write("1.0\t2\t2\tS\t9\t  x y\n")
        with open(f"{tmp_dir}/{run}.bracken_species.tsv", "w") as f:
            f.write("name\ttaxonomy_id\ttaxonomy_lvl\tkraken_assigned_reads\tadded_reads\tnew_est_reads\tfraction_total_reads\nx\t1\tS\t2\t0\t2\t0.5\n")
        with open(f"{tmp_dir}/{run}.fastp.json", "w") as f:
            f.write('{"summary": {}}')
    open(f"{tmp_dir}/unrelated.txt", "w").close()
    for path in (tmp_dir, f"{tmp_dir}/*.report.tsv", [f"{tmp_dir}/a.report.tsv", f"{tmp_dir}/b.report.tsv", f"{tmp_dir}/none.report.tsv"]):
        assert sorted((r.run_accession, r.name) for r in files.read_taxonomy_reports(spark, path).collect()) == [("a", "x y"), ("b", "x y")]
    assert sorted(r.run_accession for r in files.read_abundance_estimates(spark, f"{tmp_dir}/*.tsv").collect()) == ["a", "b"]
    assert sorted(r.run_accession for r in files.read_qc_documents(spark, tmp_dir).collect()) == ["a", "b"]
    assert files.read_taxonomy_reports(spark, f"{tmp_dir}/nothing*").count() == 0


def test_file_order_over_several_files(spark, tmp_dir):
    head = "run_accession,sample_id,label,age_group,library_name\n"
    with open(f"{tmp_dir}/1.csv", "w") as f:
        f.write(head + "R1,S1,healthy,young,FIRST\n")
    with open(f"{tmp_dir}/2.csv", "w") as f:
        f.write(head + "R1,S1,healthy,young,SECOND\n" + "".join(f"R{i},S{i},cancer,old,x\n" for i in range(2, 3000)))
    md = clean_metadata(files.read_metadata(spark, f"{tmp_dir}/*.csv"))
    assert md.filter("run_accession = 'R1'").first().library_name == "FIRST"


def test_pairs_hold_whole_records(spark):
    reads = spark.createDataFrame([("r", m, 1, f"@{m}", "AC", "+", "II") for m in (1, 2)],
                                  "run_accession string, mate int, rec_id long, header string, seq string, plus string, qual string")
    row = rd.pair_reads(reads).first()
    assert (row.plus_1, row.qual_1, row.header_2, row.qual_2) == ("+", "II", "@2", "II")


def test_tiny_fractions(spark):
    from cohortlens.functions.columns import keyed_uniform
    got = spark.range(2000).select(keyed_uniform(F.lit("r"), F.col("id"), F.lit(1)).alias("u")).collect()
    assert all(0 <= r.u < 1 for r in got) and len({r.u for r in got}) == 2000
    assert any(not math.isclose(r.u * 2**32 % 1, 0) for r in got)


def test_exact_p_matches_counting():
    from itertools import combinations
    for n0, n1 in ((3, 3), (2, 5), (6, 4), (8, 2)):
        total = [sum(c) - n0 * (n0 + 1) / 2 for c in combinations(range(1, n0 + n1 + 1), n0)]
        for u in range(math.ceil(n0 * n1 / 2), n0 * n1 + 1):
            want = min(1.0, 2 * sum(t >= u for t in total) / len(total))
            assert math.isclose(ss.exact_rank_sum_p(n0, n1, u), want, rel_tol=1e-9)


def test_small_classes_get_the_exact_p(spark):
    df = spark.createDataFrame([(0, 1.0, 1.0), (0, 2.0, 1.0), (0, 3.0, 2.0), (1, 4.0, 2.0), (1, 5.0, 3.0), (1, 6.0, 3.0)],
                               "y int, panel_a double, panel_b double")
    got = {r.feature: r.p_value for r in ss.univariate_effects(df, ["panel_a", "panel_b"], "x").collect()}
    assert math.isclose(got["panel_a"], 0.1) and got["panel_b"] != 0.1


def test_direction_table_falls_back_to_presence(spark):
    df = spark.createDataFrame([(0, 0.0, 1.0), (1, 1.0, 1.0), (0, 0.0, 1.0)], "y int, panel_a_present double, panel_a_log10 double")
    log, pres = ss.univariate_effects(df, ["panel_a_log10"], "l"), ss.univariate_effects(df, ["panel_a_present"], "p")
    got = ss.direction_table(log, pres)
    assert got.columns == ["feature", "healthy_mean", "cancer_mean", "mean_diff", "abs_diff", "p_value"]
    assert [r.feature for r in got.collect()] == ["panel_a_present"]


def test_empty_outputs_are_redone(spark):
    md = spark.createDataFrame([("a",), ("b",), ("c",)], "run_accession string")
    log = spark.createDataFrame([(r, "subsample", "subsampled") for r in "ab"], "run_accession string, stage string, status string")
    done = sg.completed_runs(log).count()
    outputs = spark.createDataFrame([("a", 10), ("b", 0)], "run_accession string, length long")
    assert done == 2
    assert sorted(r[0] for r in sg.pending_runs(md, log, None, outputs).collect()) == ["b", "c"]
    assert [r.run_accession for r in sg.skipped_runs(md, log, None, outputs).collect()] == ["a"]


def test_a_hot_run_goes_to_several_tasks(spark):
    from cohortlens.operators.salted import salted_join
    reads = spark.range(4000).select(F.when(F.col("id") % 10 < 7, "hot").otherwise(F.col("id").cast("string")).alias("run_accession"),
                                     F.lit(1).alias("mate"), F.col("id").alias("rec_id"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled",
                                          "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(old, ("-1", "false", "16")):
            spark.conf.set(k, v)
        joined = salted_join(reads, rd.run_totals(reads), "run_accession")
        tasks = joined.filter("run_accession = 'hot'").groupBy(F.spark_partition_id().alias("t")).count().collect()
        assert len(tasks) > 3 and max(r["count"] for r in tasks) < 1600
        assert joined.count() == 4000
        log = {r.run_accession: r.original_reads for r in rd.sample_log(reads, target=100).collect()}
        assert log["hot"] == 2800 and len(log) == 1201
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_a_run_is_written_by_several_tasks_and_read_back_in_order(spark, tmp_dir):
    import glob
    rows = [("r", 1, i, f"@{i}", "AC", "+", "@I") for i in range(400)] + [("s", 2, i, f"@s{i}", "AC", "+", "II") for i in range(3)]
    reads = spark.createDataFrame(rows, "run_accession string, mate int, rec_id long, header string, seq string, plus string, qual string")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rd.write_fastq(reads.repartition(5), f"{tmp_dir}/out")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert len(glob.glob(f"{tmp_dir}/out/run_accession=r/mate=1/part-*")) > 2
    back = rd.read_reads(spark, f"{tmp_dir}/out").collect()
    assert sorted((r.run_accession, r.mate, r.rec_id, r.header) for r in back) == sorted((r[0], r[1], r[2], r[3]) for r in rows)
