import os
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import logistic as lg
from cohortlens.operators import ml
from cohortlens.operators import reads as rd
from cohortlens.operators.folds import assign_folds, deal
from cohortlens.operators.permuted import permuted_aucs
from cohortlens.session import FREED, freed_shuffles, settings


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def left_over(spark, before):
    """The shuffle files that are new, after Spark had the time to delete them."""
    for _ in range(50):
        if not (new := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return new


def scored_rows(spark, n=600):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, n)
    x = np.stack([np.where(rng.random(n) < 0.7, -6.0, rng.normal(size=n)), rng.normal(size=n) + y, np.full(n, 2.0)], axis=1)
    weights = [0.5, -1.25, 3.0]
    rows = [(i, int(y[i]), float(x[i] @ weights), *map(float, x[i])) for i in range(n)]
    return spark.createDataFrame(rows, "pos long, y int, margin double, x0 double, x1 double, x2 double").repartition(3).localCheckpoint(), weights


@pytest.mark.parametrize("bucket", [100, 10_000])
def test_rounds_of_permutations_give_the_aucs_of_one_round(spark, bucket):
    rows, weights = scored_rows(spark)
    aucs = lambda **how: {(r.j, r.r): r.auc for r in permuted_aucs(rows, 600, weights, 5, 7, 9, bucket, **how).collect()}
    whole, parts = aucs(), aucs(round_values=1, block=256)
    assert len(whole) == 3 * 5 + 1 and parts == pytest.approx(whole, abs=1e-12)
    # A column of one value changes nothing.
    assert all(whole[2, r] == whole[3, 0] for r in range(5))


def test_no_round_leaves_shuffle_files(spark):
    rows, weights = scored_rows(spark)
    before = shuffle_files(spark)
    permuted_aucs(rows, 600, weights, 5, 7, rows_per_bucket=100, round_values=1)
    assert not left_over(spark, before)


def test_freed_shuffles_hold_inside_the_block_only(spark):
    kept = spark.conf.get(FREED, None)
    before = shuffle_files(spark)
    with freed_shuffles(spark):
        assert spark.range(1000).groupBy(F.col("id") % 7).count().count() == 7
    assert not left_over(spark, before) and spark.conf.get(FREED, None) == kept
    with pytest.raises(ValueError), freed_shuffles(spark):
        raise ValueError
    assert spark.conf.get(FREED, None) == kept


def test_a_forest_is_fitted_on_all_rows(spark, monkeypatch):
    # One row in 25,000 tells: the only ones with x = 1. A forest on part of the rows, or bounds from part of them, may miss them.
    n = 25_000
    df = spark.range(n, numPartitions=4).select(
        F.concat(F.lit("r"), "id").alias("run_accession"), (F.col("id") < 2).cast("int").alias("y"),
        (F.col("id") < 2).cast("double").alias("x"), F.rand(1).alias("noise"))
    spec = ml.ModelSpec("f", "random_forest", num_trees=20, max_depth=3)
    seen = []
    plain = ml.RandomForestClassifier.fit
    monkeypatch.setattr(ml.RandomForestClassifier, "fit", lambda self, rows: seen.append(rows.count()) or plain(self, rows))
    _, use, score = ml.fit(df, ["x", "noise"], spec)
    assert seen == [n] and use == ["x", "noise"]
    got = {r.y: r.s for r in score(df).groupBy("y").agg(F.avg("score").alias("s")).collect()}
    assert got[1] > 0.2 and got[0] < 0.01


def test_bounds_of_bins_come_from_all_rows(spark):
    rows = spark.range(40_000, numPartitions=4).select(
        F.col("id").cast("double").alias("even"), F.when(F.col("id") == 7, 9.0).when(F.col("id") % 2 == 0, -1.0).alias("rare"), F.lit(3.0).alias("flat"))
    even, rare, flat = ml.bin_bounds(rows, ["even", "rare", "flat"])
    assert len(even) == 31 and all(abs(b - 1250 * (i + 1)) < 10 for i, b in enumerate(even))
    assert rare == [0.0, 9.0] and flat == []


def test_parts_of_a_forest_score_every_row_once_by_all_its_trees(spark, monkeypatch):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 200)
    # One id comes twice.
    df = spark.createDataFrame([(f"r{max(i, 1)}", int(y[i]), float(y[i] + rng.normal()), float(rng.normal())) for i in range(200)],
                               "run_accession string, y int, a double, b double")
    folds = spark.createDataFrame([(f"r{i}", 0, i % 2) for i in range(1, 200)], "run_accession string, repeat int, fold int")
    spec = ml.ModelSpec("f", "random_forest", num_trees=10, max_depth=4)
    whole = ml.cross_validate(df, {"s": ["a", "b"]}, [spec], folds, threads=1)
    monkeypatch.setattr(ml, "TREE_ROWS", 300)  # three trees of 100 rows
    trees = []
    plain = ml._fit_trees
    monkeypatch.setattr(ml, "_fit_trees", lambda *a: trees.append(a[2].num_trees) or plain(*a))
    parts = ml.cross_validate(df, {"s": ["a", "b"]}, [spec], folds, threads=1)
    assert whole.columns == parts.columns and whole.count() == parts.count() == 200
    assert sum(trees) == 2 * spec.num_trees and len(trees) > 2
    a, b = ({r.fold: r.auc for r in ml.cv_aucs(d).collect()} for d in (whole, parts))
    assert all(abs(a[f] - b[f]) < 0.15 and b[f] > 0.6 for f in (0, 1))


def fastq(n, tag):
    return [(f"@{tag}{i}", "ACGT", "+", "@III") for i in range(n)]


def test_records_over_files_of_a_folder_and_over_blocks(spark, tmp_dir):
    # The first file ends inside a record, the second one goes on; a third folder's file has a part of a record at its end.
    text = [x for r in fastq(9, "a") for x in r]
    files = {"run_accession=A/mate=1/part-0.txt": text[:18], "run_accession=A/mate=1/part-1.txt": text[18:], "run_accession=A/mate=2/part-0.txt": text[:4],
             "run_accession=B/mate=1/part-0.txt": text[:11]}
    for name, lines in files.items():
        os.makedirs(os.path.dirname(f"{tmp_dir}/{name}"), exist_ok=True)
        with open(f"{tmp_dir}/{name}", "w") as f:
            f.write("".join(x + "\n" for x in lines))
    want = sorted([("A", 1, i, f"@a{i}", "ACGT", "+", "@III") for i in range(9)] + [("A", 2, 0, "@a0", "ACGT", "+", "@III")] + [
        ("B", 1, i, f"@a{i}", "ACGT", "+", "@III") for i in range(2)])
    assert sorted(map(tuple, rd.read_reads(spark, tmp_dir).collect())) == want
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "37", "spark.sql.execution.arrow.maxRecordsPerBatch": "3"}):
        assert sorted(map(tuple, rd.read_reads(spark, tmp_dir).collect())) == want


def test_many_files_are_listed_and_scanned_by_few_tasks(spark, tmp_dir):
    rows = [(f"r{i}", 1, 0, *fastq(1, i)[0]) for i in range(120)]
    reads = spark.createDataFrame(rows, "run_accession string, mate int, rec_id long, header string, seq string, plus string, qual string")
    rd.write_fastq(reads, f"{tmp_dir}/out")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("few", "few")
    try:
        back = rd.read_reads(spark, f"{tmp_dir}/out").collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(map(tuple, back)) == sorted(map(tuple, rows))
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("few") for s in tracker.getJobInfo(j).stageIds]
    most = max(4, rd.LISTERS * spark.sparkContext.defaultParallelism)
    assert stages and max(s.numTasks for s in stages if s) <= most


def test_written_folders_are_those_of_sparks_writer(spark, tmp_dir):
    odd = ["plain", "a/b", "c:d=e", "100%", "[x]^{y", "tab\tq?*", None, "", "é"]
    rows = [(r, m, i, *fastq(1, i)[0]) for r in odd for m in (1, 2) for i in range(3)]
    reads = spark.createDataFrame(rows, "run_accession string, mate int, rec_id long, header string, seq string, plus string, qual string")
    rd.write_fastq(reads, f"{tmp_dir}/own")
    text = F.concat_ws("\n", "header", "seq", "plus", "qual").alias("value")
    reads.select("run_accession", "mate", text).write.partitionBy("run_accession", "mate").text(f"{tmp_dir}/spark")
    folders = lambda top: {os.path.relpath(d, top) for d, _, names in os.walk(top) if any(n.startswith("part-") for n in names)}
    assert folders(f"{tmp_dir}/own") == folders(f"{tmp_dir}/spark")
    # One file a run and mate here, no crc beside it, none left half written; what was there goes.
    files = [n for _, _, names in os.walk(f"{tmp_dir}/own") for n in names]
    assert sum(n.startswith("part-") for n in files) >= len(folders(f"{tmp_dir}/own")) and not any(".txt." in n for n in files)
    key = lambda d: sorted((r.run_accession, r.mate, r.header, r.seq, r.plus, r.qual) for r in d.collect())
    assert sorted(r.value for r in spark.read.text(f"{tmp_dir}/own").collect()) == sorted(r.value for r in spark.read.text(f"{tmp_dir}/spark").collect())
    rd.write_fastq(reads.where("run_accession = 'plain'"), f"{tmp_dir}/own")
    assert key(rd.read_reads(spark, f"{tmp_dir}/own")) == sorted(("plain", m, *fastq(1, i)[0]) for m in (1, 2) for i in range(3))


def test_dealt_rows_have_the_folds_of_assign_folds(spark):
    rng = np.random.default_rng(3)
    rows = [(f"r{i}", int(rng.integers(0, 2)), float(i), None if i % 9 == 0 else float(rng.normal())) for i in range(500)]
    rows[3] = (None, *rows[3][1:])
    df = spark.createDataFrame(rows, "run_accession string, y int, a double, b double").repartition(3)
    sets = {"s": ["b", "a"]}
    plain = ml.deal_folds(df, sets, [3, 5, 8], 4, 42)
    wide = df.select(F.col("run_accession").alias("__id"), "y", F.array("b", "a").alias("x"))
    for k, dealt, small in zip((3, 5, 8), plain, deal(wide, ["b", "a"], [3, 5, 8], 4, 42, rows_per_bucket=60, size=37)):
        want = {(r.run_accession, r.repeat): r.fold for r in assign_folds(df, k, 4, 42).collect()}
        for one in (dealt, small):
            got = one.training_rows().collect()
            assert {(r["__id"], i): f for r in got for i, f in enumerate(r.parts)} == want and len(got) == 500
            assert one.keys == tuple((r, f) for r in range(4) for f in range(k)) and one.columns == ("b", "a")
        own = {r["__id"]: (r.y, r.x) for r in dealt.training_rows().collect()}
        assert own == {r[0]: (r[1], [r[3] or 0.0, r[2]]) for r in rows}


def test_few_rows_repeated_ids_and_no_rows_are_dealt(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 1, 2.0), ("b", 0, 3.0)], "run_accession string, y int, v double")
    dealt, = ml.deal_folds(df, {"s": ["v"]}, [5], 2, 42)
    rows = dealt.training_rows().collect()
    assert sorted((r["__id"], r.x[0]) for r in rows) == [("a", 1.0), ("a", 2.0), ("b", 3.0)]
    # Both rows of a are dealt; only two folds hold rows.
    assert dealt.keys == ((0, 0), (0, 1), (1, 0), (1, 1)) and sorted(tuple(r.parts) for r in rows if r["__id"] == "a") == [(0, 0), (1, 1)]
    none, = ml.deal_folds(df.where("y = 7"), {"s": ["v"]}, [5], 2, 42)
    assert none.keys == () and none.training_rows().count() == 0


def test_models_on_dealt_rows_are_those_on_assigned_folds(spark):
    rng = np.random.default_rng(6)
    y = rng.integers(0, 2, 300)
    df = spark.createDataFrame([(f"r{i}", int(y[i]), float(y[i] + rng.normal()), float(rng.normal())) for i in range(300)],
                               "run_accession string, y int, a double, b double")
    sets, models = {"s": ["a", "b"], "t": ["b"]}, [ml.ModelSpec("l1", "logistic_l1", C=2.0)]
    dealt, = ml.deal_folds(df, sets, [4], 2, 7)
    key = lambda d: {(r.feature_set, r.repeat, r.fold, r.run_accession): (r.y, round(r.score, 9)) for r in d.collect()}
    assert key(ml.cross_validate(df, sets, models, dealt)) == key(ml.cross_validate(df, sets, models, assign_folds(df, 4, 2, 7)))
    plan = ml.cross_validate(df, sets, models, dealt)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Generate" not in plan


def test_models_at_one_point_have_the_sums_of_each(spark):
    rng = np.random.default_rng(2)
    x, y, parts = rng.normal(size=(90, 3)), rng.integers(0, 2, 90).astype(float), rng.integers(0, 3, (90, 1)).astype(np.int32)
    lists = lambda v, w: pa.ListArray.from_arrays(pa.array(np.arange(91) * w, pa.int32()), pa.array(v.ravel()))
    batch = pa.RecordBatch.from_arrays([pa.array(y), lists(x, 3), lists(parts, 1)], names=["y", "x", "parts"])

    def fit(fold, *raw):
        return lg.Fit("s", (0, 2), "m", "l2", 1.0, 0, fold, raw=np.array(raw))

    def sums(fits):
        shared = type("Shared", (), {"value": (fits, np.zeros(3), {0: 0})})
        found = {}
        for b in lg._pass(shared, 3)([batch]):
            found |= dict(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        return [found[i] for i in range(len(fits))]
    fits = [fit(0, 0.5, 1.0, -1.0), fit(1, 0.5, 1.0, -1.0), fit(2, 0.25, 0.0, 2.0), fit(2, 0.5, 1.0, -1.0)]
    for one, alone in zip(sums(fits), [sums([f])[0] for f in fits]):
        assert one == pytest.approx(alone, rel=1e-12)


def test_scores_of_all_folds_come_in_one_batch_a_set(spark, monkeypatch):
    df = spark.createDataFrame([(f"r{i}", i % 2, float(i % 5)) for i in range(60)], "run_accession string, y int, v double").coalesce(1)
    dealt, = ml.deal_folds(df, {"s": ["v"]}, [5], 10, 42)
    scores = ml.cross_validate(df, {"s": ["v"]}, [ml.ModelSpec("l1", "logistic_l1", C=2.0)], dealt)
    sizes = scores.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"]) for b in batches), "n long")
    got = [r.n for r in sizes.collect()]
    assert sum(got) == 600 and len(got) == 1
