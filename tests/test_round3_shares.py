"""Columns without patterns, and the bindings' staged run shares."""

from pyspark.sql import functions as F

from cohortlens.functions.columns import first_token, normalize_taxon, trim_ws
from cohortlens.sources import tables as tb

NAMES = ["a b", "  A_b  c ", "\ta\nb ", "", "  ", "_", " x\x85", "x  ", "a\x0bb", "a  b", "__A", None, "é_É", "a\r", "a \n"]


def test_names_are_trimmed_and_cut_as_by_the_patterns(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "n string")
    c = F.col("n")
    trim = lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")
    pairs = [(trim_ws(c), trim(c)), (first_token(c), F.split(trim(c), r"\s+").getItem(0)),
             (normalize_taxon(c), F.regexp_replace(trim(F.lower(F.regexp_replace(c, "_", " "))), r"\s+", " "))]
    for got, want in pairs:
        rows = df.select(got.alias("g"), want.alias("w")).collect()
        assert [r.g for r in rows] == [r.w for r in rows]


def _tables(spark, folder, n=1):
    """n shifted copies of four orders, one of them twice, with parts that share a name or a type."""
    orders, lines = [], []
    for k in range(n):
        orders += [(10 * k + i, 7, "F", "1-URGENT") for i in (1, 2, 5)] + [(10 * k + 1, 8, "O", "5-LOW")]
        lines += [(10 * k + 1, 1, 2.0), (10 * k + 1, 2, 3.0), (10 * k + 1, 3, None), (10 * k + 2, 3, 4.0), (10 * k + 5, 1, 1.0),
                  (10 * k + 9, 1, 1.0), (None, 1, 1.0)]
    parts = [(1, "red ring", "STANDARD"), (2, "red ring", "LARGE"), (3, "blue bolt", "STANDARD")]
    for name, rows, schema in (("orders", orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string"),
                               ("lineitem", lines, "l_orderkey long, l_partkey long, l_quantity double"),
                               ("part", parts, "p_partkey long, p_name string, p_type string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")


def test_run_shares(spark, tmp_dir):
    _tables(spark, tmp_dir)
    species = {tuple(r) for r in tb.species_abundance(spark, tmp_dir).collect()}
    # Order 1 stands there twice, so its whole is twice 5.
    assert species == {("R1", "S7", "red ring", 0.5), ("R1", "S8", "red ring", 0.5), ("R1", "S7", "blue bolt", None),
                       ("R1", "S8", "blue bolt", None), ("R2", "S7", "blue bolt", 1.0), ("R5", "S7", "red ring", 1.0)}
    assert {r.run_accession for r in tb.genus_abundance(spark, tmp_dir).collect()} == {"R1", "R2"}
    reports = {(r.run_accession, r.rank_code, r.name, r.taxid, r.taxon_reads, r.clade_reads)
               for r in tb.taxonomy_reports(spark, tmp_dir).collect()}
    assert ("R1", "D", "STANDARD", 1, 2, 10) in reports and ("R1", "G", "    red", 1, 5, 10) in reports
    assert ("R1", "S", "      blue bolt", 3, None, 10) in reports


def test_run_shares_shuffle_lines_once_by_order_in_tasks_of_bounded_size(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(tb, "LINES_PER_TASK", 10)
    _tables(spark, tmp_dir, 20)
    shares = tb._run_shares(spark, tmp_dir)
    # 140 lines: 14 tasks, each with its own file, where the lines of one order lie together.
    where = shares.select("o_orderkey", F.input_file_name().alias("f")).distinct().collect()
    assert len({r.f for r in where}) > 4 and len(where) == len({r.o_orderkey for r in where}) == 60


def test_matrix_cells_are_dealt_by_sample_into_tasks_of_bounded_size(spark, monkeypatch):
    from cohortlens.operators import abundance as ab
    monkeypatch.setattr(ab, "ROWS_PER_TASK", 20, raising=False)
    rows = [(f"R{i}", f"S{i % 100}", "species", t, 0.25) for i in range(200) for t in ("a", "b")]
    out = ab.abundance_matrix(spark.createDataFrame(rows, ab.LONG_SCHEMA), ["a", "b", "c"])
    # 400 rows: 20 tasks, each with the whole rows of its samples.
    held = out.withColumn("task", F.spark_partition_id()).collect()
    assert sorted((r.sample_id, r.a, r.b, r.c) for r in held) == sorted((f"S{i}", 0.5, 0.5, 0.0) for i in range(100))
    assert len({r.task for r in held}) > 10
