"""Bindings: derive the reference's input shapes from the driver's tables.

Each function reads parquet tables under ``sf_dir`` and returns a DataFrame
with the schema the operators expect, so every query's work grows with the
tables.  The same expressions are written once more in SQL in
``cohortlens.plans.oracle`` for the DuckDB cross-check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortlens.config import FeatureConfig

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Fixed binding values: which test-table names play the reference's roles.
BINDING_FOCAL_SPECIES = "small ring"
BINDING_FOCAL_GENUS = "small"
BINDING_DOMAIN = "STANDARD"
BINDING_EXCLUDED = ("hot gear", "hot")
BINDING_PANEL = ("small ring", "hot gear", "blue bolt", "red", "cold_widget",
                 "Large  Anvil", "new")


# The words of ``part.p_name`` in the given tables.
TAXON_FIRST = ("blue", "cold", "hot", "large", "new", "old", "red", "small")
TAXON_SECOND = ("anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget")


def binding_config(top_n: int = 6, levels: str = "both",
                   metric: str = "mean_x_prevalence") -> FeatureConfig:
    return FeatureConfig(panel_taxa=BINDING_PANEL, excluded_taxa=BINDING_EXCLUDED,
                         focal_species=BINDING_FOCAL_SPECIES,
                         focal_genus=BINDING_FOCAL_GENUS, domain=BINDING_DOMAIN,
                         auto_panel_top_n=top_n, auto_panel_levels=levels,
                         auto_panel_metric=metric)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _run_id(c):
    return F.concat(F.lit("R"), c.cast("string"))


def _sample_id(c):
    return F.concat(F.lit("S"), c.cast("string"))


def _label(status):
    return (F.when(status == "F", "healthy").when(status == "O", "cancer")
            .otherwise("pending"))


def _age(priority):
    p = F.substring(priority, 1, 1)
    return (F.when(p.isin("1", "2"), "young").when(p.isin("4", "5"), "old")
            .otherwise("unknown"))


def metadata(spark, sf_dir) -> DataFrame:
    """Clean cohort metadata D1: one row per order; ordinal = file order."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        _run_id(o.o_orderkey).alias("run_accession"),
        _sample_id(o.o_custkey).alias("sample_id"),
        _label(o.o_orderstatus).alias("label"),
        _age(o.o_orderpriority).alias("age_group"),
        o.o_orderpriority.alias("library_name"),
        o.o_orderkey.alias("ordinal"),
    )


def dirty_metadata(spark, sf_dir) -> DataFrame:
    """Raw metadata with padded/upper-cased copies, nulls and blank runs.

    Four copies per order, ordinal = 8*key + offset:
      * clean row (offset 2, or 3 for even keys);
      * padded upper-case row with a different sample (offset 3, or 2 for
        even keys: it wins the first-row rule there);
      * null label (offset 0 for keys divisible by 3, else 5): dropped before
        the first-row rule, so it never wins;
      * blank run accession (offset 1): dropped.
    """
    o = table(spark, sf_dir, "orders")
    k = o.o_orderkey
    even = (k % 2) == 0
    run = _run_id(k)
    base = dict(sample_id=_sample_id(o.o_custkey), label=_label(o.o_orderstatus),
                age_group=_age(o.o_orderpriority), library_name=o.o_orderpriority)
    clean = o.select(run.alias("run_accession"), base["sample_id"].alias("sample_id"),
                     base["label"].alias("label"), base["age_group"].alias("age_group"),
                     base["library_name"].alias("library_name"),
                     (k * 8 + F.when(even, 3).otherwise(2)).alias("ordinal"))
    padded = o.select(F.concat(F.lit("  "), run, F.lit(" ")).alias("run_accession"),
                      F.concat(F.lit(" "), _sample_id(o.o_custkey + 1)).alias("sample_id"),
                      F.concat(F.upper(base["label"]), F.lit("  ")).alias("label"),
                      F.concat(F.lit(" "), F.upper(base["age_group"])).alias("age_group"),
                      base["library_name"].alias("library_name"),
                      (k * 8 + F.when(even, 2).otherwise(3)).alias("ordinal"))
    nulls = o.select(run.alias("run_accession"), _sample_id(o.o_custkey + 2).alias("sample_id"),
                     F.lit(None).cast("string").alias("label"),
                     base["age_group"].alias("age_group"),
                     base["library_name"].alias("library_name"),
                     (k * 8 + F.when(k % 3 == 0, 0).otherwise(5)).alias("ordinal"))
    blanks = o.select(F.lit("   ").alias("run_accession"), base["sample_id"].alias("sample_id"),
                      base["label"].alias("label"), base["age_group"].alias("age_group"),
                      base["library_name"].alias("library_name"),
                      (k * 8 + 1).alias("ordinal"))
    return clean.unionByName(padded).unionByName(nulls).unionByName(blanks)


#: Line items that one task takes when they are summed by run.
LINES_PER_TASK = 250_000

_STAGED: dict = {}


def _run_shares(spark, sf_dir) -> DataFrame:
    """(o_orderkey, o_custkey, code, taxon, q, taxid, total): quantity and least part of each run and taxon, and the
    run's whole quantity; code D: part type, G: first word of the part name, S: part name.

    It plays the role of the reference's stored per-run files: it is written once per session and table folder to the
    shared checkpoint folder, and every species, genus and report binding filters it.  Line items are dealt by order into
    tasks of about ``LINES_PER_TASK``; totals and all three sums are taken behind that one shuffle."""
    from cohortlens.session import write_staged
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _STAGED:
        return _STAGED[key]
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    tasks = max(spark.sparkContext.defaultParallelism, -(-li.count() // LINES_PER_TASK))
    lines = (li.join(p, li.l_partkey == p.p_partkey).repartition(tasks, "l_orderkey")
             .join(o.repartition(tasks, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey")))
    whole = lines.withColumn("total", F.sum("l_quantity").over(Window.partitionBy("l_orderkey")))
    named = {"D": F.col("p_type"), "G": F.substring_index("p_name", " ", 1), "S": F.col("p_name")}
    taxa = F.array(*[F.struct(F.lit(code).alias("code"), taxon.alias("taxon")) for code, taxon in named.items()])
    shares = (whole.select("l_orderkey", "o_custkey", "l_quantity", "p_partkey", "total", F.inline(taxa))
              .groupBy("l_orderkey", "o_custkey", "code", "taxon")
              .agg(F.sum("l_quantity").alias("q"), F.min("p_partkey").alias("taxid"), F.max("total").alias("total")))
    _STAGED[key] = write_staged(shares.withColumnRenamed("l_orderkey", "o_orderkey"), "run-shares")
    return _STAGED[key]


def species_abundance(spark, sf_dir) -> DataFrame:
    """Combined species table D5 (before renaming): one row per (run, taxon)."""
    return _fractions(_run_shares(spark, sf_dir).filter(F.col("code") == "S"))


def genus_abundance(spark, sf_dir) -> DataFrame:
    """Genus table: first word of the part name; a fifth of runs have none."""
    return _fractions(_run_shares(spark, sf_dir).filter((F.col("code") == "G") & ((F.col("o_orderkey") % 5) != 0)))


def _fractions(s: DataFrame) -> DataFrame:
    return s.select(_run_id(s.o_orderkey).alias("run_accession"),
                    _sample_id(s.o_custkey).alias("sample_id"),
                    F.col("taxon").alias("name"),
                    (s.q / s.total).alias("fraction_total_reads"))


def taxonomy_reports(spark, sf_dir) -> DataFrame:
    """Per-run taxonomy report rows D4 (file name carries the run).

    D rows: part type shares; G and S rows: genus/species shares with the
    indented names of real reports.
    """
    s = _run_shares(spark, sf_dir)
    indent = F.when(s.code == "G", "    ").when(s.code == "S", "      ").otherwise("")
    return s.select(
        _run_id(s.o_orderkey).alias("run_accession"),
        (F.lit(100.0) * s.q / s.total).alias("percentage"),
        s.total.cast("bigint").alias("clade_reads"),
        s.q.cast("bigint").alias("taxon_reads"),
        s.code.alias("rank_code"), s.taxid,
        F.concat(indent, F.col("taxon")).alias("name"))


def _last_event_per_user(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    last = e.groupBy("user_id").agg(F.max(F.struct("ts", "event_id", "event_type", "props"))
                                    .alias("r"))
    return last.select("user_id", "r.*")


def qc_documents(spark, sf_dir) -> DataFrame:
    """One QC JSON document per run R<user_id> (the user's last event).

    purchase/click/view: full summary (view lacks the after branch);
    signup: '{}'; error: truncated, malformed text.
    """
    last = _last_event_per_user(spark, sf_dir)
    k = F.get_json_object("props", "$.k")
    before = F.concat(F.lit('{"before_filtering": {"total_reads": '),
                      (k.cast("bigint") * 10).cast("string"), F.lit("}"))
    after = F.concat(F.lit(', "after_filtering": {"total_reads": '), k, F.lit("}"))
    doc = (F.when(F.col("event_type") == "signup", F.lit("{}"))
           .when(F.col("event_type") == "error", F.concat(F.lit('{"summary": {"before'), k))
           .when(F.col("event_type") == "view",
                 F.concat(F.lit('{"summary": '), before, F.lit("}}")))
           .otherwise(F.concat(F.lit('{"summary": '), before, after, F.lit("}}"))))
    return last.select(_run_id(F.col("user_id")).alias("run_accession"), doc.alias("json"))


def stage_log(spark, sf_dir) -> DataFrame:
    """Append-only stage log D9 built from events (order = ts, event_id)."""
    e = table(spark, sf_dir, "events")
    et = F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("bigint")
    stage = (F.when(et == "view", "download").when(et.isin("click", "signup"), "subsample")
             .otherwise("qc"))
    status = (F.when(et == "view", "downloaded").when(et == "click", "subsampled")
              .when(et == "purchase", "qc_done").when(et == "signup", "skipped_existing")
              .otherwise(F.concat(F.lit("failed: code "), k.cast("string"))))
    return e.select(
        stage.alias("stage"), _run_id(F.col("user_id")).alias("run_accession"),
        status.alias("status"), F.col("ts"), F.col("event_id"),
        F.when(et == "click", k * 10).cast("bigint").alias("original_reads"),
        F.when(et == "click", k).cast("bigint").alias("subsampled_reads"),
        F.when(et == "purchase", k * 10).cast("bigint").alias("total_reads_before"),
        F.when(et == "purchase", k).cast("bigint").alias("total_reads_after"),
    )


def file_listing(spark, sf_dir) -> DataFrame:
    """Raw read-file listing derived from orders (one row per file name).

    Layout by key % 4: paired plain, single plain, paired gz, single gz;
    keys % 3 == 0 also get a single gz file (precedence is exercised);
    keys % 7 == 0 lose their mate-2 file (broken pair falls through);
    keys % 11 == 0 have no files at all.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    k = F.col("o_orderkey")
    run = _run_id(k)
    names = F.array(
        F.when(k % 4 == 0, F.concat(run, F.lit("_1.fastq"))),
        F.when((k % 4 == 0) & (k % 7 != 0), F.concat(run, F.lit("_2.fastq"))),
        F.when(k % 4 == 1, F.concat(run, F.lit(".fastq"))),
        F.when(k % 4 == 2, F.concat(run, F.lit("_1.fastq.gz"))),
        F.when((k % 4 == 2) & (k % 7 != 0), F.concat(run, F.lit("_2.fastq.gz"))),
        F.when((k % 4 == 3) | (k % 3 == 0), F.concat(run, F.lit(".fastq.gz"))),
    )
    return (o.filter(k % 11 != 0)
             .select(F.explode(names).alias("file_name"))
             .filter(F.col("file_name").isNotNull()))


def reads(spark, sf_dir) -> DataFrame:
    """Paired reads D2: run R<user_id>, record = event_id, mates 1 and 2.

    Mate 2 is missing for error events (mates of unequal length)."""
    e = table(spark, sf_dir, "events")
    m = F.explode(F.when(F.col("event_type") == "error", F.array(F.lit(1)))
                  .otherwise(F.array(F.lit(1), F.lit(2)))).alias("mate")
    base = e.select(_run_id(F.col("user_id")).alias("run_accession"),
                    F.col("event_id").alias("rec_id"), F.col("value"), F.col("event_type"), m)
    seq = F.upper(F.substring(F.sha1(F.concat_ws(":", "rec_id", "mate")), 1, 16))
    return base.select(
        "run_accession", F.col("mate").cast("int").alias("mate"), "rec_id",
        F.concat(F.lit("@"), F.col("rec_id").cast("string"), F.lit("/"),
                 F.col("mate").cast("string")).alias("header"),
        F.translate(seq, "0123456789ABCDEF", "ACGTACGTACGTACGT").alias("seq"),
        F.lit("+").alias("plus"),
        F.translate(seq, "0123456789ABCDEF", "IIIIHHHH@@@@####").alias("qual"))


def scores(spark, sf_dir) -> DataFrame:
    """Binary scores: y = purchase/click, score = value/(value+50) in (0,1)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("grp"),
        F.when(F.col("event_type").isin("purchase", "click"), 1).otherwise(0).alias("y"),
        (F.col("value") / (F.col("value") + F.lit(50.0))).alias("score"))


def bracken_tables(spark, sf_dir) -> DataFrame:
    """Per-run abundance estimate rows (the files combined by S3)."""
    s = _run_shares(spark, sf_dir).filter(F.col("code") == "S")
    q = s.q.cast("bigint")
    return s.select(_run_id(s.o_orderkey).alias("run_accession"), F.col("taxon").alias("name"),
                    s.taxid.alias("taxonomy_id"), F.lit("S").alias("taxonomy_lvl"),
                    q.alias("kraken_assigned_reads"), F.lit(0).cast("bigint").alias("added_reads"),
                    q.alias("new_est_reads"), (s.q / s.total).alias("fraction_total_reads"))
