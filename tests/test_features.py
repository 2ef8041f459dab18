import math

from pyspark.sql import functions as F

from cohortlens.config import FeatureConfig
from cohortlens.operators import abundance as ab
from cohortlens.operators import panel as pn
from cohortlens.operators.features import detection_counts, focal_histogram
from cohortlens.plans.features import build_features

MD = "run_accession string, sample_id string, label string, age_group string, library_name string"
AB = "run_accession string, sample_id string, name string, fraction_total_reads double"
REP = "run_accession string, percentage double, clade_reads bigint, taxon_reads bigint, rank_code string, taxid bigint, name string"


def _md(spark, runs=("R1",)):
    return spark.createDataFrame([(r, "S" + r[1:], "cancer", "old", "L") for r in runs], MD)


def test_one_run_species_and_genus(spark):
    md = _md(spark)
    sp = spark.createDataFrame([("R1", "S1", "Fusobacterium nucleatum", 0.05)], AB)
    ge = spark.createDataFrame([("R1", "S1", "Fusobacterium", 0.10)], AB)
    rep = spark.createDataFrame([("R1", 50.0, 100, 100, "D", 2, "Bacteria"),
                                 ("R1", 5.0, 10, 10, "S", 851, "Fusobacterium nucleatum")], REP)
    docs = spark.createDataFrame([("R1", '{"summary": {"after_filtering": {"total_reads": 1234}}}')],
                                 "run_accession string, json string")
    cfg = FeatureConfig(panel_taxa=("Fusobacterium nucleatum", "Fusobacterium"))
    out = build_features(md, sp, ge, rep, docs, cfg)
    r = out.targeted.first()
    assert math.isclose(r.F_nucleatum_species_abundance, 0.05)
    assert math.isclose(r.Fusobacterium_genus_abundance, 0.10)
    assert math.isclose(r.total_bacterial_abundance, 0.5)
    assert r.number_of_detected_species == 1
    assert r.sequencing_depth_proxy == 1234
    assert math.isclose(r.panel_Fusobacterium, 0.10)
    assert math.isclose(r.panel_Fusobacterium_nucleatum_log10, math.log10(0.05 + 1e-6))
    assert r.panel_Fusobacterium_nucleatum_present == 1
    cols = out.targeted.columns
    assert cols[:11] == ["sample_id", "run_accession", "label", "age_group", "library_name",
                         "F_nucleatum_species_abundance", "Fusobacterium_genus_abundance",
                         "total_bacterial_abundance", "number_of_detected_species",
                         "Shannon_diversity", "sequencing_depth_proxy"]


def test_human_taxa_excluded_everywhere(spark):
    md = _md(spark)
    sp = spark.createDataFrame([("R1", "S1", "Homo sapiens", 0.9), ("R1", "S1", "  homo_SAPIENS ", 0.01),
                                ("R1", "S1", "Bacteroides fragilis", 0.1)], AB)
    ge = spark.createDataFrame([("R1", "S1", "Homo", 0.9), ("R1", "S1", "Bacteroides", 0.1)], AB)
    cfg = FeatureConfig(panel_taxa=("Homo sapiens", "Bacteroides"), auto_panel_top_n=4)
    out = build_features(md, sp, ge, None, None, cfg)
    assert not [c for c in out.targeted.columns if "omo" in c]
    assert "panel_Bacteroides" in out.targeted.columns
    mat = out.matrix()
    assert not [c for c in mat.columns if "omo" in c.lower()]


def test_genus_fallback_and_species_precedence(spark):
    md = _md(spark, ("R1", "R2", "R3"))
    sp = spark.createDataFrame([
        ("R1", "S1", "Alpha beta", 0.2), ("R1", "S1", "Alpha gamma", 0.3),  # R1: no genus rows
        ("R2", "S2", "Alpha", 0.0),                                          # species row 0 hides genus
    ], AB)
    ge = spark.createDataFrame([("R2", "S2", "Alpha", 0.4)], AB)
    cfg = FeatureConfig(panel_taxa=("Alpha",), focal_genus="Alpha")
    rows = {r.run_accession: r for r in build_features(md, sp, ge, None, None, cfg).targeted.collect()}
    assert math.isclose(rows["R1"].panel_Alpha, 0.5)             # fallback: first token summed
    assert math.isclose(rows["R1"].Fusobacterium_genus_abundance, 0.5)
    assert rows["R2"].panel_Alpha == 0.0                         # species key present with 0
    assert rows["R2"].panel_Alpha_present == 0
    assert math.isclose(rows["R2"].Fusobacterium_genus_abundance, 0.4)
    assert rows["R3"].panel_Alpha == 0.0                         # no abundance at all
    assert math.isclose(rows["R3"].panel_Alpha_log10, -6.0)
    assert rows["R3"].Shannon_diversity == 0.0


def test_threshold_inclusive_and_shannon(spark):
    md = _md(spark)
    sp = spark.createDataFrame([("R1", "S1", "A a", 0.5), ("R1", "S1", "B b", 0.5),
                                ("R1", "S1", "C c", 1e-4), ("R1", "S1", "D d", 0.0)], AB)
    cfg = FeatureConfig(panel_taxa=("C c",))
    r = build_features(md, sp, None, None, None, cfg).targeted.first()
    assert r.panel_C_c_present == 1
    expect = -(0.5 * math.log(0.5) * 2 + 1e-4 * math.log(1e-4))
    assert math.isclose(r.Shannon_diversity, expect, rel_tol=1e-12)
    assert r.number_of_detected_species == 3


def test_shannon_two_equal():
    assert 0.68 < math.log(2) < 0.70


def test_scores_and_auto_panel_split(spark):
    long = ab.abundance_long(
        spark.createDataFrame([("R1", "S1", "a x", 0.5), ("R2", "S2", "a x", 0.0), ("R1", "S1", "b y", 0.4),
                               ("R1", "S1", "c z", 0.1)], AB),
        spark.createDataFrame([("R1", "S1", "a", 0.6), ("R1", "S1", "b", 0.4)], AB))
    sc = {(r.level, r.taxon): r for r in ab.score_taxa(long).collect()}
    assert math.isclose(sc[("species", "a x")].mean_abundance, 0.25)
    assert math.isclose(sc[("species", "a x")].prevalence, 0.5)
    assert math.isclose(sc[("species", "a x")].score, 0.125)
    picks = pn.auto_panel(long, 3).orderBy("level", "rank").collect()
    assert [(p.level, p.taxon, p.rank) for p in picks] == [("genus", "a", 1), ("species", "b y", 1),
                                                            ("species", "a x", 2)]
    only_species = long.filter(F.col("level") == "species")
    assert pn.auto_panel(only_species, 3).count() == 3
    assert pn.auto_panel(long, 3, levels="genus").count() == 2
    merged = pn.panel_list(spark, ["a", "zzz"], pn.auto_panel(long, 3), ["zzz"])
    assert merged == ["a", "b y", "a x"]


def test_matrix_sums_runs_of_a_sample_and_levels(spark):
    long = ab.abundance_long(
        spark.createDataFrame([("R1", "S1", "t", 0.2), ("R2", "S1", "t", 0.3)], AB),
        spark.createDataFrame([("R1", "S1", "t", 0.1), ("R3", "S2", "u", 0.7)], AB))
    m = {r.sample_id: r for r in ab.abundance_matrix(long).collect()}
    assert math.isclose(m["S1"].t, 0.6) and m["S1"].u == 0.0 and math.isclose(m["S2"].u, 0.7)


def test_detection_counts_and_histogram(spark):
    df = spark.createDataFrame([(0.0, 1, 0), (0.5, 1, 1), (1.0, 0, 1), (1.0, 1, 1)],
                               "F_nucleatum_species_abundance double, panel_a_present int, panel_b_present int")
    dc = [(r.feature, r.detected) for r in detection_counts(df).collect()]
    assert dc == [("panel_a_present", 3), ("panel_b_present", 3)]
    h = {r.bin: r["count"] for r in focal_histogram(df).collect()}
    assert len(h) == 20 and h[1] == 1 and h[11] == 1 and h[20] == 2
    const = spark.createDataFrame([(0.0,), (0.0,)], "F_nucleatum_species_abundance double")
    hc = {r.bin: r["count"] for r in focal_histogram(const).collect()}
    assert hc[11] == 2 and sum(hc.values()) == 2


def test_sparse_vectors_equal_the_wide_matrix(spark):
    from cohortlens.operators import abundance as ab
    rows = [(f"S{i % 5}", f"R{i}", "species", f"taxon {i * 7 % 11}" if i % 9 else "Ärt", i / 10) for i in range(60)]
    rows += [("S9", "R99", "genus", "only", None), ("S9", "R99", "genus", None, 1.0)]
    long = spark.createDataFrame(rows, "sample_id string, run_accession string, level string, taxon string, relative_abundance double")
    numbers = {r.taxon: r.number for r in ab.taxon_numbers(long).collect()}
    assert sorted(numbers, key=lambda t: t.encode()) == sorted(numbers, key=numbers.get) and set(numbers.values()) == set(range(len(numbers)))
    wide = {r["sample_id"]: r for r in ab.abundance_matrix(long.where("taxon is not null"), sorted(numbers)).collect()}
    for r in ab.abundance_vectors(long).collect():
        held = dict(zip(r.indices, r["values"]))
        assert list(r.indices) == sorted(held)
        for taxon, i in numbers.items():
            assert abs(wide[r.sample_id][taxon] - held.get(i, 0.0)) < 1e-12
