"""Few documents over many shuffle partitions: few tasks write them, and stars need one round."""

from pyspark.sql import functions as F

from cohortlens.llm import components as comp
from cohortlens.llm.jaccard_join import ALL, signatures
from cohortlens.llm.shared import LEAST_PARTITIONS, gathered

MANY = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


def with_conf(spark, conf, run):
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return run()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_signatures_of_few_documents_are_few_files(spark, make_docs):
    docs = make_docs([(i, f"w{i} w{i + 1} w{i + 2} w{i + 3}") for i in range(150)], 60)
    signs = with_conf(spark, MANY, lambda: signatures(docs, 3, 90, 100, ALL))
    assert signs.measured["n"] == signs.count() == 150
    assert signs.select(F.input_file_name()).distinct().count() <= LEAST_PARTITIONS


def test_gathered_keeps_the_rows_and_many_partitions_of_many_rows(spark):
    df = spark.range(0, 5000, 1, 100)
    assert gathered(df, 5000).rdd.getNumPartitions() == LEAST_PARTITIONS
    assert gathered(df, 5000, 100).rdd.getNumPartitions() == 50
    assert gathered(df, 10 ** 9).rdd.getNumPartitions() == 100
    assert gathered(df, 5000).agg(F.sum("id")).first()[0] == 5000 * 4999 // 2


def test_stars_end_after_one_round_and_chains_later(spark, monkeypatch):
    rounds = []
    stash = comp.stash
    monkeypatch.setattr(comp, "stash", lambda *a, **b: rounds.append(1) or stash(*a, **b))
    star = [(1, x) for x in range(2, 9)] + [(20, 10), (20, 10), (None, 3), (4, 4)]
    got = {tuple(r) for r in comp.components(spark.createDataFrame(star, "a long, b long")).collect()}
    assert got == {(x, 1) for x in range(1, 9)} | {(10, 10), (20, 10)}
    assert len(rounds) == 1
    chain = [(x, x + 1) for x in range(30)] + [(50, 40), (50, 45)]
    got = {tuple(r) for r in comp.leaves(spark.createDataFrame(chain, "a long, b long"), len(chain)).collect()}
    assert got == {(x, 0) for x in range(1, 31)} | {(45, 40), (50, 40)}
