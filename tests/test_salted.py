from pyspark.sql import functions as F

from cohortlens.operators.salted import heavy_parts, salted_join


def rows(spark, n, hot=0.7):
    return spark.range(n).select(
        F.when(F.col("id") % 100 < int(100 * hot), "hot").when(F.col("id") % 100 == 99, F.lit(None).cast("string"))
        .otherwise(F.col("id").cast("string")).alias("run_accession"), F.col("id").alias("rec_id"))


def tasks_of_hot(spark, n):
    big = rows(spark, n)
    per_key = big.groupBy("run_accession").agg(F.count(F.lit(1)).alias("total"))
    joined = salted_join(big, per_key, "run_accession", rows_per_part=500)
    by_task = joined.filter("run_accession = 'hot'").groupBy(F.spark_partition_id().alias("t")).count().collect()
    return len(by_task), max(r["count"] for r in by_task)


def test_the_tasks_of_a_hot_run_grow_with_its_rows(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled",
                                          "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(old, ("-1", "false", "2"), strict=True):
            spark.conf.set(k, v)
        small, large = (heavy_parts(rows(spark, n), ["run_accession"], 500) for n in (4_000, 40_000))
        assert max(small.values()) == 6 and max(large.values()) == 56  # 2,800 and 28,000 rows of one run
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        few, most_few = tasks_of_hot(spark, 4_000)
        many, most_many = tasks_of_hot(spark, 40_000)
        assert few > 10 and many > 25 and most_many < 28_000 / 10 and most_few < 2_800 / 5
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_same_rows_as_a_plain_join(spark):
    big = rows(spark, 3_000)
    per_key = spark.createDataFrame([("hot", 1), ("80", 2), ("hot", 3), ("absent", 4), (None, 5)], "run_accession string, v int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        want = big.join(per_key, ["run_accession"], how)
        got = salted_join(big, per_key, "run_accession", how, rows_per_part=100)
        assert got.columns == want.columns
        key = lambda r: repr(tuple(r))
        assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)


def test_several_keys_and_no_heavy_one(spark):
    big = spark.range(50).select((F.col("id") % 7).alias("a"), (F.col("id") % 3).alias("b"), "id")
    small = big.groupBy("a", "b").agg(F.max("id").alias("m"))
    assert salted_join(big, small, ["a", "b"]).count() == 50
    assert heavy_parts(big.where("id < 0"), ["a"]) == {}
