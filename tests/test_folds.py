import hashlib

from cohortlens.operators.folds import assign_folds


def test_folds_of_many_buckets_are_the_md5_order(spark):
    df = spark.range(3000).selectExpr("concat('R', id) as run_accession", "cast(id % 3 = 0 as int) as y")
    got = {(r.run_accession, r.repeat): r.fold for r in assign_folds(df, 5, 2, 42, rows_per_bucket=200).collect()}
    for repeat in (0, 1):
        for y in (0, 1):
            runs = [f"R{i}" for i in range(3000) if (i % 3 == 0) == bool(y)]
            runs.sort(key=lambda r: (hashlib.md5(f"42:{repeat}:{r}".encode()).hexdigest(), r))
            assert [got[r, repeat] for r in runs] == [i % 5 for i in range(len(runs))]
