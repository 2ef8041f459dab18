"""Joins of a large table to a per-key table when one key may hold much of it.

A frequent-items sketch over the keys of the large table (one aggregation, no
shuffle of keys) says which keys are heavy and how many rows they have.  The
rows of a heavy key are dealt over so many parts as they need; the per-key
table repeats that key's rows once for each part.  Keys that are not heavy are
joined as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of one key that one part takes at most.
ROWS_PER_PART = 2_000_000
#: A key is heavy from this share of a shuffle partition's fair share on.
SHARE = 0.5
#: Heavy keys that the sketch reports at most, the heaviest first.
HEAVY_KEYS = 1024


def heavy_parts(df: DataFrame, keys: Sequence[str], rows_per_part: int = ROWS_PER_PART) -> dict[int, int]:
    """Parts for each heavy key of ``df``, by the 64-bit hash of the key.

    Parts grow with the rows of a key: one for each ``rows_per_part`` rows, and
    one for each ``SHARE`` of what a shuffle partition would hold on average.
    At most ``HEAVY_KEYS`` entries come to the driver.
    """
    spark = df.sparkSession
    found = df.select(F.xxhash64(*[f"`{k}`" for k in keys]).alias("h")).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(h, {HEAVY_KEYS}, {64 * HEAVY_KEYS})").alias("top")).first()
    fair = SHARE * found["n"] / max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    target = max(1.0, min(float(rows_per_part), fair))
    return {r["item"]: int(-(-r["count"] // target)) for r in found["top"] if r["count"] > target}


def salted_join(big: DataFrame, per_key: DataFrame, key: str | Sequence[str], how: str = "inner",
                rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Join ``big`` to ``per_key`` on ``key`` with the rows of heavy keys dealt over several partitions.

    A row's part is a hash of its values, so retries deal it alike.  ``how`` is
    a join that keeps rows of ``big`` (inner, left, left_semi, left_anti).
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a salted join cannot be {how}")
    keys = [key] if isinstance(key, str) else list(key)
    heavy = heavy_parts(big, keys, rows_per_part)
    if not heavy:
        return big.join(per_key, keys, how)
    # As many rows as there are heavy keys.
    table = F.broadcast(big.sparkSession.createDataFrame(list(heavy.items()), "__heavy long, __parts int"))

    def parted(df: DataFrame) -> DataFrame:
        code = F.xxhash64(*[f"`{k}`" for k in keys])
        return df.withColumn("__code", code).join(table, F.col("__code") == F.col("__heavy"), "left")
    dealt = parted(big).withColumn("__part", F.pmod(F.xxhash64(*[f"`{c}`" for c in big.columns]),
                                                    F.coalesce("__parts", F.lit(1))).cast("int"))
    copies = parted(per_key).withColumn("__part", F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1)))
    own = [c for c in per_key.columns if c not in keys]
    return (dealt.drop("__code", "__heavy", "__parts")
            .join(copies.select(*[f"`{c}`" for c in keys + own], "__part"), [*keys, "__part"], how).drop("__part"))
