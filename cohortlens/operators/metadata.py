"""Cohort metadata: validation, cleaning, run subsets, first row per key."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.columns import trim_ws

REQUIRED_METADATA_COLUMNS = ("run_accession", "sample_id", "label", "age_group")
# Lists up to this size are inlined as IN (...); longer ones become a semi join.
INLINE_LIST_MAX = 1000


def require_columns(df: DataFrame, required: Sequence[str], what: str = "Metadata") -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{what} missing required columns: {missing}")


def first_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """Keep the first row (smallest ``order_cols``) of every key.

    Expressed as ``min(struct(order, rest))`` so the aggregate is partial on
    the map side: a key holding a third of all rows is combined per task
    before the shuffle instead of being sorted inside one task.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    packed = F.struct(*[F.col(c) for c in list(order_cols) + rest])
    out = df.groupBy(*keys).agg(F.min(packed).alias("__first"))
    return out.select(*[F.col(c) for c in df.columns if c in keys],
                      *[F.col(f"__first.{c}").alias(c) for c in df.columns if c not in keys])


def subset_runs(md: DataFrame, runs, key: str = "run_accession") -> DataFrame:
    """Keep runs from a list or a one-column DataFrame; empty list = all."""
    if runs is None:
        return md
    if isinstance(runs, DataFrame):
        other = runs.select(F.col(runs.columns[0]).alias(key)).distinct()
        return md.join(other, key, "left_semi")
    runs = list(runs)
    if not runs:
        return md
    if len(runs) <= INLINE_LIST_MAX:
        return md.filter(F.col(key).isin(runs))
    spark = md.sparkSession
    other = spark.createDataFrame([(r,) for r in runs], f"{key} string")
    return md.join(other, key, "left_semi")


def clean_metadata(md: DataFrame, runs: Iterable[str] | DataFrame | None = None,
                   order_col: str = "ordinal") -> DataFrame:
    """Trim, lower-case, drop incomplete rows, subset, keep first row per run.

    ``order_col`` is the file order; when absent one is attached from the
    scan (monotonic ids follow split order for a file scan).
    """
    require_columns(md, REQUIRED_METADATA_COLUMNS)
    if order_col not in md.columns:
        md = md.withColumn(order_col, F.monotonically_increasing_id())
    df = md.withColumns({
        "run_accession": trim_ws(F.col("run_accession").cast("string")),
        "sample_id": trim_ws(F.col("sample_id").cast("string")),
        "label": F.lower(trim_ws(F.col("label").cast("string"))),
        "age_group": F.lower(trim_ws(F.col("age_group").cast("string"))),
    })
    df = df.dropna(subset=list(REQUIRED_METADATA_COLUMNS)).filter(F.col("run_accession") != "")
    df = subset_runs(df, runs)
    return first_per_key(df, ["run_accession"], [order_col])


def first_runs(md: DataFrame, n: int, order_col: str = "ordinal") -> DataFrame:
    """First ``n`` runs in file order (a top-n, not a full sort)."""
    return md.orderBy(order_col).limit(int(n))
