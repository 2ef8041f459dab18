"""Registered queries: one per operator of the inventory.

Each entry is ``name -> (callable(spark, sf_dir) -> DataFrame, oracle SQL or
None)``.  Callables read the driver's tables through the bindings, run the
operator on the whole tables, and round DOUBLE columns to 6 digits so the
result is comparable across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions.columns import round_doubles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(spark, sf_dir), 6)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def _load_all():
    # Importing the modules fills the registry.
    from cohortlens.plans import q_features, q_files, q_stages, q_reads, q_stats, q_models  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLE)
