"""Feature panel: automatic picks per level and ordered merge with the config."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.operators.abundance import is_excluded, score_taxa

PANEL_SCHEMA = "level string, taxon string, metric string, score double, rank int"


def auto_panel(long: DataFrame, n: int, levels: str = "both",
               metric: str = "mean_x_prevalence") -> DataFrame:
    """Top-n taxa per level by score (desc), taxon (asc); rank from 1.

    Each level's n best come from a distributed top-n (no window over the
    taxa); the split ceil(n/2) / floor(n/2) is decided on those 2n rows, in
    which a level is present exactly when it has taxa."""
    spark = long.sparkSession
    if n <= 0:
        return spark.createDataFrame([], PANEL_SCHEMA)
    forced = levels in ("species", "genus")
    wanted = [levels] if forced else ["species", "genus"]
    tops = [score_taxa(long.filter(F.col("level") == level), metric)
            .orderBy(F.col("score").desc(), F.col("taxon").asc()).limit(n) for level in wanted]
    best = tops[0]
    for t in tops[1:]:
        best = best.unionByName(t)
    w = Window.partitionBy("level").orderBy(F.col("score").desc(), F.col("taxon").asc())
    present = F.size(F.collect_set("level").over(Window.partitionBy()))
    limit = (F.when(present < 2, F.lit(n))
             .when(F.col("level") == "species", F.lit(int(math.ceil(n / 2))))
             .otherwise(F.lit(int(math.floor(n / 2)))))
    ranked = best.withColumn("rank", F.row_number().over(w)).withColumn("__limit", limit)
    return (ranked.filter(F.col("rank") <= F.col("__limit"))
                  .select("level", "taxon", F.lit(metric).alias("metric"),
                          F.col("score").cast("double").alias("score"),
                          F.col("rank").cast("int").alias("rank")))


def merge_panel(spark, config_taxa: Sequence[str], picks: DataFrame,
                excluded: Sequence[str]) -> DataFrame:
    """Config taxa first, then species picks, then genus picks; first
    occurrence kept; excluded names dropped.  Returns (position, taxon)."""
    cfg = [t for t in config_taxa if not is_excluded(t, excluded)]
    base = spark.createDataFrame([(0, i, t) for i, t in enumerate(cfg)], "part int, place int, taxon string")
    dyn = picks.select(F.when(F.col("level") == "species", 1).otherwise(2).alias("part"),
                       F.col("rank").alias("place"), "taxon")
    from cohortlens.operators.abundance import exclude_taxa
    dyn = exclude_taxa(dyn, excluded)
    merged = base.unionByName(dyn).groupBy("taxon").agg(F.min(F.struct("part", "place")).alias("pos"))
    w = Window.orderBy("pos")  # panel-sized: a handful of rows
    return merged.select(F.row_number().over(w).alias("position"), "taxon")


def panel_list(spark, config_taxa, picks: DataFrame, excluded) -> list[str]:
    """The merged panel as a Python list (bounded by config size + n)."""
    rows = merge_panel(spark, config_taxa, picks, excluded).orderBy("position").collect()
    return [r["taxon"] for r in rows]
