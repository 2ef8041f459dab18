"""Composite feature plans (the reference's ``features`` command as one DAG)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from cohortlens.config import FeatureConfig
from cohortlens.operators import abundance as ab
from cohortlens.operators import panel as pn
from cohortlens.operators.features import targeted_features


@dataclass
class FeatureOutputs:
    targeted: DataFrame
    panel_records: DataFrame
    panel: list[str]
    long: DataFrame

    def matrix(self) -> DataFrame:
        """Full sample x taxon matrix (wide; one extra job for the header)."""
        return ab.abundance_matrix(self.long)


def build_features(md: DataFrame, species: DataFrame | None, genus: DataFrame | None,
                   reports: DataFrame | None, qc_docs: DataFrame | None,
                   cfg: FeatureConfig) -> FeatureOutputs:
    """Clean long abundance -> auto panel -> merged panel -> targeted matrix.

    ``md`` must already be cleaned (``clean_metadata``).  The only driver
    round trip is the merged panel (config taxa + at most top_n picks)."""
    spark = md.sparkSession
    long = ab.exclude_taxa(ab.abundance_long(species, genus, spark), cfg.excluded_taxa)
    picks = pn.auto_panel(long, cfg.auto_panel_top_n, cfg.auto_panel_levels, cfg.auto_panel_metric)
    panel = pn.panel_list(spark, cfg.panel_taxa, picks, cfg.excluded_taxa)
    targeted = targeted_features(md, long, reports, qc_docs, panel, cfg.focal_species,
                                 cfg.focal_genus, cfg.domain, cfg.pseudocount,
                                 cfg.presence_threshold)
    return FeatureOutputs(targeted=targeted, panel_records=picks, panel=panel, long=long)
