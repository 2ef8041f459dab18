"""Feature-building parameters (the data parameters of the reference)."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values that must equal the reference for equal results.
DEFAULT_EXCLUDED_TAXA = ("homo", "homo sapiens")
DEFAULT_PANEL = ("Fusobacterium nucleatum",)
DEFAULT_FOCAL_SPECIES = "Fusobacterium nucleatum"
DEFAULT_FOCAL_GENUS = "Fusobacterium"
DEFAULT_DOMAIN = "Bacteria"
DEFAULT_PSEUDOCOUNT = 1e-6
DEFAULT_PRESENCE_THRESHOLD = 1e-4
DEFAULT_SEED = 42
DEFAULT_DECISION_THRESHOLD = 0.5


@dataclass(frozen=True)
class FeatureConfig:
    panel_taxa: tuple[str, ...] = DEFAULT_PANEL
    excluded_taxa: tuple[str, ...] = DEFAULT_EXCLUDED_TAXA
    focal_species: str = DEFAULT_FOCAL_SPECIES
    focal_genus: str = DEFAULT_FOCAL_GENUS
    domain: str = DEFAULT_DOMAIN
    pseudocount: float = DEFAULT_PSEUDOCOUNT
    presence_threshold: float = DEFAULT_PRESENCE_THRESHOLD
    auto_panel_top_n: int = 0
    auto_panel_levels: str = "both"          # both | species | genus
    auto_panel_metric: str = "mean_x_prevalence"  # | mean_abundance | prevalence
    seed: int = DEFAULT_SEED

    def __post_init__(self):
        # YAML 1.1 reads "1e-6" as a string; accept both forms.
        object.__setattr__(self, "pseudocount", float(self.pseudocount))
        object.__setattr__(self, "presence_threshold", float(self.presence_threshold))
        object.__setattr__(self, "panel_taxa", tuple(self.panel_taxa))
        object.__setattr__(self, "excluded_taxa", tuple(self.excluded_taxa))
