"""cohortlens: cohort feature analytics expressed as Spark DataFrame plans.

Every public operator takes and returns lazy DataFrames.  The only driver
round-trips are bounded by configuration size (panel picks, pivot column
lists, model coefficients), never by the number of runs or reads.
"""

from cohortlens.config import FeatureConfig
from cohortlens.session import get_spark, checkpoint_dir

__all__ = ["FeatureConfig", "get_spark", "checkpoint_dir"]
