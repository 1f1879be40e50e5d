"""Preparing, profiling and exploring tables with Spark."""

from .operators.derive import FeatureRule
from .operators.filters import RowFilter
from .plans.plan import FittedPlan, Plan, Stages
from .sources.readers import load_table
from .sources.samples import load_sample
from .sources.writers import write_csv

__all__ = ["FeatureRule", "FittedPlan", "Plan", "RowFilter", "Stages", "load_sample", "load_table", "write_csv"]
