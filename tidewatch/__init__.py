"""Drift and trend analytics for models in production, on Spark DataFrames.

Every public operator takes DataFrames and returns DataFrames.  Nothing here collects rows to the
driver except bounded metadata (category lists of a capped size, a verdict row).
"""

from tidewatch.config import FeatureSchema, load_schema
from tidewatch.session import build_session

__all__ = ["FeatureSchema", "load_schema", "build_session"]
