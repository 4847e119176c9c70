"""Relational operators built from DataFrame compositions."""

from strata.operators.dedup import first_occurrence, latest_by  # noqa: F401
from strata.operators.aggregates import exact_median, activity_metrics  # noqa: F401
