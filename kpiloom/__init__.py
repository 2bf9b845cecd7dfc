"""kpiloom — cohort KPI operators on Spark DataFrames.

Every metric is an integer numerator (and, where it has one, a denominator)
per cohort cell, so ratios roll up exactly from site to region to national.
Operators take and return lazy DataFrames built from Spark SQL expressions;
Catalyst and AQE choose the physical plan.
"""

from kpiloom.operators.cohort import CohortSpec  # noqa: F401

__all__ = ["CohortSpec"]
