"""Small expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_sql(top: str, bottom: str) -> str:
    """``top / bottom`` where ``bottom`` is positive, else NULL. Safe under ANSI mode."""
    return f"CASE WHEN {bottom} > 0 THEN {top} / {bottom} END"


def scaled_sql(value: str, low: str, high: str) -> str:
    """Min-max scaling; the small term keeps a constant column at 0 instead of dividing by zero."""
    return f"({value} - {low}) / ({high} - {low} + 1e-9D)"


def finite_or_zero(c: Column) -> Column:
    """NULL, NaN and infinities become 0.0 (NaN orders above infinity, so one test covers all)."""
    return F.when(F.abs(c) < F.lit(float("inf")), c).otherwise(F.lit(0.0))
