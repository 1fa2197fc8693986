"""Regression metrics as aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _squared_error(label: Column, prediction: Column) -> Column:
    return F.pow(label - prediction, 2)


def rmse(label: Column, prediction: Column) -> Column:
    return F.sqrt(F.avg(_squared_error(label, prediction)))


def r2(label: Column, prediction: Column) -> Column:
    """Share of the label's variance that is explained; NaN or -infinity for a constant label."""
    residual = F.sum(_squared_error(label, prediction))
    total = F.var_pop(label) * F.count(label)
    constant = F.when(residual > 0, F.lit(float("-inf"))).otherwise(F.lit(float("nan")))
    return F.when(total > 0, F.lit(1.0) - residual / total).otherwise(constant)
