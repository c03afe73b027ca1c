"""Aggregates that the engine has no name for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_unit_range(confidence: Column) -> Column:
    """The confidence; out of [0, 1] is an error."""
    return F.when(confidence.between(0.0, 1.0) | confidence.isNull(), confidence).otherwise(F.raise_error(F.concat(F.lit("confidence out of range: "), confidence.cast("string"))).cast("double"))


def noisy_or(confidence: Column) -> Column:
    """Chance that at least one of independent observations is right; 0.0 for none; out of [0, 1] is an error."""
    return F.coalesce(1.0 - F.product(1.0 - in_unit_range(confidence)), F.lit(0.0))


def slope(y: Column, x: Column) -> Column:
    """Least-squares slope; 0.0 for fewer than two points or equal x."""
    fitted = F.regr_slope(y.cast("double"), x.cast("double"))
    return F.when(F.isnan(fitted), F.lit(0.0)).otherwise(F.coalesce(fitted, F.lit(0.0)))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0.0 where whole is zero."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))
