"""Aggregates built from partial-aggregating built-ins, so hot groups shrink before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_non_null(column: str, order: Sequence[str]) -> Column:
    """First non-null value in the order of `order` (ascending, nulls first), then by value."""
    if column == order[0]:
        return F.min(column)
    fields = [*order] if column in order else [*order, column]
    ranked = F.struct(*[F.col(c).alias("_value" if c == column else c) for c in fields])
    return F.min(F.when(F.col(column).isNotNull(), ranked)).getField("_value")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per key; every other column takes its own first non-null value.

    Order columns default to all non-key columns as listed. Rows with a null key are left out.
    """
    values = [c for c in df.columns if c not in keys]
    order = list(order or values)
    return (
        df.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(*[first_non_null(c, order).alias(c) for c in values])
    )


def total(column: str) -> Column:
    """Sum that is zero, not null, when everything is missing."""
    return F.coalesce(F.sum(column), F.lit(0.0))


def single_valued(column: str) -> Column:
    """True if the group has exactly one distinct non-null value (no distinct pass needed)."""
    return F.coalesce(F.min(column) == F.max(column), F.lit(False))


def top_by(value: str, score: str) -> Column:
    """Value at the highest score, the smallest value on ties; null scores never win."""
    candidates = F.when(F.col(score).isNotNull(), F.struct((-F.col(score)).alias("s"), F.col(value).alias("v")))
    return F.min(candidates).getField("v")


def percentile(column: str, share: float) -> Column:
    """Exact percentile with linear interpolation."""
    return F.percentile(F.col(column).cast("double"), F.lit(share))


def error_metrics(prediction: str, actual: str) -> list[Column]:
    error = F.abs(F.col(prediction) - F.col(actual))
    share = F.avg(100 * F.try_divide(error, F.col(actual)))
    return [
        F.avg(error).alias("mae"),
        F.avg(error * error).alias("mse"),
        share.alias("mape"),
        (100 - share).alias("accuracy"),
    ]
