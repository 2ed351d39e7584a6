"""Wide to long, long to wide, one-hot columns, stacking and key-set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_long(df: DataFrame, ids: Sequence[str], name: str = "variable", value: str = "value") -> DataFrame:
    columns = [c for c in df.columns if c not in ids]
    return df.unpivot(list(ids), columns, name, value)


def to_wide(long: DataFrame, ids: Sequence[str], name: str, value: str, names: Sequence[str]) -> DataFrame:
    """One column per given name; naming them spares Spark a pass to find them."""
    return long.groupBy(*ids).pivot(name, list(names)).agg(F.first(value, ignorenulls=True))


def one_hot(df: DataFrame, categories: dict[str, Sequence[str]]) -> DataFrame:
    """Replace each column by 0/1 columns `column_value`; null gives zeros in all of them."""
    kept = [F.col(c) for c in df.columns if c not in categories]
    flags = [
        F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}")
        for c, values in categories.items()
        for v in values
    ]
    return df.select(*kept, *flags)


def align_columns(df: DataFrame, like: DataFrame) -> DataFrame:
    """Exactly the columns of `like` in its order: missing ones as null, others dropped."""
    present = set(df.columns)
    return df.select(*[
        F.col(f"`{c}`") if c in present else F.lit(None).cast(t).alias(c) for c, t in like.dtypes
    ])


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def common_keys(frames: Sequence[DataFrame], key: str = "key") -> DataFrame:
    """Distinct keys that occur in every frame."""
    return reduce(DataFrame.intersect, [f.select(key) for f in frames])


def array_to_rows(df: DataFrame, key: str, array: str, position: str, value: str) -> DataFrame:
    return df.select(F.col(key), F.posexplode(array).alias(position, value))


def distinct_choices(df: DataFrame, column: str, **chosen) -> DataFrame:
    """Distinct values of a column under the choices made so far."""
    return lookup(df, **chosen).select(column).distinct()


def lookup(df: DataFrame, **chosen) -> DataFrame:
    """Rows equal to every given value."""
    return reduce(lambda d, item: d.where(F.col(item[0]) == F.lit(item[1])), chosen.items(), df)
