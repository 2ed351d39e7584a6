"""Joins: validated lookups, exclusions, previous year, latest record, date range, membership."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique_on(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`df` unchanged, failing inside the query if a key occurs twice.

    The check is an aggregation on the join keys, so the join after it needs no further shuffle.
    """
    values = [c for c in df.columns if c not in keys]
    counted = df.groupBy(*keys).agg(
        F.count("*").alias("_rows"), *[F.any_value(c).alias(c) for c in values]
    )
    message = F.lit(f"more than one row per {', '.join(keys)}")
    first = keys[0]
    return counted.withColumn(
        first, F.when(F.col("_rows") > 1, F.raise_error(message)).otherwise(F.col(first))
    ).select(*df.columns)


def splittable(lookup: DataFrame, on: Sequence[str]) -> DataFrame:
    """The lookup, shuffled anew for a join with rows that may share one hot key.

    AQE splits a hot partition only if both sides of the join come straight from a shuffle. A
    lookup grouped by the join keys would reuse its grouping's shuffle and so prevent that;
    rewriting the first key (to the same value) makes Spark shuffle the few grouped rows again.
    """
    first = on[0]
    kind = dict(lookup.dtypes)[first]
    same = F.concat(first, F.lit("")) if kind == "string" else F.col(first).cast("string").cast(kind)
    return lookup.withColumn(first, same)


def attach(base: DataFrame, lookup: DataFrame, on: Sequence[str], check: bool = True, hot: bool = False) -> DataFrame:
    """Left join to a lookup with one row per key: row count of `base` is kept.

    `check=False` skips the test for lookups that are grouped by `on` already, `hot=True` is for
    a `base` with many rows per key.
    """
    on = list(on)
    repeated = (set(base.columns) & set(lookup.columns)) - set(on)
    if repeated:
        raise ValueError(f"columns on both sides: {sorted(repeated)}")
    lookup = unique_on(lookup, on) if check else lookup
    return base.join(splittable(lookup, on) if hot else lookup, on, "left")


def without_listed(df: DataFrame, listed: DataFrame, column: str) -> DataFrame:
    """Rows whose value is not in the list; a null matches a null in the list."""
    values = listed.select(F.col(column).alias("_listed")).distinct()
    return df.join(values, df[column].eqNullSafe(values["_listed"]), "left_anti")


def membership(df: DataFrame, listed: DataFrame, on: Sequence[str], name: str, yes: str, no: str) -> DataFrame:
    """Label rows by whether their key is in `listed`; nulls never match."""
    on = list(on)
    marks = listed.select(*on).dropna().distinct().withColumn("_found", F.lit(True))
    return (
        df.join(splittable(marks, on), on, "left")
        .withColumn(name, F.when(F.col("_found"), yes).otherwise(no))
        .drop("_found")
    )


def only_listed(df: DataFrame, listed: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(splittable(listed.select(*on), on), list(on), "left_semi")


def previous_year(df: DataFrame, lookup: DataFrame, on: Sequence[str], years: int = 1, how: str = "left") -> DataFrame:
    """Join each row to the lookup's row of `years` fiscal years before."""
    shifted = lookup.withColumn("fiscal", F.col("fiscal") + years)
    return df.join(shifted, ["fiscal", *on], how)


def latest_rows(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """All rows at their key's last date.

    The join back is on key and date, so a hot key is spread over its dates.
    """
    last = df.groupBy(*keys).agg(F.max(date).alias(date))
    return df.join(last, [*keys, date], "left_semi")


def one_row_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first whole row per key in a stated order, as one grouped minimum.

    `order` must be sortable ascending; ties are broken by all columns as listed.
    """
    rest = [c for c in df.columns if c not in keys]
    ranks = [c.alias(f"_o{i}") for i, c in enumerate(order)]
    # A leading is-null flag per column puts missing values last.
    ties = [x for c in rest for x in (F.col(c).isNull().alias(f"_n_{c}"), F.col(c).alias(c))]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*ranks, *ties)).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def within_last_year(daily: DataFrame, keys: DataFrame, date: str, last: str) -> DataFrame:
    """Rows dated in the year up to each key's own last date, both ends included.

    Feed it rows already summed per key and day: then no key holds more rows than days.
    """
    joined = daily.join(keys, "key")
    return joined.where(
        (F.col(date) >= F.add_months(F.col(last), -12)) & (F.col(date) <= F.col(last))
    )


def with_calendar(groups: DataFrame, first_day: str, last_day: str, name: str) -> DataFrame:
    """Every group on every day, generated row by row (no join)."""
    days = F.sequence(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))
    return groups.select("*", F.explode(days).alias(name))
