"""Bid CSV import: text columns to typed, cleaned columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.fixed_values import (
    CSV_TIMESTAMP_FORMATS, DATE_COLUMNS, FLAG_COLUMNS, INT_COLUMNS, NUMBER_COLUMNS, TEXT_COLUMNS,
)
from tenderlake.functions.columns import day_month_year, lenient_double, lenient_int, plain_e, yes_no


def read_bid_csvs(spark: SparkSession, folder: str, encoding: str = "UTF-8") -> DataFrame:
    """All CSV files of a folder stacked, every column as text.

    Headers are checked file by file, so a file with other columns fails instead of shifting values.
    """
    return (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("encoding", encoding)
        .option("pathGlobFilter", "*.csv")
        .csv(folder)
    )


def clean_names(df: DataFrame) -> DataFrame:
    """Hash signs to NO, then lower case."""
    return df.toDF(*[c.replace("#", "NO").lower() for c in df.columns])


def typed_bids(df: DataFrame) -> DataFrame:
    """Cast the known text columns in one projection; bad values become null, others stay as they are."""
    casts = {
        **{c: lenient_int for c in INT_COLUMNS},
        **{c: lenient_double for c in NUMBER_COLUMNS},
        **{c: plain_e for c in TEXT_COLUMNS},
        **{c: yes_no for c in FLAG_COLUMNS},
        **{c: (lambda x: day_month_year(x, CSV_TIMESTAMP_FORMATS)) for c in DATE_COLUMNS},
    }
    named = clean_names(df)
    return named.select(*[casts[c](c).alias(c) if c in casts else F.col(c) for c in named.columns])


def import_bids(spark: SparkSession, folder: str, encoding: str = "UTF-8") -> DataFrame:
    return typed_bids(read_bid_csvs(spark, folder, encoding))
