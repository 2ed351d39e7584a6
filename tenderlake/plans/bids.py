"""Cleaned bid table and the key tables with the award price as target."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.fixed_values import AWARD_PRICE_LIMIT, SERVED_BID_TYPES
from tenderlake.functions.aggregates import first_non_null
from tenderlake.functions.columns import bid_key
from tenderlake.operators.joins import without_listed


def intermediate_bids(raw: DataFrame, unserved: DataFrame) -> DataFrame:
    """Offers of served bid types and zips under the outlier limit, with their bid key.

    One row per (key, competitor offer). A missing award price does not pass the limit.
    """
    offers = (
        raw.where(F.col("bid_type_name").isin(SERVED_BID_TYPES))
        .where(F.col("award_price_ty") < AWARD_PRICE_LIMIT)
        .withColumn("key", bid_key())
        .where(F.col("key").isNotNull())
    )
    return without_listed(offers, unserved, "destination_zip_postal")


def _award_rows(bids: DataFrame) -> DataFrame:
    """One row per bid line: first award price and first due date, smallest pair first."""
    rows = bids.where(F.col("award_price_ty") > 0).select(
        "fiscal", "destination_no", "bid_line_no", "key",
        F.col("award_price_ty").alias("target"), F.col("bid_due_date").alias("date"),
    )
    # The key holds the line's parts, so grouping by it alone leaves the table partitioned for the
    # feature joins.
    order = ["target", "date"]
    first = rows.groupBy("key").agg(
        *[F.any_value(c).alias(c) for c in ("fiscal", "destination_no", "bid_line_no")],
        *[first_non_null(c, order).alias(c) for c in order],
    )
    return first.select("fiscal", "destination_no", "bid_line_no", "date", "key", "target")


def target_table(bids: DataFrame, reference_year: int) -> DataFrame:
    """Key table for training: first due date up to the reference year."""
    return _award_rows(bids).where(F.year("date") <= reference_year)


def scoring_table(bids: DataFrame, scoring_year: int) -> DataFrame:
    """Key table for scoring: first due date in the scoring year."""
    return _award_rows(bids).where(F.year("date") == scoring_year)
