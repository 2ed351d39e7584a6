"""Tables and lookups for the reporting dashboard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.fixed_values import (
    CATEGORY_AVERAGE, CATEGORY_HIGH, CATEGORY_LOW, PEER_COLUMNS, PERFORMANCE_HIGH, PERFORMANCE_LOW, REFERENCE_NAMES,
)
from tenderlake.functions.columns import cents, key_parts, percent_number
from tenderlake.operators.joins import splittable
from tenderlake.operators.reshape import common_keys, lookup
from tenderlake.operators.windows import win_probability
from tenderlake.plans.reference_table import ReferenceTables, expanded
from tenderlake.storage import materialize


def with_cluster(details: DataFrame, clustering: DataFrame) -> DataFrame:
    """Tag details by destination and bid line; `clustering` holds key and Cluster of one year."""
    _, destination, line = key_parts()
    tags = clustering.select(
        destination.alias("destination_no"), line.alias("bid_line_no"), "Cluster"
    ).distinct()
    # Written, so that Spark knows their size: the wide details are only shuffled for them if they are many.
    tags = materialize(tags, "cluster-tags", "zstd")
    line = ["destination_no", "bid_line_no"]
    return details.join(splittable(tags, line), line, "left")


def dashboard_keys(tables: Sequence[DataFrame], selected: Sequence[str] | None = None) -> DataFrame:
    """Keys that every table has, within an optional whitelist, with their parts."""
    if selected is not None:
        tables = [t.where(F.col("key").isin(list(selected))) for t in tables]
    return common_keys(tables).select("key", *key_parts())


def top_importance(importance: DataFrame, n: int = 5) -> DataFrame:
    """The n most important variables from the text importance table."""
    return (
        importance.select(
            F.col("Feature").alias("variable"), percent_number("`Relative Importance`").alias("importance")
        )
        .orderBy(F.col("importance").desc_nulls_last(), "variable")
        .limit(n)
    )


def price_by_category(prices: DataFrame) -> DataFrame:
    """Three rows per key: average, low and high price with their margins, to two decimals.

    Each row is expanded in place, so no grouping or shuffle is needed.
    """
    choices = [
        (CATEGORY_AVERAGE, "Predicted_price", "estimated_margin"),
        (CATEGORY_LOW, "error_down_95", "margin_lower"),
        (CATEGORY_HIGH, "error_up_95", "margin_upper"),
    ]
    rows = F.array(*[
        F.struct(
            F.lit(category).alias("Category"),
            cents(margin).alias("Margin"),
            cents(price).alias("Price"),
        )
        for category, price, margin in choices
    ])
    return prices.select("key", F.inline(rows)).select("*", *key_parts())


def reference_report(tagged: DataFrame) -> DataFrame:
    """Cluster-tagged details under their report headings, in report order."""
    return tagged.select(*[F.col(c).alias(heading) for c, heading in REFERENCE_NAMES.items()])


def performance_table(by_category: DataFrame) -> DataFrame:
    """Low and high categories relabelled; the headings are placeholders (label, margin, price)."""
    label = F.when(F.col("Category") == CATEGORY_HIGH, PERFORMANCE_HIGH).otherwise(PERFORMANCE_LOW)
    return by_category.where(F.col("Category") != CATEGORY_AVERAGE).select(
        "key",
        label.alias("Price"),
        F.col("Margin").alias("This Year"),
        F.col("Price").alias("Last Year"),
        "fiscal", "destination", "bidlineno",
    )


def win_probability_curve(tree_prices: DataFrame, **chosen) -> DataFrame:
    """Bid price against winning probability for the chosen fiscal, destination and bidlineno."""
    key = "_".join(str(chosen[part]) for part in ("fiscal", "destination", "bidlineno"))
    return win_probability(lookup(tree_prices, key=key)).select("win_probability", "price")


def similar_bids(report: DataFrame, year: int, fiscal: int, destination: str, bidlineno: int, n: int = 5) -> DataFrame:
    """The first n distinct bids of `year` in the chosen bid's cluster, by all shown columns."""
    chosen = lookup(report, fiscal=fiscal, destination_no=destination, bid_line_no=bidlineno)
    cluster = chosen.select("Cluster").dropna().distinct()
    peers = report.where(F.col("fiscal") == year).join(cluster, "Cluster", "left_semi")
    peers = peers.select(*[F.col(f"`{c}`") for c in PEER_COLUMNS]).distinct()
    return peers.orderBy(*[F.col(f"`{c}`").asc_nulls_last() for c in PEER_COLUMNS]).limit(n)


def similar_offers(
    tables: ReferenceTables, clustering: DataFrame, year: int, fiscal: int, destination: str, bidlineno: int, n: int = 5
) -> DataFrame:
    """Like `similar_bids`, over all house offers and awards: only the peers of the chosen bid are joined with them."""
    tagged = with_cluster(tables.details, clustering)
    chosen = lookup(tagged, fiscal=fiscal, destination_no=destination, bid_line_no=bidlineno)
    cluster = chosen.select("Cluster").dropna().distinct()
    wanted = tagged.where(F.col("fiscal") == year).join(cluster, "Cluster", "left_semi")
    wanted = wanted.unionByName(chosen)
    return similar_bids(
        reference_report(with_cluster(expanded(tables, wanted), clustering)), year, fiscal, destination, bidlineno, n
    )


def bid_line_detail(report: DataFrame, destination: str, bidlineno: int) -> DataFrame:
    return lookup(report, destination_no=destination, bid_line_no=bidlineno).select(
        "`City & State`", "Date", "`Volume (K Tons)`", "`CMP Won Bid`"
    )


def price_table(by_category: DataFrame, **chosen) -> DataFrame:
    return lookup(by_category, **chosen).select("Category", "Price", "Margin")


def performance_lookup(performance: DataFrame, **chosen) -> DataFrame:
    return lookup(performance, **chosen).select("Price", "`This Year`", "`Last Year`")
