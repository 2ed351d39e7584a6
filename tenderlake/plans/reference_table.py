"""Bid reference table: house offer, top rival, last year's award and incumbent per bid.

`bid_reference_table` has one row per bid detail. A key can have several house offers and last-year
awards; `reference_tables` keeps all of them as linked tables whose sizes add up instead of
multiplying, `expanded` joins them for the keys one wants to see, and `totals` sums up the joined
rows without making them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.fixed_values import HOUSE_ID, REFERENCE_DETAILS as DETAILS
from tenderlake.functions.columns import bid_key, differs_from
from tenderlake.operators.joins import splittable
from tenderlake.storage import materialize


def house_offers(offers: DataFrame) -> DataFrame:
    won = F.when(F.col("award_competitor_id") == HOUSE_ID, "Yes").otherwise("No")
    house = offers.where(F.col("price_competitor_id") == HOUSE_ID)
    return house.select("key", F.col("committed_price_ty").alias("cmp_price"), won.alias("cmp_won_bid")).distinct()


def last_year_awards(offers: DataFrame) -> DataFrame:
    return offers.select(
        bid_key(shift=1).alias("key"),
        F.col("award_price_ty").alias("last_yr_award_price"),
        F.col("award_competitor_id").alias("last_yr_award_competitor_id"),
    ).distinct()


def top_rivals(offers: DataFrame, order: str = "desc") -> DataFrame:
    """Per key the rival offer that sorts first by price; ties go to the smallest id.

    `desc` picks the highest offer, `asc` the lowest. Id and price are each the first non-null.
    """
    sign = -1 if order == "desc" else 1
    rivals = offers.where(differs_from("price_competitor_id", HOUSE_ID))
    pick = F.struct((F.col("committed_price_ty") * sign).alias("p"), F.col("price_competitor_id").alias("id"))
    return rivals.groupBy("key").agg(
        F.min(F.when(F.col("price_competitor_id").isNotNull(), pick)).getField("id").alias("top_competitor_id"),
        (F.min(F.col("committed_price_ty") * sign) * sign).alias("top_competitor_price"),
    )


def _smallest_row(df: DataFrame) -> DataFrame:
    """One row per key: the smallest as a whole, by column order."""
    values = [c for c in df.columns if c != "key"]
    return df.groupBy("key").agg(F.min(F.struct(*values)).alias("_row")).select("key", "_row.*")


def bid_reference_table(bids: DataFrame, order: str = "desc", matches: str = "first") -> DataFrame:
    """Distinct bid details with house offer, top rival, last year's award, delta and incumbent.

    A key can have several house offers or last-year awards. `matches="first"` attaches the
    smallest one, so a key with many rows does not multiply; `matches="all"` joins every one.
    """
    offers = _priced(bids)
    details = offers.select(*DETAILS).distinct()
    house, rivals, last = house_offers(offers), top_rivals(offers, order), last_year_awards(offers)
    if matches == "first":
        # The lookups meet first, one row per key each; the details are joined once. Written, so that Spark knows
        # their size: the wide details are only shuffled for them if they are many.
        per_key = _smallest_row(house).join(rivals, "key", "outer").join(_smallest_row(last), "key", "outer")
        per_key = materialize(per_key, "reference-keys", "zstd")
        joined = details.join(splittable(per_key, ["key"]), "key", "left")
    else:
        joined = details.join(house, "key", "left").join(rivals, "key", "left").join(last, "key", "left")
    return _compared(joined)


def _priced(bids: DataFrame) -> DataFrame:
    return bids.where((F.col("committed_price_ty") > 0) & (F.col("award_price_ty") > 0))


def _compared(joined: DataFrame) -> DataFrame:
    """The report columns of details that have met an offer and an award."""
    kept = F.col("award_competitor_id") == F.col("last_yr_award_competitor_id")
    return joined.select(
        *DETAILS, "cmp_price", "cmp_won_bid", "top_competitor_id", "top_competitor_price",
        "last_yr_award_competitor_id", "last_yr_award_price",
        (F.col("award_price_ty") - F.col("last_yr_award_price")).alias("delta_awardprice_lastyr"),
        F.when(kept, F.col("award_competitor_id")).otherwise("None").alias("incumbent"),
        F.concat("destination_county_name", F.lit(", "), "destination_state_prov").alias("city_state"),
    )


@dataclass(frozen=True)
class ReferenceTables:
    """Distinct details with their top rival, all house offers and all last-year awards, linked by key.

    `links` has, for each key of `details`, the number of rows in each of the three, and how many
    joined rows they stand for (a key without offers or awards keeps its details).
    """

    details: DataFrame
    house: DataFrame
    awards: DataFrame

    @property
    def links(self) -> DataFrame:
        counts = self.details.groupBy("key").agg(F.count("*").alias("n_details"))
        for table, name in ((self.house, "n_house_offers"), (self.awards, "n_last_yr_awards")):
            counts = counts.join(table.groupBy("key").agg(F.count("*").alias(name)), "key", "left")
        counts = counts.fillna(0, ["n_house_offers", "n_last_yr_awards"])
        rows = F.col("n_details") * _at_least_one("n_house_offers") * _at_least_one("n_last_yr_awards")
        return counts.withColumn("n_rows", rows)


def _at_least_one(count: str):
    return F.greatest(F.col(count), F.lit(1))


def reference_tables(bids: DataFrame, order: str = "desc") -> ReferenceTables:
    """The linked tables; their sizes add up to no more than a few times the offers.

    Awards are those of keys that stand in the details a year later.
    """
    offers = _priced(bids)
    details = offers.select(*DETAILS).distinct()
    keys = details.select("key").distinct()
    awards = last_year_awards(offers).join(splittable(keys, ["key"]), "key", "left_semi")
    # A row per key, written so that Spark knows its size.
    rivals = materialize(top_rivals(offers, order), "top-rivals", "zstd")
    details = details.join(splittable(rivals, ["key"]), "key", "left")
    return ReferenceTables(details, house_offers(offers), awards)


def expanded(tables: ReferenceTables, keys: DataFrame | None = None) -> DataFrame:
    """Every detail with every house offer and award of its key, for the wanted `keys` or for all.

    Keys with many of each multiply: ask for the keys that are to be shown.
    """
    parts = [tables.details, tables.house, tables.awards]
    if keys is not None:
        wanted = materialize(keys.select("key").distinct(), "wanted-keys", "zstd")
        parts = [p.join(splittable(wanted, ["key"]), "key", "left_semi") for p in parts]
    details, house, awards = parts
    return _compared(details.join(house, "key", "left").join(awards, "key", "left"))


def totals(tables: ReferenceTables, by: str = "fiscal") -> DataFrame:
    """Sums over all joined rows, computed on the linked tables: rows, rows with an award to compare,
    the sum of price changes, and rows whose award went to last year's competitor."""
    house = tables.house.groupBy("key").agg(F.count("*").alias("n_house"))
    awards = tables.awards.groupBy("key").agg(
        F.count("*").alias("n_awards"), F.sum("last_yr_award_price").alias("last_prices")
    )
    same = tables.awards.groupBy("key", F.col("last_yr_award_competitor_id").alias("award_competitor_id")).agg(
        F.count("*").alias("n_same")
    )
    # The per-key counts meet first; the details are joined once.
    counts = house.join(awards, "key", "outer").fillna(0, ["n_house", "n_awards"])
    met = tables.details.join(splittable(counts, ["key"]), "key", "left").fillna(0, ["n_house", "n_awards"])
    met = met.join(splittable(same, ["key"]), ["key", "award_competitor_id"], "left")
    times = _at_least_one("n_house")
    change = F.col("n_awards") * F.col("award_price_ty") - F.col("last_prices")
    return met.groupBy(by).agg(
        F.sum(times * _at_least_one("n_awards")).alias("n_rows"),
        F.sum(times * F.col("n_awards")).alias("n_compared"),
        F.sum(times * change).alias("delta_awardprice_lastyr"),
        F.coalesce(F.sum(times * F.col("n_same")), F.lit(0)).alias("n_incumbent"),
    )


def with_link_counts(reference: DataFrame, tables: ReferenceTables) -> DataFrame:
    """The reference table with how many offers and awards each key has beside the ones shown."""
    counts = tables.links.select("key", "n_house_offers", "n_last_yr_awards")
    return reference.join(splittable(counts, ["key"]), "key", "left")
