"""Feature groups per bid key, and their assembly onto a key table.

Every function takes the cleaned bid table and returns one row per key. Groups are reduced by
partial aggregation first; only per-key (or smaller) tables are joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlake.fixed_values import CAPACITY_FACTOR, FILL_RATE_CALENDAR, HOUSE_ID, RIVAL_FLAG_IDS
from tenderlake.functions.aggregates import first_non_null, first_per_key, single_valued
from tenderlake.functions.columns import bid_key, differs_from, ratio, starts_with_word
from tenderlake.operators.joins import attach, previous_year, splittable, with_calendar
from tenderlake.operators.windows import as_of, capacity_share, forward_fill

TYPE_COLUMNS = ["sales_region_name", "product_name", "bid_type_name", "customer_type_name"]
COST_COLUMNS = [
    "total_qty_ty", "distance_ty", "stockpile_depot_cost_ty", "direct_transfer_depot_cost_ty",
    "freight_cost_ty", "fuel_surcharge_cost_ty", "equipment_cost_ty", "committed_cost_ty",
]


def _awarded(bids: DataFrame) -> DataFrame:
    return bids.where(F.col("award_price_ty") > 0)


def _priced(bids: DataFrame) -> DataFrame:
    return bids.where((F.col("award_price_ty") > 0) & (F.col("committed_price_ty") > 0))


def _line_picks(bids: DataFrame) -> DataFrame:
    """Everything taken as a minimum or first value per key, in one pass.

    None of it depends on duplicates, so no distinct is needed; a caller that selects some of
    the columns has the other aggregates pruned.
    """
    rows = _awarded(bids)
    types = [first_non_null(c, TYPE_COLUMNS).alias(c) for c in TYPE_COLUMNS]
    return rows.groupBy("key").agg(
        *types,
        F.min("rollover").alias("rollover"),
        F.min("destination_state_prov").alias("state"),
        F.min("bid_name").alias("bid_name"),
    )


def _only_bid_states(bids: DataFrame) -> DataFrame:
    return (
        _awarded(bids).select(F.col("destination_state_prov").alias("state"), "bid_line_no")
        .dropna(subset=["state"])
        .groupBy("state")
        .agg(single_valued("bid_line_no").cast("int").alias("is_onlybid_in_state"))
    )


def _name_flags() -> list[Column]:
    return [
        starts_with_word("bid_name", "emergency").alias("is_emergency_bid"),
        starts_with_word("bid_name", "supplemental").alias("is_supplemental_bid"),
    ]


def region_product_types(bids: DataFrame) -> DataFrame:
    """First sales region, product, bid type and customer type, in that column order."""
    return _line_picks(bids).select("key", *TYPE_COLUMNS)


def cost_qty_distance(bids: DataFrame) -> DataFrame:
    """Means of quantity, distance and costs over the distinct offers of a key."""
    rows = _awarded(bids).select(
        "key", "award_price_ty", "min_purchase_qty_ty", "max_supply_qty_ty", *COST_COLUMNS
    ).distinct()
    return rows.groupBy("key").agg(*[F.avg(c).alias(c) for c in COST_COLUMNS])


def competitors_previous_year(bids: DataFrame) -> DataFrame:
    """Distinct rivals on the same line one fiscal year before.

    A line whose only rivals are unnamed counts zero and is flagged as without competition.
    """
    rivals = bids.where(F.col("committed_price_ty") > 0).where(differs_from("price_competitor_id", HOUSE_ID))
    counts = (
        rivals.select(bid_key(shift=1).alias("key"), "price_competitor_id")
        .groupBy("key")
        .agg(F.count_distinct("price_competitor_id").alias("num_competitors_prevyear"))
    )
    return counts.withColumn(
        "Is_NoCompetitionPrevYear", F.when(F.col("num_competitors_prevyear") == 0, 1).otherwise(0)
    )


def destination_price_previous_year(bids: DataFrame) -> DataFrame:
    """Mean award price of the destination one fiscal year before."""
    rows = _awarded(bids).select("key", "fiscal", "destination_no", "award_price_ty").distinct()
    means = rows.groupBy("fiscal", "destination_no").agg(
        F.avg("award_price_ty").alias("avg_awardprice_destination_prevyear")
    )
    keys = rows.select("key", "fiscal", "destination_no").distinct()
    return previous_year(keys, means, ["destination_no"], how="inner").select(
        "key", "avg_awardprice_destination_prevyear"
    )


def region_price_movement(bids: DataFrame) -> DataFrame:
    """Mean price per quantity of the region one year before, and its change from two years before.

    A key seen in several regions takes the first region that has a value.
    """
    rows = _awarded(bids).select(
        "key", "fiscal", "sales_region_name",
        ratio("award_price_ty", "total_qty_ty").alias("weighted"),
    ).dropna(subset=["sales_region_name"])
    means = (
        rows.select("fiscal", "sales_region_name", "weighted").distinct()
        .groupBy("fiscal", "sales_region_name").agg(F.avg("weighted").alias("mean"))
    )
    # Keys shrink to one row per region before they meet the means.
    keys = rows.select("key", "fiscal", "sales_region_name").distinct()
    one = means.withColumn("fiscal", F.col("fiscal") + 1)
    one = one.withColumnRenamed("mean", "avg_wt_awardprice_region_prev1year")
    two = means.withColumnRenamed("mean", "_prev2")
    region = ["fiscal", "sales_region_name"]
    moves = previous_year(one, two, ["sales_region_name"], 2, "inner").select(
        *region, "avg_wt_awardprice_region_prev1year",
        (ratio("avg_wt_awardprice_region_prev1year", "_prev2") - 1).alias("per_pricemovement_region"),
    )
    moved = keys.join(splittable(moves, region), region).drop("fiscal")
    order = ["sales_region_name"]
    return first_per_key(moved, ["key"], order).drop("sales_region_name")


def min_max_quantity(bids: DataFrame) -> DataFrame:
    """Mean quantity and the minimum and maximum as shares of it."""
    rows = _awarded(bids).select("key", "min_purchase_qty_ty", "max_supply_qty_ty", "total_qty_ty").distinct()
    means = rows.groupBy("key").agg(
        F.avg("min_purchase_qty_ty").alias("low"),
        F.avg("max_supply_qty_ty").alias("high"),
        F.avg("total_qty_ty").alias("total_qty_ty"),
    )
    # Tested on the parts: a positive maximum over a zero quantity counts as present.
    present = (F.col("high") > 0) & (F.col("total_qty_ty") >= 0)
    return means.select(
        "key", "total_qty_ty",
        ratio("low", "total_qty_ty").alias("min_qty_per"),
        ratio("high", "total_qty_ty").alias("max_qty_per"),
        F.when(present, 1).otherwise(0).alias("Is_minmaxqtypresent"),
    )


def contract_timeframe(bids: DataFrame) -> DataFrame:
    """Mean days from effective to expiry date over distinct date pairs."""
    rows = _awarded(bids).select("key", "effective_date", "expiry_date").distinct()
    days = F.datediff("expiry_date", "effective_date")
    return rows.groupBy("key").agg(F.avg(days).alias("contract_timeframe"))


def rollover_contract(bids: DataFrame) -> DataFrame:
    """First rollover flag, false before true."""
    return _line_picks(bids).select("key", "rollover")


def next_best_competitor(bids: DataFrame) -> DataFrame:
    """Last year's rival with the smallest gap to the award, next to the house's own offer.

    Ties go to the smallest id (unnamed first for the price, named only for the id), then the
    smallest price. The winner itself may be the rival, with gap zero. Keys need both sides.
    """
    offers = _priced(bids).select(
        bid_key(shift=1).alias("key"),
        "price_competitor_id", "committed_price_ty", "award_price_ty", "award_competitor_id",
        (F.col("committed_price_ty") - F.col("award_price_ty")).alias("gap"),
    )
    rival = differs_from("price_competitor_id", HOUSE_ID)
    named = rival & F.col("price_competitor_id").isNotNull()
    house = F.col("price_competitor_id") == HOUSE_ID
    offer = F.struct("gap", "price_competitor_id", "committed_price_ty")
    award = F.struct("committed_price_ty", "award_price_ty", "award_competitor_id")
    picked = offers.groupBy("key").agg(
        F.min(F.when(rival, offer)).alias("best"),
        F.min(F.when(named, offer)).alias("named"),
        F.min(F.when(house, F.col("committed_price_ty"))).alias("cmp_committed_price_prevyr"),
        F.min(F.when(house & F.col("award_competitor_id").isNotNull(), award)).alias("award"),
    ).where(F.col("best").isNotNull() & F.col("cmp_committed_price_prevyr").isNotNull())
    rival_id = F.when(F.col("named.gap") == F.col("best.gap"), F.col("named.price_competitor_id"))
    flags = [F.when(rival_id == v, 1).otherwise(0).alias(c) for c, v in RIVAL_FLAG_IDS.items()]
    return picked.select(
        "key",
        F.col("best.committed_price_ty").alias("nbc_committed_price_prevyr"),
        F.col("best.gap").alias("min_price_gap_nbc"),
        *flags,
        "cmp_committed_price_prevyr",
        F.when(F.col("award.award_competitor_id") == HOUSE_ID, 1).otherwise(0).alias("Is_cmp_awarded_prevyr"),
        (F.col("cmp_committed_price_prevyr") - F.col("best.committed_price_ty")).alias("cmp_nbc_pricediff_prevyr"),
    )


def _due_offers(bids: DataFrame) -> DataFrame:
    return _priced(bids).select(
        "key", "fiscal", "destination_no", "bid_line_no", "bid_due_date",
        "price_competitor_id", "award_competitor_id", "total_qty_ty",
    )


def won_quantity(bids: DataFrame) -> DataFrame:
    """Quantity won per fiscal year, competitor and due date, over distinct offers."""
    won = _due_offers(bids).where(F.col("price_competitor_id") == F.col("award_competitor_id")).distinct()
    return (
        won.dropna(subset=["fiscal", "bid_due_date"])
        .groupBy("fiscal", "price_competitor_id", "bid_due_date")
        .agg(F.coalesce(F.sum("total_qty_ty"), F.lit(0.0)).alias("total_qty_ty"))
    )


def due_span(bids: DataFrame) -> tuple[str, str]:
    """First and last due date; the fixed calendar if there is none."""
    span = _due_offers(bids).agg(*[f(F.col("bid_due_date").cast("date")).cast("string") for f in (F.min, F.max)]).first()
    return (span[0], span[1]) if span[0] else FILL_RATE_CALENDAR


def daily_fill_rate(
    bids: DataFrame, calendar: tuple[str, str] | None = None, competitor: str | None = None
) -> DataFrame:
    """Share of capacity used on every calendar day of every fiscal year, by all or one competitor.

    Won days outside the calendar stay in. All windows run on one row per competitor and day,
    so their partitions are bounded by the calendar, not by the number of offers.
    """
    group = ["fiscal", "price_competitor_id"]
    if competitor is not None:
        bids = bids.where(F.col("price_competitor_id") == competitor)
    rates = capacity_share(won_quantity(bids), group, "bid_due_date", "total_qty_ty", CAPACITY_FACTOR)
    pairs = _due_offers(bids).select(*group).dropna().distinct()
    days = with_calendar(pairs, *(calendar or due_span(bids)), "bid_due_date")
    every_day = days.join(rates.select(*group, "bid_due_date", "fill_rate"), [*group, "bid_due_date"], "outer")
    return every_day.withColumn("fill_rate", forward_fill("fill_rate", group, "bid_due_date"))


def fill_rate(bids: DataFrame, calendar: tuple[str, str] | None = None) -> DataFrame:
    """The house's fill rate on the due date of a won bid; first due date that has one.

    Won offers always find their own competitor and day, so only the house's rates are looked up: as of the
    days that are asked for, without a row for every day of the calendar. A given calendar limits the days
    that are asked for; days on which the house won count in any case.
    """
    offers = _due_offers(bids)
    house = offers.where(F.col("price_competitor_id") == HOUSE_ID)
    rates = capacity_share(
        won_quantity(bids.where(F.col("price_competitor_id") == HOUSE_ID)), ["fiscal", "price_competitor_id"],
        "bid_due_date", "total_qty_ty", CAPACITY_FACTOR,
    ).select("fiscal", "bid_due_date", "fill_rate")
    won = (
        offers.where(F.col("price_competitor_id") == F.col("award_competitor_id"))
        .select("key", "fiscal", "bid_due_date").distinct()
    )
    asked = won.select("fiscal", "bid_due_date").dropna().distinct()
    if calendar:
        asked = asked.where(F.col("bid_due_date").between(*[F.lit(day).cast("date") for day in calendar]))
    asked = asked.join(house.select("fiscal").dropna().distinct(), "fiscal", "left_semi")
    known = as_of(rates, asked, ["fiscal"], "bid_due_date", "fill_rate").withColumnRenamed("fill_rate", "fill_rate_CMP")
    # One row per fiscal year and day of an offer; AQE broadcasts it once measured.
    rated = won.join(known, ["fiscal", "bid_due_date"]).select("key", "bid_due_date", "fill_rate_CMP")
    return first_per_key(rated, ["key"]).drop("bid_due_date")


def bid_flags(bids: DataFrame) -> DataFrame:
    """Only bid line in its (first) state; emergency or supplemental by the first bid name."""
    picks = _line_picks(bids).select("key", "state", "bid_name")
    states = splittable(_only_bid_states(bids), ["state"])
    return picks.join(states, "state", "left").select("key", "is_onlybid_in_state", *_name_flags())


def line_attributes(bids: DataFrame, all_bids: DataFrame | None = None) -> DataFrame:
    """Types, rollover and flags together: one aggregation where the single groups would take three.

    `all_bids` is what a state's only bid line is judged by, if `bids` is a part of it.
    """
    states = splittable(_only_bid_states(bids if all_bids is None else all_bids), ["state"])
    picks = _line_picks(bids).join(states, "state", "left")
    return picks.select("key", *TYPE_COLUMNS, "rollover", "is_onlybid_in_state", *_name_flags())


def cluster_features(bids: DataFrame, clusters: DataFrame) -> DataFrame:
    """Last year's mean committed and award price and number of competitors in the key's cluster.

    Means over distinct rows are carried as sums and counts per key, so no offer row meets the
    cluster table. All three measures start from the same distinct rows, whose shuffle Spark
    reuses. The house counts as a competitor here.
    """
    offers = _priced(bids).select(
        "key", "fiscal", "price_competitor_id", "committed_price_ty", "award_price_ty"
    ).distinct()
    mapping = first_per_key(clusters.select("key", "cluster"), ["key"])
    committed = (
        offers.select("key", "fiscal", "price_competitor_id", "committed_price_ty").distinct()
        .groupBy("key")
        .agg(
            F.any_value("fiscal").alias("fiscal"),
            F.sum("committed_price_ty").alias("price_sum"),
            F.count("committed_price_ty").alias("prices"),
        )
    )
    keys = committed.join(mapping, "key", "left")
    in_cluster = keys.where(F.col("cluster").isNotNull())
    price = in_cluster.groupBy("fiscal", "cluster").agg(
        (F.sum("price_sum") / F.sum("prices")).alias("avg_committed_price_prevyr_cluster")
    )

    def per_cluster(column, measure):
        values = offers.select("key", "fiscal", column).distinct().join(splittable(mapping, ["key"]), "key")
        values = values.where(F.col("cluster").isNotNull()).select("fiscal", "cluster", column).distinct()
        return values.groupBy("fiscal", "cluster").agg(measure)

    award = per_cluster("award_price_ty", F.avg("award_price_ty").alias("avg_award_price_prevyr_cluster"))
    rivals = per_cluster("price_competitor_id", F.count("price_competitor_id").alias("num_competitors_prevyr_cluster"))
    by_cluster = price.join(award, ["fiscal", "cluster"], "left").join(rivals, ["fiscal", "cluster"], "left")
    return previous_year(keys.select("key", "fiscal", "cluster"), by_cluster, ["cluster"]).select(
        "key", "fiscal", "cluster", "avg_committed_price_prevyr_cluster",
        "avg_award_price_prevyr_cluster", "num_competitors_prevyr_cluster",
    )


def feature_groups(
    bids: DataFrame, clusters: DataFrame, calendar: tuple[str, str] | None = None,
    first_fiscal: int | None = None,
) -> dict[str, DataFrame]:
    """The feature groups of the full table, by name. Quantity comes from the cost group only.

    `first_fiscal` is the earliest fiscal year of the keys in question: groups then read offers
    from their own look-back only, which prunes a bid table partitioned by fiscal year.
    """
    def since(years_back: int) -> DataFrame:
        return bids if first_fiscal is None else bids.where(F.col("fiscal") >= first_fiscal - years_back)

    return {
        "line_attributes": line_attributes(since(0), bids),
        "competitors_previous_year": competitors_previous_year(since(1)),
        "cost_qty_distance": cost_qty_distance(since(0)),
        "destination_price_previous_year": destination_price_previous_year(since(1)),
        "region_price_movement": region_price_movement(since(2)),
        "min_max_quantity": min_max_quantity(since(0)).drop("total_qty_ty"),
        "contract_timeframe": contract_timeframe(since(0)),
        "next_best_competitor": next_best_competitor(since(1)),
        "fill_rate": fill_rate(since(0), calendar),
        "cluster_features": cluster_features(since(1), clusters),
    }


def feature_table(
    key_table: DataFrame, bids: DataFrame, clusters: DataFrame,
    calendar: tuple[str, str] | None = None, key_columns: Sequence[str] = ("key", "date", "target"),
    first_fiscal: int | None = None,
) -> DataFrame:
    """Key table with all feature groups, joined on the key; repeated column names are refused.

    Every group is aggregated by key already, so the chain of joins shares one partitioning.
    """
    table = key_table.select(*key_columns)
    for group in feature_groups(bids, clusters, calendar, first_fiscal).values():
        table = attach(table, group, ["key"], check=False)
    return table
