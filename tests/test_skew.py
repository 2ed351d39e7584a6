"""A third of all offers on one key: split joins give the rows an unsplit plan gives."""

import pytest
from pyspark.sql import functions as F

from tenderlake.operators.joins import membership, without_listed
from tenderlake.operators.windows import group_total
from tenderlake.plans import dashboard, features, reference_table
from tenderlake.storage import materialize
from workload import views

SPLITTING = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture(scope="module")
def hot(spark, sf_dir):
    bids = views.bids(spark, sf_dir)
    moved = F.pmod(F.xxhash64("bid_no", "committed_price_ty"), F.lit(3)) == 0
    line = {"fiscal": F.lit(1999), "destination_no": F.lit("H7"), "bid_line_no": F.lit(13), "key": F.lit("1999_H7_13")}
    bids = bids.withColumns({c: F.when(moved, v).otherwise(F.col(c)) for c, v in line.items()})
    return materialize(bids.repartition(16), "hot")


@pytest.mark.parametrize("build", [
    reference_table.bid_reference_table,
    lambda bids: group_total(bids.select("key", "bid_no", "total_qty_ty"), ["key"], "total_qty_ty", "whole"),
    features.region_price_movement,
    features.next_best_competitor,
    lambda bids: features.fill_rate(bids, views.CALENDAR),
], ids=["reference", "total", "region", "next_best", "fill_rate"])
def test_hot_key_gives_the_same_rows(spark, hot, build):
    def result():
        df = build(hot)
        names = [F.round(F.col(c), 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
        return sorted(map(tuple, df.select(*names).collect()), key=str)

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain = result()
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        for name, value in SPLITTING.items():
            spark.conf.set(name, value)
        assert result() == plain
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        for name in SPLITTING:
            spark.conf.unset(name)


def clustered(bids):
    tags = bids.select("key", (F.col("bid_line_no") % 7).alias("Cluster")).distinct()
    return dashboard.with_cluster(bids.select("destination_no", "bid_line_no", "bid_no"), tags)


@pytest.mark.parametrize("build", [
    reference_table.bid_reference_table,
    lambda bids: group_total(bids.select("key", "bid_no", "total_qty_ty"), ["key"], "total_qty_ty", "whole"),
    lambda bids: membership(bids.select("fiscal", "key", "bid_no"), bids, ["fiscal"], "found", "Yes", "No"),
    lambda bids: without_listed(bids, bids.select("key").limit(1), "key"),
    clustered,
], ids=["reference", "total", "membership", "anti", "cluster"])
def test_joins_on_the_hot_key_are_split(spark, hot, build):
    for name, value in SPLITTING.items():
        spark.conf.set(name, value)
    try:
        df = build(hot)
        query = df._jdf.queryExecution()
        df._jdf.collectToPython()
        assert "skew=true" in query.executedPlan().toString()
    finally:
        for name in SPLITTING:
            spark.conf.unset(name)
