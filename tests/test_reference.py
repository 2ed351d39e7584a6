"""Linked reference tables against the join they stand for."""

import pytest
from pyspark.sql import functions as F

from tenderlake.plans import dashboard, features, reference_table as rt
from tests.conftest import rows
from workload import dashboard_queries as q
from workload import views


@pytest.fixture(scope="module")
def linked(spark, sf_dir):
    return q.linked(spark, sf_dir)


def test_expanded_rows_are_those_of_the_whole_join(spark, sf_dir, linked):
    whole = rt.bid_reference_table(views.bids(spark, sf_dir), matches="all")
    full = rt.expanded(linked)
    assert full.columns == whole.columns and full.count() == whole.count() > rt.bid_reference_table(views.bids(spark, sf_dir)).count()
    assert full.exceptAll(whole).count() == 0
    some = linked.details.where("bid_line_no % 7 = 0")
    part = rt.expanded(linked, some)
    assert part.count() == full.where("bid_line_no % 7 = 0").count() > 0


def test_counts_and_totals_need_no_product(linked):
    full = rt.expanded(linked)
    by_key = rows(full.groupBy("key").agg(F.count("*").alias("n_rows")), "key", "n_rows")
    assert rows(linked.links, "key", "n_rows") == by_key
    want = full.groupBy("fiscal").agg(
        F.count("*").alias("n_rows"), F.count("last_yr_award_price").alias("n_compared"),
        F.sum("delta_awardprice_lastyr").alias("delta"), F.count_if(F.col("incumbent") != "None").alias("n_incumbent"))
    got, want = (rows(x, "fiscal", "n_rows", "n_compared", "n_incumbent") for x in (rt.totals(linked), want))
    assert got == want


def test_totals_make_no_join_of_offers_with_awards(linked, capsys):
    rt.totals(linked).explain("formatted")
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_similar_offers_name_all_offers_of_the_peers(spark, sf_dir, linked):
    clustering = q.clustering(spark, sf_dir)
    chosen = linked.details.where(F.col("fiscal") == views.CLUSTER_YEAR).first()
    found = dashboard.similar_offers(
        linked, clustering, views.CLUSTER_YEAR, chosen["fiscal"], chosen["destination_no"], chosen["bid_line_no"], 1_000_000)
    report = dashboard.reference_report(dashboard.with_cluster(rt.expanded(linked), clustering))
    want = dashboard.similar_bids(
        report, views.CLUSTER_YEAR, chosen["fiscal"], chosen["destination_no"], chosen["bid_line_no"], 1_000_000)
    assert rows(found) == rows(want) != []


def test_one_wild_due_date_changes_no_fill_rate(spark, sf_dir):
    """The year 9999 neither stretches a calendar nor changes what was known before."""
    bids = views.bids(spark, sf_dir)
    wild = bids.where("award_competitor_id = price_competitor_id").limit(1).withColumns(
        {"bid_due_date": F.to_date(F.lit("9999-12-31")), "key": F.lit("wild"), "total_qty_ty": F.lit(0.0)})
    before, after = features.fill_rate(bids), features.fill_rate(bids.unionByName(wild))
    assert rows(after.where("key <> 'wild'")) == rows(before) != []
