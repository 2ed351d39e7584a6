"""Wide rows are not shuffled for lookups that are small, and no key's rows twice."""

import re
from datetime import date

from pyspark.sql import functions as F

from tenderlake.plans import churn, modeling, scorecard
from workload import churn_queries, scorecard_queries, views


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_awards_do_not_shuffle_the_offers(spark, sf_dir):
    assert "SortMergeJoin [fiscal" not in plan(views.raw_bids(spark, sf_dir))


def test_drivers_are_ranked_within_the_row(spark):
    rows = [("a", "gap_mean", 0.5), ("a", "margin", 0.5), ("a", "other", 9.0), ("b", "margin", -1.0)]
    parts = spark.createDataFrame(rows, "key string, feature string, contribution double")
    pairs = [("Order pattern", "gap_mean"), ("Margin", "margin")]
    top = scorecard.top_drivers(parts, pairs, 3)
    assert plan(top).count("Exchange") == 1
    assert sorted(map(tuple, top.collect())) == [
        ("a", "Margin", "Order pattern", None), ("b", "Margin", "Order pattern", None)]
    long = scorecard.class_contributions(parts, pairs)
    assert sorted(map(tuple, long.collect())) == [
        ("a", "Margin", 0.5), ("a", "Order pattern", 0.5), ("b", "Margin", 0.0), ("b", "Order pattern", 0.0)]


def test_industry_of_the_last_day_takes_one_shuffle(spark):
    day = date(2000, 1, 1)
    rows = [(1, day, "B"), (1, day, "A"), (1, day, None), (1, None, "0"), (1, date(1999, 1, 1), "0"),
            (2, day, None), (2, date(1999, 1, 1), "X"), (3, None, "N")]
    found = scorecard.customer_industry(
        spark.createDataFrame(rows, "customer_bill_to_id long, billing_date date, uic_industry_group_name string"))
    assert plan(found).count("Exchange") == 1
    assert sorted(map(tuple, found.collect())) == [("1", "A"), ("2", None), ("3", "N")]


def test_card_is_not_shuffled_by_products(spark, sf_dir):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(scorecard_queries.card(spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin [key#" in text
    assert not re.search(r"SortMergeJoin \[Customer#\d+, (Product|family_code)#", text)


def test_keys_of_customers_and_products(spark):
    rows = spark.createDataFrame([("1", "a_b", "x"), ("1_a", "b", "y"), (None, "c", "z"), ("2", None, "w")], "Customer string, Product string, v string")
    found = scorecard.of_keys(rows).where(F.col("key").isNotNull())
    assert [tuple(r) for r in found.select("key", "v").collect()] == [("1_a_b", "x")]


def test_snapshot_reads_invoices_up_to_its_target(spark):
    rows = [("1_a", date(1997, 1, 1)), ("1_a", date(1997, 1, 11)), ("1_a", date(1998, 6, 30)), ("1_a", None),
            ("2_a", date(1997, 1, 1)), ("2_a", date(1998, 7, 1)), ("3_a", date(1999, 1, 1)), ("4_a", None)]
    invoices = spark.createDataFrame(rows, "key string, billing_date date").select(
        "*", F.lit(1.0).alias("inv_delivered_gp"), F.lit(2.0).alias("quantity"), F.lit("s").alias("uic_industry_group_name"))
    found = churn.snapshot(invoices, date(1997, 6, 30), churn.YEAR)
    assert "1998-06-30" in re.findall(r"Filter .*", plan(found))[-1]
    assert sorted(map(tuple, found.select("key", "target", "profit", "gap_mean").collect())) == [
        ("1_a", 0.0, 2.0, 10.0), ("2_a", 1.0, 1.0, None)]


def test_snapshot_sorts_once_and_keeps_days_of_several_segments(spark):
    day = date(1997, 1, 1)
    rows = [("1_a", day, "z"), ("1_a", day, "b"), ("1_a", day, None), ("1_a", date(1997, 1, 5), "c"), (None, day, None)]
    invoices = spark.createDataFrame(rows, "key string, billing_date date, uic_industry_group_name string").select(
        "*", F.lit(3.0).alias("inv_delivered_gp"), F.lit(2.0).alias("quantity"))
    found = churn.snapshot(invoices, date(1997, 6, 30))
    assert len(re.findall(r"\bSort \[", plan(found))) == 1
    picked = found.select("key", "profit", "quantity", "lines", "price_level", "gap_mean", "segment")
    assert sorted(map(tuple, picked.collect()), key=str) == [
        ("1_a", 12.0, 8.0, 4.0, 1.5, 4.0, "b"), (None, 3.0, 2.0, 1.0, 1.5, None, None)]


def test_fitting_reads_prepared_rows_that_are_computed_once(spark):
    class Estimator:
        def fit(self, rows):
            self.rows, self.level = rows, rows.storageLevel
            return "model"

    prepared = spark.range(3).select(F.col("id").alias("features"), F.lit(1.0).alias("target"), F.lit("x").alias("key"))
    estimator = Estimator()
    assert modeling.fit_prepared(estimator, prepared) == "model"
    assert estimator.level.useDisk and not estimator.level.useMemory
    assert estimator.rows.columns == ["features", "target"] and not estimator.rows.storageLevel.useDisk


def test_score_checks_write_no_leaves(spark, sf_dir):
    folder = sf_dir + "/../sf0.001"
    checks = churn_queries.score_checks(spark, folder)
    assert (spark.sparkContext.applicationId, folder, "churn-scored") not in views._WRITTEN
    assert "UDF" in plan(checks) and "leaf" not in plan(checks)
    assert checks.first()["out_of_range"] == 0
