"""What large tables are shuffled for: plans with few exchanges, and the rows they must still give."""

from contextlib import contextmanager
from datetime import date

import pytest
from pyspark.sql import functions as F

from tenderlake.operators.joins import within_last_year
from tenderlake.plans import dashboard, reference_table
from tenderlake.plans import scorecard as sc
from tests.conftest import rows
from workload import views


@contextmanager
def no_broadcasts(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffled_by(df) -> int:
    return planned(df).count("Exchange hashpartitioning")


@pytest.mark.parametrize("text", [views.OFFERS_SQL, views.INVOICE_SQL], ids=["offers", "invoices"])
def test_order_lines_are_the_rows_of_their_text(spark, sf_dir, text):
    found, wanted = views.order_lines(spark, sf_dir, text), views.view(spark, sf_dir, text)
    assert found.columns == wanted.columns and found.count() == wanted.count() > 0
    assert found.exceptAll(wanted).count() == 0


def test_orders_meet_customers_before_their_lines(spark, sf_dir):
    with no_broadcasts(spark):
        plan = planned(views.raw_bids(spark, sf_dir))
    assert "hashpartitioning(o_custkey" in plan and "SortMergeJoin [l_orderkey" in plan
    assert plan.index("SortMergeJoin [l_orderkey") < plan.index("SortMergeJoin [o_custkey")


def test_score_keys_shuffle_keys_not_days(spark, sf_dir):
    found = views._scorecard_keys(spark, sf_dir)
    assert shuffled_by(found) == 1
    days = {}
    for key, day in rows(views.invoices(spark, sf_dir).select("key", "billing_date").distinct()):
        days.setdefault(key, set()).add(day)
    for key, last, mean, _ in found.collect():
        ordered = sorted(days.pop(key))
        gaps = [(b - a).days for a, b in zip(ordered, ordered[1:])]
        assert last == ordered[-1] and (mean is None) == (not gaps)
        assert not gaps or abs(mean - sum(gaps) / len(gaps)) < 1e-9
    assert not days


def test_value_at_risk_shuffles_an_invoice_once(spark):
    invoices = spark.createDataFrame(
        [("a", date(2020, 3, 1), 1.0), ("a", date(2020, 3, 1), 2.0), ("a", date(2019, 3, 1), 4.0), ("a", date(2019, 2, 28), 8.0),
         ("b", None, 16.0), (None, date(2020, 3, 1), 32.0), ("c", date(2020, 1, 1), None)],
        "key string, billing_date date, inv_delivered_gp double")
    keys = spark.createDataFrame(
        [("a", date(2020, 3, 1), 1.0, None), ("b", None, None, None), ("c", date(2020, 1, 1), None, None)],
        "key string, last_trx_date date, diff_mean double, diff_std double")
    with no_broadcasts(spark):
        found = sc.value_at_risk(invoices, keys)
        assert shuffled_by(found) == 2
        assert rows(found, "key", "value_at_risk") == [("a", 7.0), ("c", None)]
    daily = invoices.groupBy("key", "billing_date").agg(F.sum("inv_delivered_gp").alias("gp"))
    summed = within_last_year(daily, keys, "billing_date", "last_trx_date").groupBy("key").agg(F.sum("gp").alias("gp"))
    assert rows(summed, "key", "gp") == [("a", 7.0), ("c", None)]


def test_open_orders_shuffle_lines_by_customer_and_product_only(spark):
    day = date(2020, 2, 1)
    orders = spark.createDataFrame(
        [(1, 10, day, "CLSD"), (1, 10, day, "OPEN"), (2, 10, day, None), (3, 10, None, "OPEN"), (4, 10, day, "OPEN"), (4, 10, date(2020, 3, 1), None)],
        "customer_bill_to_id long, product_code long, order_entry_date date, line_item_status string")
    products = spark.createDataFrame([(10, "F-1")], "product_no long, family_code string")
    found = sc.open_orders(orders, products, "2020-01-01", "2020-12-31")
    assert not any("order_entry_date" in line for line in planned(found).splitlines() if "hashpartitioning" in line)
    assert rows(found) == [("1", "F_1")]


def test_details_are_not_shuffled_for_few_keys(spark, sf_dir):
    """The lookups are written, so Spark knows that they are small enough to be sent out."""
    bids = views.bids(spark, sf_dir)
    assert "SortMergeJoin" not in planned(reference_table.bid_reference_table(bids))
    tags = bids.select("key", (F.col("bid_line_no") % 7).alias("Cluster")).distinct()
    tagged = dashboard.with_cluster(bids.select("destination_no", "bid_line_no", "bid_no"), tags)
    assert "SortMergeJoin" not in planned(tagged)
    assert "SortMergeJoin" not in planned(reference_table.reference_tables(bids).details)
