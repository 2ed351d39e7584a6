"""Scorecard rules on hand-made frames."""

from datetime import date

from pyspark.sql import functions as F

from tenderlake.plans import dashboard
from tenderlake.plans import scorecard as sc
from tests.conftest import rows
from workload.scorecard_queries import written_card
from workload import views


def test_order_risk_labels_and_total(spark):
    data = [("a", 0.5, date(2020, 1, 1), 10.0, 5.0), ("b", 0.5, date(2020, 1, 15), 10.0, 5.0),
            ("c", 0.5, date(2020, 1, 14), None, None), ("d", 0.5, date(2020, 1, 14), 1.0, 0.0)]
    df = spark.createDataFrame(data, "key string, churn_prob double, last_trx_date date, diff_mean double, diff_std double")
    got = {r["key"]: r for r in sc.with_order_risk(df, date(2020, 1, 31)).collect()}
    assert got["a"]["Order deviation risk"] == "Well past due" and got["a"]["churn_risk"] == 1.5
    assert got["b"]["Order deviation risk"] == "Past due"
    assert got["c"]["Order deviation risk"] == "Within order pattern" and got["c"]["churn_risk"] == 0.5
    assert got["d"]["churn_risk"] == 0.5


def test_unavailable_and_undefined_ratio(spark):
    data = [("a", 0.0, 1.0), ("b", 0.5, 0.5), ("c", 0.0, 0.0), ("d", None, None)]
    df = spark.createDataFrame(data, "key string, churn_prob double, churn_risk double")
    got = dict(rows(sc.with_risk_bands(df, 100), "key", "Total churn risk"))
    assert got == {"a": "Unavailable", "b": "High"}


def test_open_orders_need_the_latest_line_open(spark):
    orders = spark.createDataFrame([
        (1, 10, date(2020, 1, 1), "OPEN"), (1, 10, date(2020, 2, 1), "CLSD"),
        (1, 11, date(2020, 1, 5), "OPEN"), (2, 10, date(2019, 1, 1), "OPEN"),
        (3, 10, date(2020, 3, 1), None)],
        "customer_bill_to_id long, product_code long, order_entry_date date, line_item_status string")
    products = spark.createDataFrame([(10, "F-1"), (11, "F-2")], "product_no long, family_code string")
    span = ("2020-01-01", "2020-12-31")
    assert rows(sc.open_orders(orders, products, *span)) == [("1", "F_2")]
    extra = orders.union(spark.createDataFrame([(1, 12, date(2020, 2, 1), "OPEN"), (1, 10, date(2020, 1, 5), "OPEN")],
                                               orders.schema))
    assert rows(sc.open_orders(extra, products, *span, match="customer")) == [("1", "F_1"), ("1", "F_2"), ("1", None)]


def test_program_text_match(spark):
    df = spark.createDataFrame([("123456-01", "BrennTag AG"), ("999999-02", None)], "ship_to string, supplier_name string")
    assert rows(sc.program_customers(df, "brenntag")) == [("123456",)]
    more = df.union(spark.createDataFrame([("123456-02", "other"), (None, "Nexeo")], df.schema))
    assert rows(sc.program_flags(more)) == [("0", " ", "Yes"), ("123456", "Yes", " "), ("999999", " ", " ")]


def test_layout_columns(spark, sf_dir):
    card = written_card(spark, sf_dir)
    reps = views.view(spark, sf_dir, views.SALES_HIERARCHY_SQL)
    for lob in ("lcd", "fi"):
        for df in sc.layouts(card, lob, reps).values():
            assert df.columns[0] == "AI_Source" and df.columns[-5:] == sc.DRIVER_COLUMNS
            assert df.count() == card.count()
    assert "churn_prob" in sc.layouts(card, "lcd")["full"].columns


def test_similar_bids_are_of_the_same_cluster(spark):
    names = list(dashboard.REFERENCE_NAMES.values())
    blank = {n: F.lit(None).cast("string") for n in names if n not in ("fiscal", "destination_no", "bid_line_no", "Cluster", "City")}
    base = spark.createDataFrame(
        [(2019, "H1", 1, 3), (2019, "H2", 2, 3), (2019, "H3", 3, 4), (2018, "H4", 4, 3)],
        "fiscal int, destination_no string, bid_line_no int, Cluster int")
    df = base.withColumns(blank).withColumn("City", F.lit("x")).withColumn("Customer Name", F.col("destination_no"))
    got = dashboard.similar_bids(df, 2019, 2019, "H1", 1)
    assert rows(got, "`Customer Name`") == [("H1",), ("H2",)]
