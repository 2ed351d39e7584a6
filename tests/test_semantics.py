"""Null, division, order and rounding rules on tiny frames."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tenderlake.fixed_values import CSV_TIMESTAMP_FORMATS
from tenderlake.functions import aggregates as ag
from tenderlake.functions import columns as cl
from tenderlake.operators import joins, reshape
from tests.conftest import rows


def test_differs_keeps_nulls(spark):
    df = spark.createDataFrame([("CMP",), ("CS",), (None,)], "id string")
    assert rows(df.where(cl.differs_from("id", "CMP"))) == [("CS",), (None,)]


def test_first_non_null_takes_each_column_on_its_own(spark):
    df = spark.createDataFrame([("k", 1, None, "x"), ("k", 2, "b", None), ("k", 3, "a", "y"), (None, 1, "z", "z")],
                               "key string, o int, p string, q string")
    assert rows(ag.first_per_key(df, ["key"])) == [("k", 1, "b", "x")]


def test_first_non_null_with_given_order(spark):
    df = spark.createDataFrame([("k", 9, "early"), ("k", 1, "late")], "key string, rank int, v string")
    picked = df.groupBy("key").agg(ag.first_non_null("v", ["rank"]).alias("v"))
    assert rows(picked) == [("k", "late")]


def test_ratio_and_finite(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (1.0, 4.0), (float("inf"), 1.0), (float("nan"), 1.0)],
                               "a double, b double")
    assert [r[0] for r in df.select(cl.ratio("a", "b")).collect()][:3] == [None, None, 0.25]
    assert [r[0] for r in df.select(cl.finite("a")).collect()][3:] == [None, None]


def test_total_of_missing_is_zero(spark):
    df = spark.createDataFrame([("a", None), ("b", 2.0)], "k string, v double")
    assert rows(df.groupBy("k").agg(ag.total("v"))) == [("a", 0.0), ("b", 2.0)]


def test_anti_join_matches_null_with_null(spark):
    df = spark.createDataFrame([("1",), ("2",), (None,)], "zip string")
    assert rows(joins.without_listed(df, spark.createDataFrame([("1",)], "zip string"), "zip")) == [("2",), (None,)]
    listed = spark.createDataFrame([("1",), (None,)], "zip string")
    assert rows(joins.without_listed(df, listed, "zip")) == [("2",)]


def test_membership_of_null_is_no(spark):
    df = spark.createDataFrame([("a",), (None,)], "k string")
    listed = spark.createDataFrame([("a",), (None,)], "k string")
    assert rows(joins.membership(df, listed, ["k"], "m", "Yes", "No")) == [("a", "Yes"), (None, "No")]


def test_attach_refuses_repeated_keys_and_names(spark):
    base = spark.createDataFrame([("a",), ("b",)], "k string")
    twice = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    with pytest.raises(Exception, match="more than one row per k"):
        joins.attach(base, twice, ["k"]).collect()
    once = spark.createDataFrame([("a", 1)], "k string, v int")
    assert rows(joins.attach(base, once, ["k"])) == [("a", 1), ("b", None)]
    with pytest.raises(ValueError, match="both sides"):
        joins.attach(base.withColumn("v", F.lit(1)), once, ["k"])


def test_lenient_casts(spark):
    df = spark.createDataFrame([("3.7",), ("-3.7",), ("x",), ("",), (None,), ("NaN",), ("9999999999",)], "t string")
    assert [r[0] for r in df.select(cl.lenient_int("t")).collect()] == [3, -3, None, None, None, None, None]
    assert [r[0] for r in df.select(cl.lenient_double("t")).collect()] == [3.7, -3.7, None, None, None, None, 9999999999.0]


def test_text_repair_dates_and_flags(spark):
    df = spark.createDataFrame([("éàè�-�", "31/12/2019 00:00:00", "Y"), ("e", "2019-12-31", "N"), (None, None, None)],
                               "t string, d string, f string")
    got = df.select(cl.plain_e("t"), cl.day_month_year("d", CSV_TIMESTAMP_FORMATS), cl.yes_no("f")).collect()
    assert [tuple(r) for r in got] == [("eàee-�", date(2019, 12, 31), True), ("e", None, False), (None, None, None)]


def test_day_first_dates_in_other_spellings(spark):
    texts = ["1/2/2019 0:00:00", "01-02-2019 10:00:00", " 1.2.2019 1:2:3 ", "1-Feb-2019 00:00:00", "2/1", "31/02/2019 0:0:0"]
    df = spark.createDataFrame([(t,) for t in texts], "d string")
    got = [r[0] for r in df.select(cl.day_month_year("d", CSV_TIMESTAMP_FORMATS)).collect()]
    assert got == [date(2019, 2, 1)] * 4 + [None, None]


def test_bid_key_parts(spark):
    df = spark.createDataFrame([(2019, "H1", 7), (2019, None, 7)], "fiscal int, destination_no string, bid_line_no int")
    assert [r[0] for r in df.select(cl.bid_key()).collect()] == ["2019_H1_7", None]
    assert [r[0] for r in df.select(cl.bid_key(shift=1)).collect()] == ["2020_H1_7", None]
    keys = spark.createDataFrame([("2019_H1_7",), ("a_b_c",)], "key string")
    assert rows(keys.select(*cl.key_parts())) == [(2019, "H1", 7), (None, "b", None)]
    assert rows(keys.select(*cl.split_once("key", "c", "p"))) == [("2019", "H1_7"), ("a", "b_c")]


def test_cents_round_half_to_even(spark):
    df = spark.createDataFrame([(0.125,), (0.135,), (1.005,), (2.675000000001,), (-0.125,)], "x double")
    assert [r[0] for r in df.select(cl.cents("x")).collect()] == [0.12, 0.14, 1.0, 2.68, -0.12]


def test_percentile_interpolates(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 6)], "x double")
    low, high = df.agg(ag.percentile("x", 0.025), ag.percentile("x", 0.975)).first()
    assert (round(low, 6), round(high, 6)) == (1.1, 4.9)


def test_top_by_breaks_ties_and_skips_nulls(spark):
    df = spark.createDataFrame([("k", 2, 5.0), ("k", 1, 5.0), ("k", 0, None)], "k string, p int, s double")
    assert rows(df.groupBy("k").agg(ag.top_by("p", "s"))) == [("k", 1)]


def test_one_row_per_puts_missing_last(spark):
    df = spark.createDataFrame([("k", None, 1), ("k", "b", 2), ("k", "c", 0)], "k string, a string, v int")
    assert rows(joins.one_row_per(df, ["k"], [])) == [("k", "b", 2)]


def test_one_hot_align_and_reshape(spark):
    df = spark.createDataFrame([("a", "x"), ("b", None), ("c", "z")], "key string, t string")
    hot = reshape.one_hot(df, {"t": ["x", "y"]})
    assert rows(hot) == [("a", 1, 0), ("b", 0, 0), ("c", 0, 0)]
    like = spark.createDataFrame([], "t_y int, new string, key string")
    aligned = reshape.align_columns(hot, like)
    assert aligned.dtypes == like.dtypes and rows(aligned)[0] == (0, None, "a")
    wide = spark.createDataFrame([("a", 1.0, 2.0)], "key string, p double, q double")
    long = reshape.to_long(wide, ["key"])
    assert rows(long) == [("a", "p", 1.0), ("a", "q", 2.0)]
    assert rows(reshape.to_wide(long, ["key"], "variable", "value", ["p", "q"])) == [("a", 1.0, 2.0)]


def test_calendar_has_every_day(spark):
    groups = spark.createDataFrame([(2016, "AM")], "fiscal int, c string")
    assert joins.with_calendar(groups, "2015-01-01", "2019-12-31", "d").count() == 1826


def test_last_year_keeps_both_ends(spark):
    days = [date(2018, 2, 27), date(2018, 2, 28), date(2019, 2, 28), date(2019, 3, 1)]
    daily = spark.createDataFrame([("k", d) for d in days], "key string, d date")
    keys = spark.createDataFrame([("k", date(2019, 2, 28))], "key string, last date")
    assert rows(joins.within_last_year(daily, keys, "d", "last"), "d") == [(days[1],), (days[2],)]
