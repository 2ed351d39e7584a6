"""Feature groups on hand-made bids, and properties on the test data."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tenderlake.fixed_values import HOUSE_ID
from tenderlake.plans import bids as bid_plans
from tenderlake.plans import features, reference_table
from tests.conftest import rows
from workload import views
from workload.bid_queries import training_features

SCHEMA = (
    "fiscal int, destination_no string, bid_line_no int, price_competitor_id string, award_competitor_id string, "
    "committed_price_ty double, award_price_ty double, total_qty_ty double, min_purchase_qty_ty double, "
    "max_supply_qty_ty double, bid_due_date date, effective_date date, expiry_date date, rollover boolean, "
    "sales_region_name string, bid_type_name string, bid_name string, destination_state_prov string, "
    "destination_zip_postal string"
)
DAY = date(2019, 5, 1)


def offer(fiscal=2019, dest="H1", line=1, rival="CS", winner="CS", price=10.0, award=10.0, qty=5.0, low=1.0, high=2.0,
          due=DAY, start=DAY, end=DAY, rollover=False, region="R", kind="State", name="Regular", state="KS", zip="1"):
    return (fiscal, dest, line, rival, winner, price, award, qty, low, high, due, start, end, rollover, region, kind,
            name, state, zip)


@pytest.fixture()
def make(spark):
    def build(*offers):
        df = spark.createDataFrame(list(offers), SCHEMA)
        df = df.withColumns({"product_name": F.lit("Salt"), "customer_type_name": F.lit("City")})
        return bid_plans.intermediate_bids(df, spark.createDataFrame([("99",)], "destination_zip_postal string"))

    return build


def test_intermediate_filters(make):
    kept = make(offer(), offer(line=2, kind="Commercial"), offer(line=3, award=5000.0), offer(line=4, award=None),
                offer(line=5, zip="99"), offer(line=6, zip=None), offer(dest=None))
    assert rows(kept, "key") == [("2019_H1_1",), ("2019_H1_6",)]


def test_target_and_scoring_years(make):
    table = make(offer(due=date(2019, 3, 1)), offer(line=2, due=date(2020, 3, 1)), offer(line=3, award=0.0),
                 offer(line=4, due=None))
    assert rows(bid_plans.target_table(table, 2019), "key") == [("2019_H1_1",)]
    assert rows(bid_plans.scoring_table(table, 2020), "key") == [("2019_H1_2",)]


def test_competitors_previous_year(make):
    table = make(offer(rival="CMP"), offer(rival="CS"), offer(rival=None), offer(rival="CS", price=11.0),
                 offer(line=2, rival=None), offer(line=3, rival="CMP"))
    assert rows(features.competitors_previous_year(table)) == [("2020_H1_1", 1, 0), ("2020_H1_2", 0, 1)]


def test_next_best_competitor(make):
    table = make(offer(rival="CMP", price=12.0, winner="CS"), offer(rival="CS", price=10.0, winner="CS"),
                 offer(rival="MS", price=11.0, winner="CS"), offer(line=2, rival="CS"))
    got = features.next_best_competitor(table).collect()
    assert len(got) == 1
    assert got[0].asDict() == {
        "key": "2020_H1_1", "nbc_committed_price_prevyr": 10.0, "min_price_gap_nbc": 0.0, "Is_cargill_nbc": 1,
        "Is_KplusS_nbc": 0, "cmp_committed_price_prevyr": 12.0, "Is_cmp_awarded_prevyr": 0,
        "cmp_nbc_pricediff_prevyr": 2.0}


def test_min_max_quantity_with_zero_quantity(make):
    table = make(offer(qty=0.0, high=3.0), offer(line=2, qty=4.0, low=1.0, high=None))
    assert rows(features.min_max_quantity(table)) == [("2019_H1_1", 0.0, None, None, 1), ("2019_H1_2", 4.0, 0.25, None, 0)]


def test_region_movement_uses_the_two_years_before(make):
    table = make(offer(fiscal=2017, award=10.0, qty=1.0), offer(fiscal=2018, award=12.0, qty=1.0),
                 offer(fiscal=2019), offer(fiscal=2019, line=2, qty=0.0))
    got = rows(features.region_price_movement(table))
    assert [g[0] for g in got] == ["2019_H1_1", "2019_H1_2"]
    assert all(g[1] == 12.0 and g[2] == pytest.approx(0.2) for g in got)


def test_flags(make):
    table = make(offer(name="EMERGENCY salt", state="A"), offer(line=2, name="Not an emergency", state="B"),
                 offer(line=3, name=None, state="B"), offer(line=4, name="supplemental x", state=None))
    assert rows(features.bid_flags(table)) == [
        ("2019_H1_1", 1, True, False), ("2019_H1_2", 0, False, False), ("2019_H1_3", 0, None, None),
        ("2019_H1_4", None, False, True)]


def test_contract_days_with_missing_date(make):
    table = make(offer(start=date(2019, 1, 1), end=date(2019, 1, 11)), offer(line=2, end=None))
    assert rows(features.contract_timeframe(table)) == [("2019_H1_1", 10.0), ("2019_H1_2", None)]


def test_fill_rate_covers_all_due_dates_without_a_calendar(spark, sf_dir):
    bids = views.bids(spark, sf_dir).withColumn("bid_due_date", F.add_months("bid_due_date", 12 * 26))
    won = bids.where((F.col("price_competitor_id") == HOUSE_ID) & (F.col("award_competitor_id") == HOUSE_ID))
    won = won.where("fiscal is not null and bid_due_date is not null").select("key").distinct()
    assert features.fill_rate(bids).where("fill_rate_CMP is not null").select("key").join(won, "key").count() == won.count() > 0


def test_fill_rate_before_first_win_and_outside_the_calendar(make):
    calendar = ("2019-01-01", "2019-12-31")
    table = make(
        offer(rival="CMP", winner="CMP", qty=2.0, due=date(2019, 6, 1)),
        offer(line=2, rival="CMP", winner="CMP", qty=2.0, due=date(2019, 7, 1)),
        offer(line=3, rival="CS", winner="CS", due=date(2019, 3, 1)),
        offer(line=4, rival="CS", winner="CS", due=date(2020, 3, 1)),
        offer(line=5, rival="MS", winner="CS", due=date(2019, 3, 1)),
    )
    got = dict(rows(features.fill_rate(table, calendar)))
    assert got == {"2019_H1_1": pytest.approx(0.4), "2019_H1_2": pytest.approx(0.8), "2019_H1_3": 0.0}


def test_cluster_features(make, spark):
    table = make(offer(fiscal=2018, price=10.0), offer(fiscal=2018, price=10.0, rival="CMP"),
                 offer(fiscal=2018, line=2, price=40.0, award=30.0), offer(fiscal=2019), offer(fiscal=2019, line=9))
    clusters = spark.createDataFrame(
        [("2018_H1_1", 1), ("2018_H1_2", 1), ("2019_H1_1", 1)], "key string, cluster int")
    got = {r["key"]: r for r in features.cluster_features(table, clusters).collect()}
    assert got["2019_H1_1"][3:] == (20.0, 20.0, 2)
    assert got["2019_H1_9"]["cluster"] is None and got["2019_H1_9"][3:] == (None, None, None)
    assert got["2018_H1_1"][3:] == (None, None, None)


def test_reference_table_first_and_all_matches(make):
    table = make(
        offer(fiscal=2018, award=7.0, winner="CS"), offer(rival="CMP", price=12.0), offer(rival="CMP", price=13.0),
        offer(rival=None, price=20.0), offer(rival="MS", price=15.0),
    ).withColumns({c: F.lit("x") for c in ("customer_no", "customer_name", "destination_county_name")})
    first = reference_table.bid_reference_table(table).where("fiscal = 2019").collect()
    assert len(first) == 1
    row = first[0].asDict()
    assert (row["cmp_price"], row["top_competitor_id"], row["top_competitor_price"]) == (12.0, "MS", 20.0)
    assert (row["last_yr_award_price"], row["delta_awardprice_lastyr"], row["incumbent"]) == (7.0, 3.0, "CS")
    assert reference_table.bid_reference_table(table, matches="all").where("fiscal = 2019").count() == 2


def test_one_hot_key_matches_brute_force(spark):
    """A third of all offers in one key: same means as plain Python over distinct offers."""
    data = [offer(line=1 if i % 3 == 0 else i % 40 + 2, qty=float(i % 17), low=float(i % 5), high=float(i % 7))
            for i in range(3000)]
    table = spark.createDataFrame(data, SCHEMA).withColumn("key", F.concat_ws("_", "fiscal", "destination_no", "bid_line_no"))
    distinct = {}
    for r in data:
        distinct.setdefault(r[2], set()).add((r[8], r[9], r[7]))
    want = {f"2019_H1_{line}": sum(q for _, _, q in s) / len(s) for line, s in distinct.items()}
    got = dict(rows(features.min_max_quantity(table), "key", "total_qty_ty"))
    assert got == pytest.approx(want)


def test_feature_table_has_one_row_per_target(spark, sf_dir):
    table = training_features(spark, sf_dir).select("key", "fill_rate_CMP").cache()
    assert table.count() == table.select("key").distinct().count()
    target = bid_plans.target_table(views.bids(spark, sf_dir), 2000)
    assert table.count() == target.count()


def test_repeated_feature_names_are_refused(spark, sf_dir):
    bids = views.bids(spark, sf_dir)
    target = bid_plans.target_table(bids, 2000).withColumn("rollover", F.lit(True))
    with pytest.raises(ValueError, match="both sides"):
        features.feature_table(target, bids, views.clusters(spark, sf_dir), views.CALENDAR,
                               ["key", "date", "target", "rollover"])


def test_fill_rate_grows_and_stays_under_capacity(spark, sf_dir):
    daily = features.daily_fill_rate(views.bids(spark, sf_dir), views.CALENDAR).toPandas()
    daily = daily.sort_values(["fiscal", "price_competitor_id", "bid_due_date"])
    steps = daily.groupby(["fiscal", "price_competitor_id"])["fill_rate"].diff().dropna()
    assert (steps >= -1e-12).all()
    assert daily["fill_rate"].max() <= 0.8 + 1e-9
