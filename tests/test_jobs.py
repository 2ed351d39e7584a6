"""The steps one after the other, from CSV files to prices and outputs."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tenderlake import jobs
from tenderlake.plans import churn
from tenderlake.sources import tables
from workload import scorecard_queries as scq
from workload import views


@pytest.fixture(scope="module")
def run(spark, sf_dir, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("run"))
    run = jobs.Run(spark, base, date(2001, 1, 15), views.CALENDAR)
    raw = views.raw_bids(spark, sf_dir)
    text = raw.withColumns({
        **{c: F.date_format(c, "dd/MM/yyyy HH:mm:ss") for c in ("bid_due_date", "effective_date", "expiry_date")},
        "rollover": F.when(F.col("rollover"), "Y").otherwise("N"),
    })
    tables.export_csv(text.toDF(*[c.upper() for c in text.columns]), f"{base}/csv")
    views.unserved(spark, sf_dir).write.parquet(run.name("raw_data", "unserved_zip_codes", False))
    views.clusters(spark, sf_dir).write.parquet(run.name("static_input", "static_cluster_mapping", False))
    views.bids(spark, sf_dir).select("key").distinct().write.parquet(run.name("static_input", "important_keys", False))
    return run


def test_steps(run, spark, sf_dir):
    jobs.import_bids(run, f"{run.base}/csv")
    jobs.build_features(run)
    training = run.read("processed_data", "bid_features_table")
    target = run.read("intermediate_data", "bid_target")
    assert training.count() == target.count() > 0
    assert training.columns[:3] == ["key", "date", "target"] and len(set(training.columns)) == len(training.columns)
    # The CSV round trip changes no bid.
    again = run.read("intermediate_data", "all_bid_table_intrmdt")
    direct = views.bids(spark, sf_dir)
    columns = ["key", "bid_due_date", "rollover", "committed_price_ty", "award_price_ty", "price_competitor_id"]
    assert again.select(columns).exceptAll(direct.select(columns)).count() == 0
    assert again.count() == direct.count()

    jobs.train_prices(run, date(2000, 4, 1), 2, trees_count=4, rounds=2, depth=3)
    prices = run.read("exports", "price_recomm")
    assert prices.where("error_down_95 > error_up_95").count() == 0 and prices.count() > 0
    assert run.read("exports", "price_alltreepredictions").count() == 4 * prices.count()
    assert tables.read_csv(spark, run.name("exports", "Predictions")).count() > 0
    matrix = tables.read_csv(spark, run.name("exports", "price_tree_matrix"))
    assert matrix.columns == ["key", "date", "target", "Predicted_price", "0", "1", "2", "3"]
    assert matrix.count() == prices.count()
    jobs.score_prices(run)
    scored = run.read("scoring_data", "price_recomm")
    assert scored.count() == run.read("scoring_data", "bid_scoring").count() > 0
    assert scored.where("Predicted_price is null or error_down_95 > error_up_95").count() == 0

    jobs.build_dashboard(run)
    assert run.read("dashboard", "price_recommendation").count() == 3 * prices.count()
    keys = run.read("dashboard", "keys")
    assert keys.count() == prices.count()
    some = keys.first()
    assert jobs.export_choices(run, fiscal=some["fiscal"], destination=some["destination"]).count() >= 1
    jobs.export_columns(run, "processed_data", "bid_features_table", ["key", "num_competitors_prevyear"])
    assert tables.read_csv(spark, run.name("exports", "bid_features_table")).columns == ["key", "num_competitors_prevyear"]


def test_scorecard_outputs(run, spark, sf_dir):
    def put(df, schema, name):
        df.write.parquet(run.name(schema, name, False))

    view = lambda text: views.view(spark, sf_dir, text)
    put(views.scorecard_keys(spark, sf_dir), "scoring_data", "scoring")
    put(views.invoices(spark, sf_dir), "scoring_data", "dm_invoice_features")
    put(views.invoices(spark, sf_dir), "raw_data", "invoice_table")
    put(view(views.SALES_ORDERS_SQL), "raw_data", "sales_order_otif_table")
    put(view(views.FAMILY_MAP_SQL), "static_input", "prod_dm_table")
    put(view(views.CUSTOMER_MAP_SQL), "static_input", "cust_rep_mapping")
    put(view(views.PRODUCT_MAP_SQL), "static_input", "product_names")
    put(view(views.PROGRAM_SQL), "static_input", "CPP_table")
    put(view(views.CALLS_SQL), "raw_data", "salescall_table")
    put(view(views.CASES_SQL), "raw_data", "service_case")
    put(view(views.SALES_HIERARCHY_SQL), "static_input", "fi_sales_hrchy_table")
    written = jobs.build_scorecard(
        run, scq.scores(spark, sf_dir), scq.drivers(spark, sf_dir), "fi", *views.SCORING_DATES,
        "2001-01-15-00.00.00", f"{run.base}/prod", f"{run.base}/dev",
    )
    rows = run.read("processed_data", "scorecard").count()
    assert rows > 0
    for kind, sep in (("full", ","), ("field", ","), ("dashboard", "|")):
        got = tables.read_csv(spark, written[kind], sep=sep)
        assert got.count() == rows and got.columns[0] == "AI_Source"
    assert written["dashboard"].endswith("/dev/ai.2001-01-15-00.00.00.bid_scored_sheet_2001_01_15.csv")


def test_churn_and_scorecard_steps(run, spark, sf_dir):
    """After `test_scorecard_outputs`, whose input tables these steps read."""
    day = run.run_date.isoformat()
    jobs.main("churn", run.base, day, "trees_count=8", "depth=3")
    held_out, training = run.read("processed_data", "churn_held_out"), run.read("processed_data", "churn_training")
    assert 0 < held_out.count() < training.count()
    # The customers that judge the model are not among those it was fitted on.
    seen = training.where(churn.customer_fold() != 0).select(F.split("key", "_")[0].alias("c"))
    assert held_out.select(F.split("key", "_")[0].alias("c")).join(seen, "c").count() == 0
    quality = run.read("processed_data", "churn_quality").first()
    assert quality["rows"] == held_out.count() and 0 <= quality["area_under_curve"] <= 1 and quality["log_loss"] > 0
    assert run.read("processed_data", "churn_calibration").agg(F.sum("rows")).first()[0] == quality["rows"]
    bundle = churn.load(spark, run.name("models", "churn_bundle"), run.run_date)
    assert [c for c, _ in bundle.columns][0] == "days_since" and {c for c, _, _ in bundle.categories} == {"segment"}
    with pytest.raises(ValueError, match="after the run"):
        churn.load(spark, run.name("models", "churn_bundle"), date(2000, 12, 31))
    with pytest.raises(ValueError, match="gap_mean is missing; lines is string, not double"):
        churn.matching(bundle, training.drop("gap_mean").withColumn("lines", F.lit("x")))

    jobs.main(
        "scorecard", run.base, day, "lob=lcd", f"order_start={views.SCORING_DATES[0]}", f"order_end={views.SCORING_DATES[1]}",
        "stamp=2001-01-15-00.00.00", f"prod_path={run.base}/prod", f"dev_path={run.base}/dev", "to_prod=yes",
    )
    scores = run.read("scoring_data", "churn_scores")
    assert scores.count() == run.read("scoring_data", "churn_snapshot").count() == scores.select("key").distinct().count() > 0
    assert scores.where("churn_prob is null or churn_prob < 0 or churn_prob > 1").count() == 0
    assert run.read("scoring_data", "churn_drivers").count() == scores.count()
    name = "ai.2001-01-15-00.00.00.bid_scored_sheet_2001_01_15.csv"
    published = tables.read_csv(spark, f"{run.base}/prod/{name}", sep="|")
    assert published.count() == run.read("processed_data", "scorecard").count() > 0


def test_values_the_model_has_not_seen(run, spark):
    bundle = churn.load(spark, run.name("models", "churn_bundle"))
    table = run.read("scoring_data", "churn_snapshot")
    assert churn.unknown_categories(bundle, table).count() == 0
    odd = table.withColumn("segment", F.when(F.col("days_since") > 0, "NEW").otherwise(F.lit(None).cast("string")))
    found = churn.unknown_categories(bundle, odd).collect()
    assert [(r["column"], r["value"], r["rows"]) for r in found] == [("segment", "NEW", odd.where("segment is not null").count())]
    assert churn.apply(bundle, odd).where("churn_prob is null").count() == 0
