"""The steps of a run, from bid CSVs to features, prices, scorecard and dashboard tables.

usage: spark-submit tenderlake/jobs.py STEP BASE RUN_DATE [name=value ...]
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.operators.reshape import align_columns, lookup
from tenderlake.plans import bids, churn, dashboard, features, modeling, reference_table, scorecard, trees
from tenderlake.sources import ingest, tables
from tenderlake.storage import tuned


@dataclass(frozen=True)
class Run:
    """Where tables live and which dates count.

    `base` is a folder (`s3a://bucket/bids`) or empty for catalog databases. Keys up to the year
    before the run are training keys, keys of the run's year are scored. Without a calendar the fill rate
    covers all due dates.
    """

    spark: SparkSession
    base: str
    run_date: date
    calendar: tuple[str, str] | None = None

    @property
    def scoring_year(self) -> int:
        return self.run_date.year

    @property
    def reference_year(self) -> int:
        return self.run_date.year - 1

    def name(self, schema: str, table: str, run_table: bool = True) -> str:
        full = tables.dated(table, self.run_date) if run_table else table
        return f"{self.base.rstrip('/')}/{schema}/{full}" if self.base else f"{schema}.{full}"

    def read(self, schema: str, table: str, run_table: bool = True) -> DataFrame:
        return tables.read_table(self.spark, self.name(schema, table, run_table))

    def write(self, df: DataFrame, schema: str, table: str, partition_by=()) -> DataFrame:
        """Replace the table and go on from what was written."""
        name = self.name(schema, table)
        tables.replace_table(df, name, partition_by)
        return tables.read_table(self.spark, name)


def import_bids(run: Run, csv_folder: str, encoding: str = "UTF-8") -> None:
    """CSV folder to the raw bid table."""
    run.write(ingest.import_bids(run.spark, csv_folder, encoding), "raw_data", "all_bid_table")


def build_features(run: Run) -> None:
    """Raw bids to cleaned bids, key tables and both feature tables."""
    raw = run.read("raw_data", "all_bid_table")
    unserved = run.read("raw_data", "unserved_zip_codes", False)
    clusters = run.read("static_input", "static_cluster_mapping", False)
    cleaned = run.write(
        bids.intermediate_bids(raw, unserved), "intermediate_data", "all_bid_table_intrmdt", ["fiscal"]
    )
    target = run.write(bids.target_table(cleaned, run.reference_year), "intermediate_data", "bid_target")
    scoring = run.write(bids.scoring_table(cleaned, run.scoring_year), "scoring_data", "bid_scoring")
    training = features.feature_table(target, cleaned, clusters, run.calendar)
    run.write(training, "processed_data", "bid_features_table")
    # Bid years and calendar years can differ, so the earliest fiscal year is looked up.
    first = scoring.agg(F.min("fiscal")).first()[0]
    scored = features.feature_table(scoring, cleaned, clusters, run.calendar, ["key"], first)
    run.write(scored, "processed_data", "bid_scoring_features")


def train_prices(run: Run, start: date, months: int, trees_count: int = 500, rounds: int = 5000, depth: int = 10) -> None:
    """Monthly backtest with boosted trees, then forest prices, intervals and the saved model."""
    table = run.write(
        modeling.clean_model_table(run.read("processed_data", "bid_features_table")), "processed_data", "model_table"
    )
    predictions, importance = modeling.backtest(table, start, months, lambda: modeling.boosted_trees(rounds))
    tables.export_csv(predictions, run.name("exports", "Predictions"))
    tables.export_csv(importance, run.name("exports", "FeatureImportance"))

    first, after = modeling.months_from(start, months)[-1]
    train, test = modeling.split_by_time(table, first, after)
    steps = [modeling.preparation(train), modeling.random_forest(trees_count, depth)]
    model = Pipeline(stages=steps).fit(train)
    tables.save_model(model, run.name("models", "bid_model"))
    scored = model.transform(test)
    nodes = trees.node_table(model.stages[-1], run.spark)
    run.write(trees.price_recommendation(scored, nodes), "exports", "price_recomm")
    priced = trees.with_tree_prices(scored, nodes)
    columns = ("key", "date", "target", "Predicted_price")
    run.write(trees.tree_price_rows(priced, columns), "exports", "price_alltreepredictions")
    tables.export_csv(trees.tree_price_columns(priced, trees_count, columns), run.name("exports", "price_tree_matrix"))


def score_prices(run: Run) -> None:
    """Prices of the run year's bids by the saved model, on the columns it was trained with."""
    trained_on = run.read("processed_data", "model_table").drop("date", "target")
    scoring = modeling.clean_model_table(run.read("processed_data", "bid_scoring_features"))
    model = tables.load_model(run.name("models", "bid_model"))
    scored = model.transform(align_columns(scoring, trained_on))
    nodes = trees.node_table(model.stages[-1], run.spark)
    run.write(trees.price_recommendation(scored, nodes), "scoring_data", "price_recomm")


def build_dashboard(run: Run) -> None:
    """Reference table and the tables behind the dashboard."""
    cleaned = run.read("intermediate_data", "all_bid_table_intrmdt")
    reference = run.write(reference_table.bid_reference_table(cleaned), "dashboard", "key_details")
    linked = reference_table.reference_tables(cleaned)
    # All offers and awards behind the details, as tables of their own.
    linked = reference_table.ReferenceTables(
        run.write(linked.details, "dashboard", "bid_details"),
        run.write(linked.house, "dashboard", "house_offers"),
        run.write(linked.awards, "dashboard", "last_year_awards"),
    )
    run.write(linked.links, "dashboard", "reference_links")
    clusters = run.read("static_input", "static_cluster_mapping", False)
    year = run.reference_year
    clustering = clusters.where(F.col("key").startswith(f"{year}_")).withColumnRenamed("cluster", "Cluster")
    tagged = dashboard.with_cluster(reference, clustering)
    run.write(tagged, "dashboard", "clustered_details")
    prices = run.read("exports", "price_recomm")
    tree_prices = run.read("exports", "price_alltreepredictions")
    important = run.read("static_input", "important_keys", False)
    run.write(dashboard.dashboard_keys([prices, reference, tree_prices, important]), "dashboard", "keys")
    by_category = run.write(dashboard.price_by_category(prices), "dashboard", "price_recommendation")
    run.write(dashboard.performance_table(by_category), "dashboard", "performance")


def export_columns(run: Run, schema: str, table: str, columns=("*",)) -> None:
    """A table, or some of its columns, as CSV."""
    tables.export_csv(run.read(schema, table).select(*columns), run.name("exports", table))


def export_choices(run: Run, **chosen) -> DataFrame:
    """Dashboard keys under the choices made so far."""
    return lookup(run.read("dashboard", "keys"), **chosen)


def build_scorecard(
    run: Run, scores: DataFrame, drivers: DataFrame, lob: str, order_start: str, order_end: str, stamp: str,
    prod_path: str, dev_path: str, to_prod: bool = False,
) -> dict[str, str]:
    """Scorecard of a line of business: full and field as CSV, dashboard published with pipes."""
    read = lambda schema, name: run.read(schema, name, False)
    inputs = scorecard.ScorecardInputs(
        scores=scores, drivers=drivers,
        score_keys=read("scoring_data", "scoring"), invoices=read("scoring_data", "dm_invoice_features"),
        orders=read("raw_data", "sales_order_otif_table"), products=read("static_input", "prod_dm_table"),
        customer_map=read("static_input", "cust_rep_mapping"), product_names=read("static_input", "product_names"),
        program=read("static_input", "CPP_table"), calls=read("raw_data", "salescall_table"),
        cases=read("raw_data", "service_case"), history=read("raw_data", "invoice_table"),
    )
    since = date(run.run_date.year - 3, run.run_date.month, min(run.run_date.day, 28))
    card = run.write(scorecard.scorecard(inputs, lob, since, order_start, order_end), "processed_data", "scorecard")
    hierarchy = read("static_input", "fi_sales_hrchy_table") if lob == "fi" else None
    outputs = scorecard.layouts(card, lob, hierarchy)
    file_name = tables.scored_file_name(run.run_date, stamp)
    written = {}
    for kind in ("full", "field"):
        written[kind] = run.name("exports", f"{kind}_scorecard")
        tables.export_csv(outputs[kind], written[kind])
    written["dashboard"] = tables.publish(outputs["dashboard"], prod_path, dev_path, file_name, to_prod)
    return written


def train_churn(run: Run, trees_count: int = 500, depth: int = 5, boosted: bool = False) -> None:
    """Snapshot of a year before the last invoice, a model fitted on some customers and judged on the others."""
    invoices = run.read("raw_data", "invoice_table", False)
    as_of = churn.training_date(invoices.agg(F.max("billing_date")).first()[0])
    table = run.write(churn.snapshot(invoices, as_of, churn.YEAR), "processed_data", "churn_training")
    bundle = churn.fit(table, run.run_date, as_of, trees_count, depth, boosted)
    churn.save(bundle, run.spark, run.name("models", "churn_bundle"))
    unseen = table.where(churn.customer_fold() == int(bundle.about["held_out"]))
    judged = run.write(churn.apply(bundle, unseen).select("key", "target", "churn_prob"), "processed_data", "churn_held_out")
    run.write(churn.quality(judged), "processed_data", "churn_quality")
    run.write(churn.calibration(judged), "processed_data", "churn_calibration")


def score_churn(run: Run, lob: str, order_start: str, order_end: str, stamp: str, prod_path: str, dev_path: str, to_prod: bool = False) -> dict[str, str]:
    """Scores and drivers of today's snapshot by the kept model, then the scorecard of a line of business."""
    bundle = churn.load(run.spark, run.name("models", "churn_bundle"), run.run_date)
    invoices = run.read("raw_data", "invoice_table", False)
    today = run.write(churn.snapshot(invoices, invoices.agg(F.max("billing_date")).first()[0]), "scoring_data", "churn_snapshot")
    run.write(churn.unknown_categories(bundle, today), "scoring_data", "churn_unknown_categories")
    scored = churn.apply(bundle, today)
    scores = run.write(scored.select("key", "churn_prob"), "scoring_data", "churn_scores")
    top = run.write(churn.drivers(bundle, scored), "scoring_data", "churn_drivers")
    return build_scorecard(run, scores, top, lob, order_start, order_end, stamp, prod_path, dev_path, to_prod)


STEPS: dict[str, Callable] = {
    "import": import_bids,
    "features": build_features,
    "prices": lambda run, start, months, **sizes: train_prices(
        run, date.fromisoformat(start), int(months), **{k: int(v) for k, v in sizes.items()}
    ),
    "score": score_prices,
    "churn": lambda run, boosted="no", **sizes: train_churn(
        run, boosted=boosted == "yes", **{k: int(v) for k, v in sizes.items()}
    ),
    "scorecard": lambda run, to_prod="no", **options: score_churn(run, to_prod=to_prod == "yes", **options),
    "dashboard": build_dashboard,
    "export": export_columns,
}


def main(step: str, base: str, run_date: str, *options: str) -> None:
    spark = tuned(SparkSession.builder.appName(f"tenderlake-{step}").getOrCreate())
    STEPS[step](Run(spark, base, date.fromisoformat(run_date)), **dict(o.split("=", 1) for o in options))


if __name__ == "__main__":
    main(*sys.argv[1:])
