"""Model queries: price models on the feature table, a churn model on the invoice keys."""

from __future__ import annotations

from datetime import date

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tenderlake.operators.reshape import align_columns
from tenderlake.plans import modeling, scorecard, trees
from tenderlake.storage import new_path
from workload import bid_queries
from workload.bid_queries import AWARDED, COSTS, DESTINATION, KEY_ROWS, scoring_features, training_features
from workload.sqltext import KEYS_CTE, over_bids, over_invoices
from workload.views import RUN_YEAR, invoices, scorecard_keys, written

START, MONTHS = date(2000, 4, 1), 8
TEST = (date(2000, 4, 1), date(2000, 5, 1))
TREES, DEPTH, ROUNDS = 20, 5, 10
# The forest that prices the run year.
RUN_TREES, RUN_DEPTH = 100, 10
CHURN_CLASSES = [
    ("Order pattern", "gap"), ("Volume", "quantity"), ("Volume", "lines"), ("Margin", "profit"),
    ("Price", "price"), ("Segment", "segment"),
]


def model_table(s, d):
    """Training features, cleaned and written once."""
    return written(s, d, "model-table", lambda: modeling.clean_model_table(training_features(s, d)))


_FITTED: dict[tuple, tuple] = {}


def fitted(s, d, name, estimator):
    """A model fitted on the rows before the test month, kept for the queries that share it."""
    slot = (s.sparkContext.applicationId, d, name)
    if slot not in _FITTED:
        _FITTED[slot] = modeling.fit_fold(model_table(s, d), *TEST, estimator)
    return _FITTED[slot]


def forest(s, d):
    return fitted(s, d, "forest", modeling.random_forest(TREES, DEPTH))


def boosted(s, d):
    return fitted(s, d, "boosted", modeling.boosted_trees(ROUNDS))


def linear(s, d):
    return fitted(s, d, "linear", modeling.linear_regression())


def forest_trees(s, d):
    _, model, scored = forest(s, d)
    return trees.tree_price_rows(trees.with_tree_prices(scored, trees.node_table(model, s)))


def linear_fit(s, d):
    _, model, scored = linear(s, d)
    return modeling.coefficients(model, modeling.vector_names(scored), s).withColumn(
        "r2", F.lit(modeling.r_squared(scored)).cast("double")
    )


def one_variable_fit(s, d):
    """Target on the destination's price of last year."""
    rows = model_table(s, d).select("target", "avg_awardprice_destination_prevyear").dropna()
    prepared = VectorAssembler(inputCols=["avg_awardprice_destination_prevyear"], outputCol="features").transform(rows)
    model = modeling.linear_regression().fit(prepared)
    return modeling.coefficients(model, ["slope"], s).withColumn(
        "r2", F.lit(modeling.r_squared(model.transform(prepared))).cast("double")
    )


def importance(s, d):
    _, model, scored = forest(s, d)
    return modeling.importance(model, modeling.vector_names(scored), s)


def tuned(s, d):
    train, test = modeling.split_by_time(model_table(s, d), *TEST)
    prepare = modeling.preparation(train).fit(train)
    model = modeling.tuned_boosting(prepare.transform(train), (2, 3), (5,), (0.05, 0.1), parallelism=4)
    return modeling.metrics(model.transform(prepare.transform(test)))


def run_backtest(s, d):
    return modeling.backtest(
        model_table(s, d), START, MONTHS, lambda: modeling.boosted_trees(ROUNDS), parallelism=4
    )


def split_sizes(s, d):
    """Training and test rows of every fold, counted in one pass."""
    day = F.col("date")
    spans = modeling.months_from(START, MONTHS)
    sizes = [
        F.struct(
            F.lit(first).alias("fold"),
            F.count_if(day < F.lit(first)).alias("train_rows"),
            F.count_if((day >= F.lit(first)) & (day < F.lit(after))).alias("test_rows"),
        )
        for first, after in spans
    ]
    return model_table(s, d).agg(F.array(*sizes).alias("folds")).select(F.inline("folds"))


def filled_table(s, d):
    table = model_table(s, d)
    prepared = modeling.preparation(table).fit(table).transform(table)
    return prepared.select("key", *[
        F.col(c + modeling.FILLED).alias(c) for c in ("equipment_cost_ty", "avg_awardprice_destination_prevyear")
    ])


def given_prediction_errors(s, d):
    rows = model_table(s, d).withColumn(modeling.PREDICTION, F.col("avg_awardprice_destination_prevyear"))
    return modeling.metrics(rows.dropna(subset=[modeling.PREDICTION]), ["fiscal"])


def churn_table(s, d):
    """One row per customer and family; the target is no invoice in the last year of the data."""

    def build():
        rows = invoices(s, d)
        last = rows.agg(F.max("billing_date"))
        totals = rows.groupBy("key").agg(
            F.sum("inv_delivered_gp").alias("profit"),
            F.sum("quantity").alias("quantity"),
            F.count("*").cast("double").alias("lines"),
            F.avg(F.try_divide("inv_delivered_gp", "quantity")).alias("price_level"),
            F.min("uic_industry_group_name").alias("segment"),
        )
        gaps = scorecard_keys(s, d).withColumnsRenamed({"diff_mean": "gap_mean", "diff_std": "gap_std"})
        quiet = F.datediff(last.scalar(), "last_trx_date") > 365
        table = totals.join(gaps, "key").withColumn("target", F.when(quiet, 1.0).otherwise(0.0))
        return table.drop("last_trx_date")

    return written(s, d, "churn-table", lambda: modeling.clean_model_table(build()))


def churn(s, d, boosted_model=False):
    slot = (s.sparkContext.applicationId, d, "churn", boosted_model)
    if slot not in _FITTED:
        table = churn_table(s, d)
        prepare = modeling.preparation(table).fit(table)
        model = modeling.fit_prepared(modeling.churn_classifier(10, 4, boosted_model), prepare.transform(modeling.spread(table)))
        _FITTED[slot] = (model, modeling.class_one_probability(model.transform(prepare.transform(table))))
    return _FITTED[slot]


def churn_contributions(s, d):
    model, scored = churn(s, d)
    return trees.explain_model(scored, model, modeling.vector_names(scored))


def churn_margins(s, d):
    model, scored = churn(s, d, True)
    return trees.explain_model(scored, model, modeling.vector_names(scored))


def churn_drivers(s, d):
    model, scored = churn(s, d)
    names = modeling.vector_names(scored)
    pairs = scorecard.feature_classes(names, CHURN_CLASSES)
    return scorecard.top_drivers(trees.explain_model(scored, model, names), pairs, 3)


def run_year_prices(s, d):
    """Every key of the run year, priced by a forest that was fitted on all keys before it."""

    def build():
        table = model_table(s, d)
        model = Pipeline(stages=[modeling.preparation(table), modeling.random_forest(RUN_TREES, RUN_DEPTH)]).fit(table)
        keys = modeling.clean_model_table(align_columns(scoring_features(s, d), table.drop("date", "target")))
        return trees.price_in_ranges(model, written(s, d, "run-year-features", lambda: keys), new_path(s, "run-year"), 4)

    slot = (s.sparkContext.applicationId, d, "run-year")
    if slot not in _FITTED:
        _FITTED[slot] = build()
    return _FITTED[slot]


def price_checks(prices):
    """Keys, and those whose prices are missing, out of order, or not above their margins by one cost."""
    cost = F.col("Predicted_price") - F.col("estimated_margin")
    apart = (F.abs(F.col("error_down_95") - F.col("margin_lower") - cost) > 1e-6) | (F.abs(F.col("error_up_95") - F.col("margin_upper") - cost) > 1e-6)
    return prices.agg(
        F.count("*").alias("rows"), F.count_distinct("key").alias("keys"),
        F.count_if(F.col("Predicted_price").isNull() | F.col("estimated_margin").isNull()).alias("missing"),
        F.count_if(F.col("error_down_95") > F.col("error_up_95")).alias("out_of_order"), F.count_if(apart).alias("apart"),
    )


def tree_checks(s, d):
    """Keys and trees of the test month, and keys whose price is not the mean of their trees."""
    means = forest_trees(s, d).groupBy("key").agg(F.count("*").alias("n"), F.avg("price").alias("mean"))
    met = forest(s, d)[2].select("key", "Predicted_price").join(means, "key", "left")
    return met.agg(
        F.count("*").alias("keys"), F.min("n").alias("least_trees"), F.max("n").alias("most_trees"),
        F.count_if(~(F.abs(F.col("mean") - F.col("Predicted_price")) < 1e-6)).alias("apart"),
    )


def contribution_checks(s, d):
    """Keys of the test month, and keys whose contributions do not add up to the boosted price."""
    _, model, scored = boosted(s, d)
    root = trees.root_value(trees.node_table(model, s), trees.tree_weights(model))
    parts = trees.explain_model(scored, model, modeling.vector_names(scored))
    added = parts.groupBy("key").agg(F.sum("contribution").alias("added"))
    gap = F.abs(F.coalesce("added", F.lit(0.0)) + F.lit(root) - F.col("Predicted_price"))
    return scored.join(added, "key", "left").agg(F.count("*").alias("keys"), F.count_if(~(gap < 1e-6)).alias("apart"))


def backtest_checks(s, d):
    """Predictions of every fold, and those without a price or outside their month."""
    found = run_backtest(s, d)[0]
    outside = (F.col("date") < F.col("fold")) | (F.col("date") >= F.add_months("fold", 1))
    return found.groupBy("fold").agg(
        F.count("*").alias("test_rows"), F.count_if(F.col("Predicted_price").isNull() | outside).alias("wrong")
    )


def metric_checks(s, d):
    """For each model of the test month: rows, and whether its errors agree with each other."""
    found = None
    for name, build in (("boosted", boosted), ("forest", forest), ("linear", linear)):
        errors = modeling.metrics(build(s, d)[2]).withColumn("model", F.lit(name))
        errors = errors.withColumn("agree", (F.abs(F.col("accuracy") + F.col("mape") - 100) < 1e-6) & (F.col("mae") * F.col("mae") <= F.col("mse") + 1e-6))
        found = errors if found is None else found.unionByName(errors)
    return found.select("model", "agree")


def importance_checks(s, d):
    """Shares below zero or above one; shares to two decimals add up to one within their rounding."""
    shares = importance(s, d)
    return shares.agg(
        F.count_if((F.col("importance") < 0) | (F.col("importance") > 1)).alias("out_of_range"),
        (F.abs(F.sum("importance") - 1) <= 0.005 * F.count("*")).alias("adds_up"),
    )


MODEL_ROWS = f"""
model_rows as (select k.key, k.date, k.target, d.avg_awardprice_destination_prevyear, c.equipment_cost_ty,
    k.fiscal as fiscal_year
  from key_table k left join destination_prices d on k.key = d.key left join costs c on k.key = c.key
  where year(k.date) <= {RUN_YEAR - 1})
"""
MODEL_PARTS = [AWARDED, KEY_ROWS, DESTINATION, COSTS, MODEL_ROWS]
FOLDS = ", ".join(f"(date '{a}', date '{b}')" for a, b in modeling.months_from(START, MONTHS))
IN_TEST = f"date >= date '{TEST[0]}' and date < date '{TEST[1]}'"
METRICS = ["mae", "mse", "mape", "accuracy"]

QUERIES = {
    "time_split_sizes": (split_sizes, over_bids(*MODEL_PARTS, f"""
        select f.fold, count(*) filter (m.date < f.fold) as train_rows,
          count(*) filter (m.date >= f.fold and m.date < f.after) as test_rows
        from model_rows m cross join (values {FOLDS}) f(fold, after) group by f.fold"""), []),
    "mean_filled_columns": (filled_table, over_bids(*MODEL_PARTS, """
        select key, coalesce(equipment_cost_ty, avg(equipment_cost_ty) over ()) as equipment_cost_ty,
          coalesce(avg_awardprice_destination_prevyear, avg(avg_awardprice_destination_prevyear) over ())
            as avg_awardprice_destination_prevyear from model_rows"""),
        ["equipment_cost_ty", "avg_awardprice_destination_prevyear"]),
    "one_variable_regression": (one_variable_fit, over_bids(*MODEL_PARTS, """
        f as (select regr_slope(target, avg_awardprice_destination_prevyear) as a,
            regr_intercept(target, avg_awardprice_destination_prevyear) as b,
            regr_r2(target, avg_awardprice_destination_prevyear) as r2 from model_rows)""", """
        select 'slope' as feature, a as coefficient, r2 from f
        union all select 'intercept', b, r2 from f"""), ["coefficient", "r2"]),
    "error_metrics": (given_prediction_errors, over_bids(*MODEL_PARTS, bid_queries.PRICED, """
        p as (select fiscal_year as fiscal, target, avg_awardprice_destination_prevyear as p
          from model_rows where avg_awardprice_destination_prevyear is not null)""", """
        select cast(fiscal as double) as fiscal, avg(abs(p - target)) as mae, avg((p - target) * (p - target)) as mse,
          avg(100 * abs(p - target) / target) as mape, 100 - avg(100 * abs(p - target) / target) as accuracy
        from p group by fiscal"""), METRICS),
    "model_linear": (linear_fit, None, []),
    "model_forest_metrics": (lambda s, d: modeling.metrics(forest(s, d)[2]), None, []),
    "model_boosted_metrics": (lambda s, d: modeling.metrics(boosted(s, d)[2]), None, []),
    "model_grid_search": (tuned, None, []),
    "feature_importance": (importance, None, []),
    "backtest_predictions": (lambda s, d: run_backtest(s, d)[0], None, []),
    "backtest_importance": (lambda s, d: run_backtest(s, d)[1], None, []),
    "tree_predictions": (forest_trees, None, []),
    "price_recommendation": (
        lambda s, d: trees.price_recommendation(forest(s, d)[2], trees.node_table(forest(s, d)[1], s)), None, []),
    "boosted_contributions": (
        lambda s, d: trees.explain_model(
            boosted(s, d)[2], boosted(s, d)[1], modeling.vector_names(boosted(s, d)[2])), None, []),
    "run_year_prices": (run_year_prices, None, []),
    "run_year_price_checks": (
        lambda s, d: price_checks(run_year_prices(s, d)),
        over_bids(AWARDED, KEY_ROWS, f"""select count(*) as rows, count(distinct key) as keys, cast(0 as bigint) as missing,
          cast(0 as bigint) as out_of_order, cast(0 as bigint) as apart from key_table where year(date) = {RUN_YEAR}"""), []),
    "price_recommendation_checks": (
        lambda s, d: price_checks(trees.price_recommendation(forest(s, d)[2], trees.node_table(forest(s, d)[1], s))),
        over_bids(*MODEL_PARTS, f"""select count(*) as rows, count(distinct key) as keys, cast(0 as bigint) as missing,
          cast(0 as bigint) as out_of_order, cast(0 as bigint) as apart from model_rows where {IN_TEST}"""), []),
    "tree_prediction_checks": (tree_checks, over_bids(*MODEL_PARTS, f"""
        select count(*) as keys, cast({TREES} as bigint) as least_trees, cast({TREES} as bigint) as most_trees,
          cast(0 as bigint) as apart from model_rows where {IN_TEST}"""), []),
    "boosted_contribution_checks": (contribution_checks, over_bids(*MODEL_PARTS, f"""
        select count(*) as keys, cast(0 as bigint) as apart from model_rows where {IN_TEST}"""), []),
    "backtest_checks": (backtest_checks, over_bids(*MODEL_PARTS, f"""
        select f.fold, count(*) as test_rows, cast(0 as bigint) as wrong
        from model_rows m join (values {FOLDS}) f(fold, after) on m.date >= f.fold and m.date < f.after group by f.fold"""), []),
    "model_metric_checks": (
        metric_checks, "select * from (values ('boosted', true), ('forest', true), ('linear', true)) t(model, agree)", []),
    "importance_checks": (importance_checks, "select cast(0 as bigint) as out_of_range, true as adds_up", []),
    "churn_labels": (
        lambda s, d: churn_table(s, d).groupBy("target").agg(F.count("*").alias("keys")),
        over_invoices(KEYS_CTE, """select case when (select max(billing_date) from invoices) - last_trx_date > 365
          then 1.0 else 0.0 end as target, count(*) as keys from score_keys group by 1"""), ["target"]),
    "churn_probability": (lambda s, d: churn(s, d)[1].select("key", "churn_prob"), None, []),
    "churn_probability_boosted": (lambda s, d: churn(s, d, True)[1].select("key", "churn_prob"), None, []),
    "churn_contributions": (churn_contributions, None, []),
    "churn_margin_contributions": (churn_margins, None, []),
    "churn_top_drivers": (churn_drivers, None, []),
}
