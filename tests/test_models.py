"""Properties of models, tree predictions, intervals, contributions."""

from datetime import date

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tenderlake.operators.windows import win_probability
from tenderlake.plans import modeling, scorecard, trees
from workload import model_queries as q


def test_months():
    assert modeling.months_from(date(2019, 11, 1), 2) == [
        (date(2019, 11, 1), date(2019, 12, 1)), (date(2019, 12, 1), date(2020, 1, 1))]


def test_missing_and_unseen_categories_are_zero(spark):
    train = spark.createDataFrame([("a", 1.0, "x", 1.0, None), ("b", None, "y", 2.0, None)],
                                  "key string, n double, t string, target double, empty double")
    test = spark.createDataFrame([("c", None, "new", 0.0, 1.0), ("d", 5.0, None, 0.0, None)], train.schema)
    fitted = modeling.preparation(train).fit(train)
    out = fitted.transform(test)
    assert modeling.vector_names(out) == ["n", "t_x", "t_y"]
    assert [list(r[0]) for r in out.orderBy("key").select(vector_to_array("features")).collect()] == [
        [1.0, 0.0, 0.0], [5.0, 0.0, 0.0]]


def test_no_test_rows_have_no_r_squared(spark):
    scored = spark.createDataFrame([(1.0, 1.0), (3.0, 2.0)], f"target double, {modeling.PREDICTION} double")
    assert modeling.r_squared(scored.limit(0)) is None
    assert modeling.r_squared(scored) == pytest.approx(0.5)


def test_training_rows_are_spread_over_tasks(spark):
    rows = spark.range(100, numPartitions=2)
    assert modeling.spread(rows, 50).rdd.getNumPartitions() == 2
    wide = modeling.spread(rows, 10)
    assert [len(p) for p in wide.rdd.glom().collect()] == [10] * 10
    assert wide.distinct().count() == 100


def test_infinite_values_are_filled(spark):
    raw = spark.createDataFrame([("a", float("inf")), ("b", 3.0)], "key string, n double")
    table = modeling.clean_model_table(raw).withColumn("target", F.lit(1.0))
    out = modeling.preparation(table).fit(table).transform(table)
    assert {r["n_filled"] for r in out.collect()} == {3.0}


def test_mean_of_trees_is_the_forest_prediction(spark, sf_dir):
    _, model, scored = q.forest(spark, sf_dir)
    priced = trees.with_tree_prices(scored, trees.node_table(model, spark)).cache()
    long = trees.tree_price_rows(priced, ("key", "Predicted_price"))
    gaps = long.groupBy("key", "Predicted_price").agg(F.avg("price").alias("m"), F.count("*").alias("n")).collect()
    assert gaps and all(g["n"] == q.TREES and g["m"] == pytest.approx(g["Predicted_price"]) for g in gaps)
    got = trees.with_interval(priced).select("key", "error_down_95", "error_up_95").collect()
    exact = {r["key"]: r for r in long.groupBy("key").agg(
        F.percentile("price", F.lit(0.025)).alias("lo"), F.percentile("price", F.lit(0.975)).alias("hi")).collect()}
    for r in got:
        assert r["error_down_95"] <= r["error_up_95"]
        assert r["error_down_95"] == pytest.approx(exact[r["key"]]["lo"])
        assert r["error_up_95"] == pytest.approx(exact[r["key"]]["hi"])
    assert win_probability(long).where("win_probability = 100").count() == len(got)


def test_constants_of_single_trees_give_the_same_prices(spark, sf_dir):
    _, model, scored = q.forest(spark, sf_dir)
    nodes = trees.node_table(model, spark)
    sent = trees.tree_price_rows(trees.with_tree_prices(scored, nodes)).collect()
    joined = trees.tree_price_rows(trees.with_tree_prices(scored, nodes, most_nodes=1)).collect()
    assert sorted(map(tuple, sent)) == sorted(map(tuple, joined))


def test_boosted_tree_values_add_up(spark, sf_dir):
    _, model, scored = q.boosted(spark, sf_dir)
    weights = trees.tree_weights(model)
    long = trees.tree_price_rows(
        trees.with_tree_prices(scored, trees.node_table(model, spark)), ("key", "Predicted_price"))
    weight = F.get(F.array(*[F.lit(w) for w in weights]), F.col("tree_id"))
    sums = long.groupBy("key", "Predicted_price").agg(F.sum(F.col("price") * weight).alias("s")).collect()
    assert sums and all(r["s"] == pytest.approx(r["Predicted_price"]) for r in sums)


@pytest.mark.parametrize("name", ["forest", "boosted"])
def test_contributions_add_up_to_the_prediction(spark, sf_dir, name):
    _, model, scored = getattr(q, name)(spark, sf_dir)
    weights = trees.tree_weights(model)
    base = trees.root_value(trees.node_table(model, spark), weights)
    parts = trees.explain_model(scored, model, modeling.vector_names(scored))
    sums = parts.groupBy("key").agg(F.sum("contribution").alias("s"))
    for r in sums.join(scored.select("key", "Predicted_price"), "key").collect():
        assert base + r["s"] == pytest.approx(r["Predicted_price"])


def test_classifier_contributions_add_up_to_the_probability(spark, sf_dir):
    model, scored = q.churn(spark, sf_dir)
    base = trees.root_value(trees.node_table(model, spark), trees.tree_weights(model))
    parts = trees.explain_model(scored, model, modeling.vector_names(scored))
    sums = parts.groupBy("key").agg(F.sum("contribution").alias("s"))
    joined = sums.join(scored.select("key", "churn_prob"), "key")
    worst = joined.agg(F.max(F.abs(F.col("s") + F.lit(base) - F.col("churn_prob")))).first()[0]
    assert worst < 1e-9
    assert scored.where("churn_prob < 0 or churn_prob > 1").count() == 0


def test_boosted_classifier_contributions_add_up_to_the_margin(spark, sf_dir):
    model, scored = q.churn(spark, sf_dir, True)
    base = trees.root_value(trees.node_table(model, spark), trees.tree_weights(model))
    parts = trees.explain_model(scored, model, modeling.vector_names(scored))
    sums = parts.groupBy("key").agg(F.sum("contribution").alias("s"))
    margins = scored.select("key", vector_to_array("rawPrediction")[1].alias("m"), "churn_prob")
    gap = F.abs(F.col("s") + F.lit(base) - F.col("m"))
    chance = F.abs(1 / (1 + F.exp(-2 * F.col("m"))) - F.col("churn_prob"))
    worst = sums.join(margins, "key").agg(F.max(gap), F.max(chance)).first()
    assert worst[0] < 1e-9 and worst[1] < 1e-9


def test_contributions_are_summed_in_the_row(spark, sf_dir, capsys):
    _, model, scored = q.boosted(spark, sf_dir)
    nodes, weights = trees.node_table(model, spark), trees.tree_weights(model)
    names = modeling.vector_names(scored)
    paths = trees.path_table(nodes, names, weights, model.getMaxDepth())
    options = (nodes, paths, len(names), len(weights), 2 ** model.getMaxDepth())
    whole = trees.with_contributions(scored.select("key", "leaf"), *options)
    whole.select("key", "contributions").explain("formatted")
    # The constants are shuffled by tree; no exchange or explosion is on the rows' own way.
    plan = capsys.readouterr().out.split("===== Subqueries =====")[0]
    assert "Exchange" not in plan and "Generate" not in plan
    ranges = trees.with_contributions(scored.select("key", "leaf"), *options, most_values=1)
    for a, b in zip(*[sorted(map(tuple, x.select("key", "contributions").collect())) for x in (whole, ranges)]):
        assert a[0] == b[0] and a[1] == pytest.approx(b[1])


def test_pricing_goes_on_where_it_stopped(spark, sf_dir, tmp_path):
    table = q.model_table(spark, sf_dir)
    model = Pipeline(stages=[modeling.preparation(table), modeling.random_forest(3, 3)]).fit(table)
    folder = str(tmp_path / "prices")
    first = trees.price_in_ranges(model, table, folder, 4)
    assert first.select("key").exceptAll(table.select("key")).count() == 0 and first.count() == table.count()
    kept = (tmp_path / "prices" / "range-00002").stat().st_mtime_ns
    (tmp_path / "prices" / "range-00001" / "_SUCCESS").unlink()
    again = trees.price_in_ranges(model, table, folder, 4)
    assert (tmp_path / "prices" / "range-00002").stat().st_mtime_ns == kept
    assert (tmp_path / "prices" / "range-00001" / "_SUCCESS").exists() and again.count() == table.count()


def test_backtest_has_every_fold(spark, sf_dir):
    table = q.model_table(spark, sf_dir)
    predictions, importance = modeling.backtest(table, q.START, 2, lambda: modeling.boosted_trees(2), 2)
    want = {first: table.where(F.col("date").between(first, after) & (F.col("date") < F.lit(after))).count()
            for first, after in modeling.months_from(q.START, 2)}
    assert {r["fold"]: r["count"] for r in predictions.groupBy("fold").count().collect()} == want
    assert importance.select("fold").distinct().count() == 2
    metrics = modeling.metrics(predictions).first()
    assert metrics["mae"] > 0 and metrics["accuracy"] == pytest.approx(100 - metrics["mape"])


def test_forest_is_stable_for_a_seed(spark, sf_dir):
    table = q.model_table(spark, sf_dir)
    fits = [modeling.fit_fold(table, *q.TEST, modeling.random_forest(3, 3))[2] for _ in range(2)]
    first, second = [sorted((r["key"], r["Predicted_price"]) for r in f.collect()) for f in fits]
    assert first == second


def test_driver_classes(spark):
    pairs = scorecard.feature_classes(["gap_mean", "gap_std", "price"], [("Gap", " gap_ "), ("Price", "price")])
    assert pairs == [("Gap", "gap_mean"), ("Gap", "gap_std"), ("Price", "price")]
    data = spark.createDataFrame(
        [("k", "gap_mean", 0.5), ("k", "gap_std", -2.0), ("k", "price", 0.6)],
        "key string, feature string, contribution double")
    assert scorecard.top_drivers(data, pairs, 2).first().asDict() == {
        "key": "k", "Top Driver 1": "Price", "Top Driver 2": "Gap"}
