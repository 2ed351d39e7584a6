"""Per-tree predictions, price intervals and path contributions of tree ensembles.

A model's nodes form a table of at most trees x 2^(depth+1) rows; everything broadcast here has
that bound, whatever the number of scored rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenderlake.functions.columns import ratio
from tenderlake.storage import completed, materialize, new_path

BROADCAST_NODES = 2_000_000


def node_table(model, spark: SparkSession) -> DataFrame:
    """Nodes of a fitted ensemble: tree, node, value, children, split feature.

    The value is the prediction, or the share of class 1 for a random forest classifier.
    """
    path = new_path(spark, "model")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree_id"), "nodeData.*")
    if type(model).__name__ == "RandomForestClassificationModel":
        votes = F.aggregate("impurityStats", F.lit(0.0), lambda total, x: total + x)
        value = ratio(F.col("impurityStats")[1], votes)
    else:
        value = F.col("prediction")
    return nodes.select(
        "tree_id", F.col("id").alias("node"), value.alias("value"),
        F.col("leftChild").alias("left"), F.col("rightChild").alias("right"),
        F.col("split.featureIndex").alias("feature_index"),
    )


def tree_weights(model) -> list[float]:
    """Weight of each tree in the ensemble's value: boosting weights, or equal parts of a mean."""
    if type(model).__name__.startswith("GBT"):
        return [float(w) for w in model.treeWeights]
    return [1.0 / model.getNumTrees] * model.getNumTrees


def leaf_table(nodes: DataFrame) -> DataFrame:
    """Leaves with their number in the leaf vector: 0-based, in node order within a tree."""
    order = Window.partitionBy("tree_id").orderBy("node")
    return nodes.where(F.col("left") < 0).withColumn("leaf", F.row_number().over(order) - 1)


def leaf_values(nodes: DataFrame) -> DataFrame:
    """One row: for every tree, in order, the array of its leaf values."""
    per_tree = leaf_table(nodes).groupBy("tree_id").agg(
        F.sort_array(F.collect_list(F.struct("leaf", "value"))).alias("leaves")
    )
    values = F.transform("leaves", lambda x: x["value"])
    trees = per_tree.agg(F.sort_array(F.collect_list(F.struct("tree_id", values.alias("values")))).alias("trees"))
    return trees.select(F.transform("trees", lambda x: x["values"]).alias("values"))


def _tree_ranges(trees: int, each: int) -> list[tuple[int, int]]:
    """Ranges (first, end) of at most `each` trees, or one, that cover all of them."""
    each = max(1, each)
    return [(first, min(first + each, trees)) for first in range(0, trees, each)]


def with_tree_prices(
    scored: DataFrame, nodes: DataFrame, name: str = "tree_prices", most_nodes: int = BROADCAST_NODES
) -> DataFrame:
    """Add the array of every tree's prediction from the scored leaf vector.

    Leaf values are constants sent to every task, each for as many trees as hold `most_nodes` nodes
    (at least one), so that no row is multiplied or shuffled, whatever the model's size.
    """
    leaves = vector_to_array("leaf").cast("array<int>")
    sizes = nodes.groupBy("tree_id").agg(F.count("*").alias("n")).agg(F.count("*"), F.max("n")).first()
    parts = []
    for first, end in _tree_ranges(sizes[0], most_nodes // max(sizes[1] or 1, 1)):
        values = leaf_values(nodes.where(F.col("tree_id").between(first, end - 1))).scalar()
        column = f"_values_{first}"
        scored = scored.withColumn(column, values)
        own = F.slice(leaves, F.lit(first + 1), F.lit(end - first))
        parts.append((column, F.zip_with(own, column, lambda leaf, tree: F.get(tree, leaf))))
    prices = F.concat(*[p for _, p in parts]) if parts else F.array().cast("array<double>")
    return scored.withColumn(name, prices).drop(*[c for c, _ in parts])


def tree_price_rows(priced: DataFrame, columns: Sequence[str] = ("key",)) -> DataFrame:
    """The long table: one row per key and tree."""
    return priced.select(*columns, F.posexplode("tree_prices").alias("tree_id", "price"))


def tree_price_columns(priced: DataFrame, trees: int, columns: Sequence[str] = ("key",)) -> DataFrame:
    """The wide table: the given columns, then one column per tree named by its number."""
    return priced.select(*columns, *[F.get("tree_prices", F.lit(i)).alias(str(i)) for i in range(trees)])


def array_percentile(ordered: str, share: float) -> Column:
    """Percentile of a sorted array with linear interpolation."""
    place = (F.size(ordered) - 1) * F.lit(share)
    low = F.floor(place).cast("int")
    below = F.get(F.col(ordered), low)
    above = F.coalesce(F.get(F.col(ordered), low + 1), below)
    return below + (above - below) * (place - low)


def with_interval(priced: DataFrame, percent: float = 95.0) -> DataFrame:
    """Lower and upper price between which the middle `percent` of the trees lie."""
    tail = (100.0 - percent) / 200.0
    ordered = priced.withColumn("_ordered", F.sort_array("tree_prices"))
    return ordered.select(
        *priced.columns,
        array_percentile("_ordered", tail).alias("error_down_95"),
        array_percentile("_ordered", 1.0 - tail).alias("error_up_95"),
    )


def price_recommendation(scored: DataFrame, nodes: DataFrame, cost: str = "committed_cost_ty_filled") -> DataFrame:
    """Predicted price, interval and margins over the committed cost the model saw (mean where missing)."""
    priced = with_interval(with_tree_prices(scored, nodes))
    return priced.select(
        "key", "Predicted_price", "error_down_95", "error_up_95",
        (F.col("Predicted_price") - F.col(cost)).alias("estimated_margin"),
        (F.col("error_down_95") - F.col(cost)).alias("margin_lower"),
        (F.col("error_up_95") - F.col(cost)).alias("margin_upper"),
    )


def path_table(nodes: DataFrame, names: Sequence[str], weights: Sequence[float], depth: int) -> DataFrame:
    """For every tree and leaf the steps from root to leaf: split feature and weighted change of value.

    Every leaf walks up one level per join, collecting its steps in an array of at most `depth`
    entries; all joins are on the model's nodes. The result is written once.
    """
    spark = nodes.sparkSession
    inner = nodes.where(F.col("left") >= 0).select(
        "tree_id", F.col("node").alias("parent"), F.col("value").alias("parent_value"), "feature_index",
        F.explode(F.array("left", "right")).alias("node"),
    )
    edges = inner.join(nodes.select("tree_id", "node", "value"), ["tree_id", "node"]).select(
        "tree_id", "node", "parent",
        F.array(F.struct("feature_index", (F.col("value") - F.col("parent_value")).alias("change"))).alias("step"),
    )
    edges = materialize(edges, "edges")
    walk = leaf_table(nodes).select("tree_id", "leaf", "node", F.array().cast(edges.schema["step"].dataType).alias("steps"))
    for _ in range(depth):
        # At the root there is no edge: the node becomes null and the steps stay.
        walk = walk.join(edges, ["tree_id", "node"], "left").select(
            "tree_id", "leaf", F.col("parent").alias("node"),
            F.concat("steps", F.coalesce("step", F.array().cast(edges.schema["step"].dataType))).alias("steps"),
        )
    steps = walk.select("tree_id", "leaf", F.inline("steps"))
    named = spark.createDataFrame(list(enumerate(names)), "feature_index int, feature string")
    weighted = spark.createDataFrame(list(enumerate(weights)), "tree_id int, weight double")
    paths = steps.join(F.broadcast(named), "feature_index").join(F.broadcast(weighted), "tree_id")
    # Several splits on one feature within a path add up to one step.
    keys = ["tree_id", "leaf", "feature_index", "feature"]
    return materialize(paths.groupBy(*keys).agg(F.sum(F.col("change") * F.col("weight")).alias("change")), "paths")


def root_value(nodes: DataFrame, weights: Sequence[float]) -> float:
    """The ensemble's value before any split: weighted sum of the roots."""
    roots = nodes.where(F.col("node") == 0).select("tree_id", "value").collect()
    return sum(weights[r["tree_id"]] * r["value"] for r in roots)


def path_values(nodes: DataFrame, paths: DataFrame, features: int) -> DataFrame:
    """One row: for every tree and leaf, in order, the change that each feature brings on the way there."""
    steps = paths.groupBy("tree_id", "leaf").agg(
        F.map_from_entries(F.collect_list(F.struct("feature_index", "change"))).alias("steps")
    )
    # A tree of one node has a leaf without steps.
    leaves = leaf_table(nodes).select("tree_id", "leaf").join(steps, ["tree_id", "leaf"], "left")
    numbers = F.sequence(F.lit(0), F.lit(features - 1))
    changes = F.transform(numbers, lambda i: F.coalesce(F.element_at("steps", i), F.lit(0.0)))
    per_tree = leaves.groupBy("tree_id").agg(F.sort_array(F.collect_list(F.struct("leaf", changes.alias("changes")))).alias("leaves"))
    trees = per_tree.agg(F.sort_array(F.collect_list(F.struct("tree_id", F.transform("leaves", lambda x: x["changes"]).alias("leaves")))).alias("trees"))
    return trees.select(F.transform("trees", lambda x: x["leaves"]).alias("values"))


def with_contributions(
    scored: DataFrame, nodes: DataFrame, paths: DataFrame, features: int, trees: int, most_leaves: int,
    name: str = "contributions", most_values: int = BROADCAST_NODES,
) -> DataFrame:
    """Add the array of every feature's contribution, summed over the trees within the row.

    What a leaf brings is a constant sent to every task, for as many trees at once as hold
    `most_values` values (at least one), as prices are; no row is multiplied or shuffled.
    """
    leaves = vector_to_array("leaf").cast("array<int>")
    total, columns = F.array_repeat(F.lit(0.0), features), []
    for first, end in _tree_ranges(trees, most_values // max(most_leaves * features, 1)):
        within = F.col("tree_id").between(first, end - 1)
        values = path_values(nodes.where(within), paths.where(within), features).scalar()
        columns.append(f"_changes_{first}")
        scored = scored.withColumn(columns[-1], values)
        own = F.zip_with(F.slice(leaves, F.lit(first + 1), F.lit(end - first)), columns[-1], lambda leaf, tree: F.get(tree, leaf))
        total = F.aggregate(own, total, lambda sums, x: F.zip_with(sums, x, lambda a, b: a + b))
    return scored.withColumn(name, total).drop(*columns)


def contribution_rows(explained: DataFrame, names: Sequence[str], key: str = "key") -> DataFrame:
    """(key, feature, contribution) for every feature that moves the row's value."""
    features = F.array(*[F.lit(n) for n in names])
    pairs = F.filter(F.arrays_zip(features.alias("feature"), F.col("contributions").alias("contribution")), lambda x: x["contribution"] != 0)
    return explained.select(key, F.inline(pairs).alias("feature", "contribution"))


def explain_model(scored: DataFrame, model, names: Sequence[str]) -> DataFrame:
    """Path contributions for every scored row: to the prediction of a regression or the class-1
    probability of a random forest, to the raw margin of a boosted classifier (before the factor of two
    in its probability).
    """
    depth = model.getMaxDepth()
    weights = tree_weights(model)
    nodes = node_table(model, scored.sparkSession)
    paths = path_table(nodes, names, weights, depth)
    explained = with_contributions(scored, nodes, paths, len(names), len(weights), 2**depth)
    return contribution_rows(explained, names)


def price_in_ranges(model, table: DataFrame, folder: str, ranges: int = 16, key: str = "key") -> DataFrame:
    """Price recommendations of the whole `table`, written in ranges of key hashes under `folder`.

    `model` is a fitted pipeline that ends with a forest. A range that was written before is not
    computed again, so a run that was lost goes on where it stopped; the folder belongs to one model and
    one table. Rows are scored where they are read: no range shuffles.
    """
    spark = table.sparkSession
    nodes = node_table(model.stages[-1], spark)
    part = F.pmod(F.xxhash64(key), F.lit(ranges))
    paths = [f"{folder}/range-{i:05d}" for i in range(ranges)]
    for i, path in enumerate(paths):
        if not completed(spark, path):
            priced = price_recommendation(model.transform(table.where(part == i)), nodes)
            priced.write.mode("overwrite").parquet(path)
    return spark.read.parquet(*paths)
