"""Churn model: customer snapshots, a model that is kept with what it needs, and its application.

A snapshot describes every customer and family by its invoices up to a date; its target, if asked for,
is whether the time after that date had no invoice. Models are fitted on a snapshot in the past, on
some customers; the others, none of whose rows were seen, judge it. What is kept is a bundle: model,
columns in order, categories with their numbers, and when and on what it was fitted. Applying a
bundle checks all of these.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenderlake.functions.columns import ratio, split_once
from tenderlake.plans import modeling, scorecard, trees
from tenderlake.storage import use_checkpoints

FOLDS = 5
YEAR = 365
# Driver classes of the scorecard, and the part of a feature's name that puts it in one.
DRIVER_CLASSES = [
    ("Order pattern", "gap"), ("Order pattern", "days_since"), ("Volume", "quantity"), ("Volume", "lines"),
    ("Margin", "profit"), ("Price", "price_level"), ("Segment", "segment"),
]


def customer_fold(key: str = "key", folds: int = FOLDS) -> Column:
    """The fold of a key's customer: all keys of a customer are in one fold."""
    customer, _ = split_once(key, "customer", "family")
    digits = F.substring(F.md5(customer.cast("binary")), 1, 8)
    return F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(folds)).cast("int")


def snapshot(invoices: DataFrame, as_of: date, target_days: int | None = None) -> DataFrame:
    """One row per key with an invoice up to `as_of`: what its invoices say, and the target.

    Invoices are summed to key, day and segment by hashing, then sorted once: by key and day, for the sums of
    a day, the gaps between days and the sums of a key. A key has no more rows there than days and segments.
    The target is 1 if no invoice follows within `target_days` after `as_of`.
    """
    last = F.lit(as_of).cast("date")
    # Gaps look back and the target ahead by its days: later invoices say nothing.
    parts = invoices.where(F.col("billing_date") <= F.date_add(last, target_days or 0)).groupBy(
        "key", "billing_date", F.col("uic_industry_group_name").alias("segment")
    ).agg(
        F.sum("inv_delivered_gp").alias("profit"),
        F.sum("quantity").alias("quantity"),
        F.count("*").alias("lines"),
        F.sum(ratio(F.col("inv_delivered_gp"), "quantity")).alias("price"),
        F.count(ratio(F.col("inv_delivered_gp"), "quantity")).alias("priced"),
    )
    sums = [F.sum(c).alias(c) for c in ("profit", "quantity", "lines", "price", "priced")]
    daily = parts.repartition("key").groupBy("key", "billing_date").agg(*sums, F.min("segment").alias("segment"))
    before = F.lag("billing_date").over(Window.partitionBy("key").orderBy("billing_date"))
    daily = daily.withColumn("gap", F.datediff("billing_date", before))
    known, recent = F.col("billing_date") <= last, F.col("billing_date") > F.date_sub(last, YEAR)
    when = lambda column, also=F.lit(True): F.when(known & also, F.col(column))
    sums = [
        F.max(when("billing_date")).alias("last_trx_date"),
        F.coalesce(F.sum(when("profit")), F.lit(0.0)).alias("profit"),
        F.coalesce(F.sum(when("profit", recent)), F.lit(0.0)).alias("profit_last_year"),
        F.coalesce(F.sum(when("quantity")), F.lit(0.0)).alias("quantity"),
        F.coalesce(F.sum(when("quantity", recent)), F.lit(0.0)).alias("quantity_last_year"),
        F.coalesce(F.sum(when("lines")), F.lit(0)).cast("double").alias("lines"),
        F.sum(when("price")).alias("price"),
        F.sum(when("priced")).alias("priced"),
        F.avg(when("gap")).alias("gap_mean"),
        F.try_divide(F.stddev_samp(when("gap")), F.lit(1.0)).alias("gap_std"),
        F.min(when("segment")).alias("segment"),
    ]
    if target_days is not None:
        after = ~known & (F.col("billing_date") <= F.date_add(last, target_days))
        sums.append(F.when(F.count(F.when(after, 1)) > 0, 0.0).otherwise(1.0).alias("target"))
    found = daily.groupBy("key").agg(*sums).where(F.col("last_trx_date").isNotNull())
    return found.select(
        "key", *["target"] * (target_days is not None),
        F.datediff(last, "last_trx_date").cast("double").alias("days_since"),
        "profit", "profit_last_year", "quantity", "quantity_last_year", "lines",
        ratio(F.col("price"), "priced").alias("price_level"), "gap_mean", "gap_std", "segment",
    )


def training_date(last: date, target_days: int = YEAR) -> date:
    """The latest date whose target is known on the day `last`."""
    return last - timedelta(days=target_days)


@dataclass(frozen=True)
class ChurnBundle:
    """A fitted model and what its application must agree with.

    `columns` are (name, kind) in order, `categories` (column, number, value) rows, `about` names the
    run date, the date of the training snapshot, the folds and the fold that was held out.
    """

    model: PipelineModel
    columns: list[tuple[str, str]]
    categories: list[tuple[str, int, str]]
    about: dict[str, str]


def fit(table: DataFrame, run_date: date, as_of: date, count: int = 100, depth: int = 5, boosted: bool = False, held_out: int = 0) -> ChurnBundle:
    """A bundle fitted on the customers of all folds but `held_out`; `table` is a written snapshot with targets."""
    use_checkpoints(table.sparkSession)
    seen = modeling.clean_model_table(table.where(customer_fold() != held_out))
    prepare = modeling.preparation(seen).fit(seen)
    classifier = modeling.churn_classifier(count, depth, boosted)
    model = PipelineModel([prepare, modeling.fit_prepared(classifier, prepare.transform(modeling.spread(seen)))])
    columns = [(c, t) for c, t in table.dtypes if c not in modeling.NOT_FEATURES]
    categories = []
    for stage in model.stages[0].stages if isinstance(model.stages[0], PipelineModel) else model.stages:
        if hasattr(stage, "labelsArray"):
            names = [c.removesuffix(modeling.INDEX) for c in stage.getOutputCols()]
            categories += [(c, i, v) for c, labels in zip(names, stage.labelsArray) for i, v in enumerate(labels)]
    about = {"run_date": run_date.isoformat(), "as_of": as_of.isoformat(), "folds": str(FOLDS), "held_out": str(held_out)}
    return ChurnBundle(model, columns, categories, about)


def save(bundle: ChurnBundle, spark: SparkSession, folder: str) -> None:
    """The model, then the tables that describe it; a bundle without all of them does not load."""
    bundle.model.write().overwrite().save(f"{folder}/model")
    rows = [(i, *c) for i, c in enumerate(bundle.columns)]
    spark.createDataFrame(rows, "place int, name string, kind string").coalesce(1).write.mode("overwrite").parquet(f"{folder}/columns")
    kinds = "column string, number int, value string"
    spark.createDataFrame(bundle.categories, kinds).coalesce(1).write.mode("overwrite").parquet(f"{folder}/categories")
    about = spark.createDataFrame(sorted(bundle.about.items()), "name string, value string")
    about.coalesce(1).write.mode("overwrite").parquet(f"{folder}/about")


def load(spark: SparkSession, folder: str, run_date: date | None = None) -> ChurnBundle:
    """The saved bundle; an error if it was made for a later run than `run_date`.

    Its tables have a row per column, category and fact of the model, not of the data.
    """
    about = {r["name"]: r["value"] for r in spark.read.parquet(f"{folder}/about").collect()}
    if run_date is not None and about["run_date"] > run_date.isoformat():
        raise ValueError(f"the model is of {about['run_date']}, after the run of {run_date}")
    columns = [(r["name"], r["kind"]) for r in spark.read.parquet(f"{folder}/columns").orderBy("place").collect()]
    categories = [tuple(r) for r in spark.read.parquet(f"{folder}/categories").orderBy("column", "number").collect()]
    return ChurnBundle(PipelineModel.load(f"{folder}/model"), columns, categories, about)


def matching(bundle: ChurnBundle, table: DataFrame) -> DataFrame:
    """`table` with the bundle's columns in its order; missing ones and other kinds are errors, further ones go."""
    kinds = dict(table.dtypes)
    missing = [c for c, _ in bundle.columns if c not in kinds]
    other = [f"{c} is {kinds[c]}, not {t}" for c, t in bundle.columns if c in kinds and kinds[c] != t]
    if missing or other:
        raise ValueError("; ".join([*[f"{c} is missing" for c in missing], *other]))
    kept = [c for c in modeling.NOT_FEATURES if c in kinds]
    return table.select(*kept, *[c for c, _ in bundle.columns])


def apply(bundle: ChurnBundle, table: DataFrame) -> DataFrame:
    """`table` scored by the bundle: churn_prob, and the columns that explanations need."""
    return modeling.class_one_probability(bundle.model.transform(modeling.clean_model_table(matching(bundle, table))))


def unknown_categories(bundle: ChurnBundle, table: DataFrame) -> DataFrame:
    """(column, value, rows) of values the model has not seen: they count as none of its categories."""
    text = [c for c, t in bundle.columns if t == "string"]
    spark = table.sparkSession
    if not text:
        return spark.createDataFrame([], "column string, value string, rows long")
    values = table.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in text])))
    counted = values.dropna().groupBy("column", "value").agg(F.count("*").alias("rows"))
    known = spark.createDataFrame(bundle.categories, "column string, number int, value string").drop("number")
    return counted.join(known, ["column", "value"], "left_anti")


def quality(scored: DataFrame) -> DataFrame:
    """One row on scored rows with targets: rows, churned, mean score, area under the curve, log loss, share right."""
    held = F.greatest(F.least("churn_prob", F.lit(1 - 1e-9)), F.lit(1e-9))
    loss = -F.when(F.col("target") == 1, F.log(held)).otherwise(F.log(1 - held))
    area = BinaryClassificationEvaluator(rawPredictionCol="churn_prob", labelCol="target").evaluate(scored)
    return scored.agg(
        F.count("*").alias("rows"), F.sum("target").alias("churned"), F.avg("churn_prob").alias("mean_score"),
        F.lit(float(area)).alias("area_under_curve"), F.avg(loss).alias("log_loss"),
        F.avg(((F.col("churn_prob") >= 0.5).cast("double") == F.col("target")).cast("double")).alias("share_right"),
    )


def calibration(scored: DataFrame, bins: int = 10) -> DataFrame:
    """Rows, mean score and share churned by tenth of the score."""
    at = F.least(F.floor(F.col("churn_prob") * bins), F.lit(bins - 1)).cast("int")
    return scored.groupBy(at.alias("bin")).agg(
        F.count("*").alias("rows"), F.avg("churn_prob").alias("mean_score"), F.avg("target").alias("share_churned")
    )


def explained(bundle: ChurnBundle, scored: DataFrame) -> DataFrame:
    """(key, feature, contribution) of every scored row."""
    return trees.explain_model(scored, bundle.model.stages[-1], modeling.vector_names(scored))


def drivers(bundle: ChurnBundle, scored: DataFrame, classes: Sequence[tuple[str, str]] = DRIVER_CLASSES) -> DataFrame:
    """The top driver classes of every scored key."""
    pairs = scorecard.feature_classes(modeling.vector_names(scored), classes)
    return scorecard.top_drivers(explained(bundle, scored), pairs)
