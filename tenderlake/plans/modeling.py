"""Price models: cleaning, time split, fitting, metrics, importance, monthly backtest.

All fitting and scoring runs in spark.ml; the driver only loops over folds.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.functions.aggregates import error_metrics
from tenderlake.functions.columns import finite
from tenderlake.operators.reshape import stack
from tenderlake.storage import use_checkpoints

NOT_FEATURES = ("key", "date", "target")
PREDICTION = "Predicted_price"
# Flags without a value for bids that lack a name or a rollover mark.
NULLABLE_FLAGS = ("is_emergency_bid", "is_supplemental_bid", "rollover")
FILLED, HOT, INDEX = "_filled", "_hot", "_index"
ROWS_PER_TASK = 250_000


def clean_model_table(features: DataFrame) -> DataFrame:
    """Numbers as double with infinities as null; text, key, date and target unchanged.

    Flags that can be null become text, so that a missing one gives zeros and no mean.
    """
    return features.select(*[
        F.col(c).cast("string").alias(c) if c in NULLABLE_FLAGS else F.col(c) if t in ("string", "date") or c in NOT_FEATURES else finite(c).alias(c)
        for c, t in features.dtypes
    ])


def model_columns(df: DataFrame) -> tuple[list[str], list[str]]:
    """Numeric and text feature columns."""
    names = [(c, t) for c, t in df.dtypes if c not in NOT_FEATURES]
    return [c for c, t in names if t != "string"], [c for c, t in names if t == "string"]


def preparation(train: DataFrame) -> Pipeline:
    """Mean fill, one-hot columns and a feature vector, to be fitted on the training rows.

    A missing or unseen category gives zeros everywhere. Columns without any training value
    have no mean and are left out.
    """
    numeric, text = model_columns(train)
    seen = train.agg(*[F.count(c).alias(c) for c in numeric + text]).first()
    numeric = [c for c in numeric if seen[c]]
    text = [c for c in text if seen[c]]
    stages = [Imputer(inputCols=numeric, outputCols=[c + FILLED for c in numeric], strategy="mean")]
    if text:
        indexes = [c + INDEX for c in text]
        stages += [
            StringIndexer(inputCols=text, outputCols=indexes, handleInvalid="keep", stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=indexes, outputCols=[c + HOT for c in text], dropLast=True),
        ]
    inputs = [c + FILLED for c in numeric] + [c + HOT for c in text]
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=inputs, outputCol="features")])


def spread(train: DataFrame, most: int = ROWS_PER_TASK) -> DataFrame:
    """Training rows in partitions of about `most` rows or fewer.

    Trees keep every partition as one block, many times as large as its compressed file, that a task
    reads again for each level.
    """
    needed = -(-train.count() // most)
    return train if train.rdd.getNumPartitions() >= needed else train.repartition(needed)


def vector_names(prepared: DataFrame) -> list[str]:
    """Feature names in vector order; one-hot entries are `column_value`."""
    groups = prepared.schema["features"].metadata["ml_attr"]["attrs"]
    entries = sorted((a["idx"], a["name"]) for group in groups.values() for a in group)
    return [name.replace(HOT + "_", "_").removesuffix(FILLED) for _, name in entries]


def split_by_time(table: DataFrame, start: date, end: date) -> tuple[DataFrame, DataFrame]:
    """Training rows before `start`, test rows from `start` up to but not at `end`."""
    day = F.col("date")
    return table.where(day < F.lit(start)), table.where((day >= F.lit(start)) & (day < F.lit(end)))


def linear_regression() -> LinearRegression:
    return LinearRegression(labelCol="target", predictionCol=PREDICTION)


def random_forest(trees: int, depth: int = 10) -> RandomForestRegressor:
    return RandomForestRegressor(
        labelCol="target", predictionCol=PREDICTION, numTrees=trees, maxDepth=depth,
        featureSubsetStrategy="sqrt", seed=42, leafCol="leaf",
    )


def boosted_trees(rounds: int, depth: int = 3, rate: float = 0.1) -> GBTRegressor:
    return GBTRegressor(
        labelCol="target", predictionCol=PREDICTION, maxIter=rounds, maxDepth=depth, stepSize=rate, seed=42,
        leafCol="leaf",
    )


def churn_classifier(trees: int, depth: int = 5, boosted: bool = False):
    if boosted:
        return GBTClassifier(labelCol="target", maxIter=trees, maxDepth=depth, seed=42, leafCol="leaf")
    return RandomForestClassifier(labelCol="target", numTrees=trees, maxDepth=depth, seed=42, leafCol="leaf")


def tuned_boosting(
    train: DataFrame, depths: Sequence[int] = (6,), rounds: Sequence[int] = (50,), rates: Sequence[float] = (0.01,),
    parallelism: int = 1,
) -> Model:
    """Best of a depth x rounds x rate grid on a held-out part of the training rows."""
    use_checkpoints(train.sparkSession)
    model = boosted_trees(rounds[0])
    grid = (
        ParamGridBuilder()
        .addGrid(model.maxDepth, list(depths))
        .addGrid(model.maxIter, list(rounds))
        .addGrid(model.stepSize, list(rates))
        .build()
    )
    search = TrainValidationSplit(
        estimator=model, estimatorParamMaps=grid, trainRatio=0.75, seed=1, parallelism=parallelism,
        evaluator=RegressionEvaluator(labelCol="target", predictionCol=PREDICTION, metricName="rmse"),
    )
    return search.fit(train).bestModel


def class_one_probability(scored: DataFrame) -> DataFrame:
    return scored.withColumn("churn_prob", vector_to_array("probability")[1])


def fit_prepared(estimator, prepared: DataFrame) -> Model:
    """The estimator fitted on features and target, which are computed once; fitting reads them several times."""
    rows = prepared.select("features", "target").persist(StorageLevel.DISK_ONLY)
    try:
        return estimator.fit(rows)
    finally:
        rows.unpersist()


def coefficients(model, names: Sequence[str], spark) -> DataFrame:
    """Names and values of a linear model, as long as its feature list."""
    rows = [(n, float(v)) for n, v in zip([*names, "intercept"], [*model.coefficients, model.intercept])]
    return spark.createDataFrame(rows, "feature string, coefficient double")


def r_squared(scored: DataFrame) -> float | None:
    """Share of the target's variance that the predictions explain; None without rows to judge by."""
    if scored.isEmpty():
        return None
    return RegressionEvaluator(labelCol="target", predictionCol=PREDICTION, metricName="r2").evaluate(scored)


def metrics(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return scored.groupBy(*by).agg(*error_metrics(PREDICTION, "target"))


def importance(model, names: Sequence[str], spark) -> DataFrame:
    """Feature importance to two decimals, highest first; as long as the feature list."""
    rows = sorted(((n, round(float(v), 2)) for n, v in zip(names, model.featureImportances.toArray())),
                  key=lambda r: (-r[1], r[0]))
    return spark.createDataFrame(rows, "feature string, importance double")


def months_from(start: date, count: int) -> list[tuple[date, date]]:
    """(first day, first day of the next month) for `count` months."""
    firsts = [date(start.year + (start.month - 1 + i) // 12, (start.month - 1 + i) % 12 + 1, 1) for i in range(count + 1)]
    return list(zip(firsts, firsts[1:]))


def fit_fold(table: DataFrame, start: date, end: date, estimator) -> tuple[PipelineModel, Model, DataFrame]:
    """Prepare and fit on the rows before `start`; returns the scored test rows too."""
    use_checkpoints(table.sparkSession)
    train, test = split_by_time(table, start, end)
    prepare = preparation(train).fit(train)
    model = estimator.fit(prepare.transform(train))
    return prepare, model, model.transform(prepare.transform(test))


def backtest(
    table: DataFrame, start: date, months: int, estimator: Callable[[], object], parallelism: int = 1
) -> tuple[DataFrame, DataFrame]:
    """Expanding-window monthly folds: predictions and importances of every fold, stacked.

    `table` should be a written table, as every fold reads it. Folds are independent, so
    several may be fitted at a time.
    """
    spark = table.sparkSession

    def fold(span):
        first, after = span
        _, model, scored = fit_fold(table, first, after, estimator())
        predictions = scored.select(
            F.lit(first).alias("fold"), "key", "date", "total_qty_ty", "target", PREDICTION
        )
        names = vector_names(scored)
        return predictions, importance(model, names, spark).withColumn("fold", F.lit(first))

    spans = months_from(start, months)
    with ThreadPool(max(1, min(parallelism, len(spans)))) as pool:
        folds = pool.map(inheritable_thread_target(spark)(fold), spans)
    return stack([p for p, _ in folds]), stack([i for _, i in folds])
