"""Tables, CSV files, snapshots and models: where results are read from and written to.

A table under a path is replaced without a moment at which it is missing or half written: a new version
is written beside the old one, and then a small pointer file is switched. Readers that have begun
keep the version they found; the one before the last stays until the next replacement.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from tenderlake.storage import read_text, remove, write_text

# The pointer of a table under a path, and how its versions begin; Spark reads no names with an underscore.
POINTER, VERSION = "_current", "_v-"


def dated(name: str, run_date: date) -> str:
    """Name of a run's table: bid_target_2020_01_15."""
    return f"{name}_{run_date:%Y_%m_%d}"


def scored_file_name(run_date: date, stamp: str) -> str:
    return f"ai.{stamp}.bid_scored_sheet_{run_date:%Y_%m_%d}.csv"


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, or Parquet files when `name` is a path: the current version, or the folder itself."""
    if "/" not in name:
        return spark.read.table(name)
    versions = read_text(spark, f"{name}/{POINTER}")
    return spark.read.parquet(f"{name}/{versions.split()[0]}" if versions else name)


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, low: int, high: int, parts: int, **options) -> DataFrame:
    """A database table read in parallel ranges of a numeric column."""
    return spark.read.jdbc(url, table, column=key, lowerBound=low, upperBound=high, numPartitions=parts,
                           properties=options)


def replace_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a catalog table, or the version of a table under a path.

    The bid table is best partitioned by fiscal year: the scoring run then reads three years of it.
    Rows are rebalanced by the partition columns first, so that a value gets files of the advisory
    size (several for a hot value) instead of one small file per task.
    """
    if partition_by:
        writer = df.hint("rebalance", *partition_by).write.partitionBy(*partition_by)
    else:
        writer = df.write
    if "/" not in name:
        writer.mode("overwrite").saveAsTable(name)
        return
    spark = df.sparkSession
    new = f"{VERSION}{uuid.uuid4().hex}"
    writer.parquet(f"{name}/{new}")
    before = (read_text(spark, f"{name}/{POINTER}") or "").split()
    # The new version, and the one that readers may still be at.
    write_text(spark, f"{name}/{POINTER}", " ".join([new, *before[:1]]))
    for old in before[1:]:
        remove(spark, f"{name}/{old}")


def read_csv(spark: SparkSession, path: str, schema: str | None = None, sep: str = ",") -> DataFrame:
    """A CSV file or folder with a header; all text unless a schema is given."""
    reader = spark.read.option("header", True).option("sep", sep).option("escape", '"')
    return (reader.schema(schema) if schema else reader).csv(path)


def export_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """A folder of CSV parts with headers, written by all tasks. `path` may be any file system Spark knows."""
    df.write.mode("overwrite").option("header", True).option("sep", sep).option("escape", '"').csv(path)


def publish(df: DataFrame, prod_path: str, dev_path: str, name: str, to_prod: bool, sep: str = "|") -> str:
    """Write the scored file to the production or development store; returns where."""
    target = f"{(prod_path if to_prod else dev_path).rstrip('/')}/{name}"
    export_csv(df, target, sep)
    return target


def write_snapshot(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
