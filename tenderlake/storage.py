"""Session settings and tables written to the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}


def tuned(spark: SparkSession) -> SparkSession:
    """Let AQE split hot join partitions even where that costs one more shuffle."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    # local-cluster[...] has executors with folders of their own.
    if not (context.master == "local" or context.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = context.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="tenderlake-")
    return _LOCAL_FOLDERS[app]


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path under this application's part of the shared folder, free to delete after the run."""
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/tenderlake-{application}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts the lineage with replicated files, so a lost executor costs no recomputation
    and every later reader sees the same bits.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _file(spark: SparkSession, path: str):
    """The file system of a path, which may be any that Spark knows, and the path there."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


def completed(spark: SparkSession, path: str) -> bool:
    """Whether a job has written the folder to its end."""
    files, marker = _file(spark, f"{path}/_SUCCESS")
    return files.exists(marker)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file, or None if there is none."""
    files, there = _file(spark, path)
    if not files.exists(there):
        return None
    stream = files.open(there)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small text file in one step: written under another name, then renamed."""
    files, there = _file(spark, path)
    _, beside = _file(spark, f"{path}.{uuid.uuid4().hex}")
    stream = files.create(beside, True)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(there.toUri(), spark._jsc.hadoopConfiguration())
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(files.makeQualified(beside), files.makeQualified(there), options)


def remove(spark: SparkSession, path: str) -> None:
    files, there = _file(spark, path)
    files.delete(there, True)


def use_checkpoints(spark: SparkSession) -> None:
    """Give tree training a checkpoint folder, or its lineage grows with every boosting round."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
