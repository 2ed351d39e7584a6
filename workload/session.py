"""A local session for tests, checks and the benchmark."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | None = None, memory: str = "8g") -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tenderlake")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", memory)
        .config("spark.sql.codegen.cache.maxEntries", "1000")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
