"""All registered queries and their comparison SQL, with doubles rounded alike on both sides."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workload import bid_queries, churn_queries, dashboard_queries, model_queries, operator_queries, scorecard_queries

DIGITS = 6
# Moves exact ties (many prices end in 5 at the seventh digit) off the rounding edge, where the
# last bit of a float sum would decide. Applied in both engines.
OFFSET = 3.3e-8
_ALL = {
    **bid_queries.QUERIES,
    **dashboard_queries.QUERIES,
    **scorecard_queries.QUERIES,
    **operator_queries.QUERIES,
    **model_queries.QUERIES,
    **churn_queries.QUERIES,
}


def _rounded(build):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = build(spark, sf_dir)
        return df.select(*[
            (F.round(F.col(f"`{n}`") + F.lit(OFFSET), DIGITS) + F.lit(0.0)).alias(n) if t == "double" else F.col(f"`{n}`")
            for n, t in df.dtypes
        ])

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _rounded(build) for name, (build, _, _) in _ALL.items()}


def oracle_sql() -> dict[str, str]:
    texts = {}
    for name, (_, sql, doubles) in _ALL.items():
        if sql is None:
            continue
        rounded = ", ".join(f'round("{c}" + {OFFSET}, {DIGITS}) + 0.0 as "{c}"' for c in doubles)
        texts[name] = f"select * replace ({rounded}) from ({sql})" if rounded else sql
    return texts
