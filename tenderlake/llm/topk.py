"""Exact top-k search by integer inner product.

Vectors become fixed-point weights; a component is a term, and its postings are the rows whose
weight is not zero. Term at a time, each query's weight is scattered over the term's postings into
a dense score array of a block of candidates; partition selection keeps the block's best k, and a
second selection merges the blocks' lists.

Queries are taken in groups of bounded size. One group at a time is broadcast, and every candidate
row meets it where it lies; only k rows a query and block are shuffled. Queries cost time in
proportion to their number times the rows, which exhaustive search cannot avoid.

Vectors that are null, or hold a null or non-finite component, take no part. Components missing from
the shorter of two vectors count as zero. Rows of one id are never candidates of that id; equal rows
count once, and an id's different vectors are candidates of their own. Ties go to the smaller id; null
ids take no part. Scores are exact; those beyond 64 bits stay at the limit. Other columns are ignored,
whatever their names. An empty table, of rows or of queries, gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderlake.storage import materialize

SCALE = 1024
# Queries held and broadcast at once, and candidate rows that share one score array.
GROUP = 16_384
BLOCK = 4_096
_TILE = 512
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """Distinct (id, vec) of the rows that take part."""
    vec = F.transform(F.col(vector), lambda x: x.cast("double"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = rows.select(F.col(key).cast("long").alias("id"), vec.alias("vec"))
    return rows.where(F.col("id").isNotNull() & F.col("vec").isNotNull() & ~bad).distinct()


def _weights(vectors: list, scale: int) -> np.ndarray:
    """Rows of floor(scale * x), padded with zeros; Python integers where doubles might not hold a weight."""
    width = max(map(len, vectors), default=0)
    real = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        real[i, : len(v)] = v
    with np.errstate(over="ignore"):
        real = np.floor(real * scale)
    if np.abs(real).max(initial=0) < 1 << 53:
        return real.astype(np.int64)
    exact = np.zeros(real.shape, dtype=object)
    for i, v in enumerate(vectors):
        exact[i, : len(v)] = [math.floor(x * scale) if math.isfinite(x * scale) else int(x) * scale for x in v]
    return exact


def _largest(weights: np.ndarray) -> int:
    return int(np.abs(weights).max(initial=0))


def _accumulated(queries: np.ndarray, postings: list[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    """Scores of each query against each of n candidates, a term at a time.

    Python integers are used where 64 bits might not hold a score.
    """
    largest = _largest(queries) * max((_largest(w) for _, w in postings), default=0)
    exact = queries.dtype == object or any(w.dtype == object for _, w in postings) or largest * queries.shape[1] > _MOST
    if exact:
        queries, postings = queries.astype(object), [(rows, w.astype(object)) for rows, w in postings]
    scores = np.zeros((len(queries), n), dtype=object if exact else np.int64)
    for term, (rows, weights) in enumerate(postings[: queries.shape[1]]):
        asking = np.flatnonzero(queries[:, term])
        if not len(rows) or not len(asking):
            continue
        if len(rows) == n and len(asking) == len(queries):
            scores += queries[:, term, None] * weights[None, :]
        else:
            scores[np.ix_(asking, rows)] += queries[asking, term, None] * weights[None, :]
    return np.clip(scores, _LEAST, _MOST).astype(np.int64) if exact else scores


def _selected(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best; all that tie with the k-th are compared by id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= least)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], ~scores[places]))][:k]


def _scanned(best: dict, query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: list, k: int, scale: int) -> None:
    """Merge one block's candidates into the lists kept for each query (by its place)."""
    weights = _weights(vectors, scale)
    postings = [(rows := np.flatnonzero(weights[:, d]), weights[rows, d]) for d in range(weights.shape[1])]
    for start in range(0, len(queries), _TILE):
        scores = _accumulated(queries[start:start + _TILE], postings, len(ids))
        for q, row in enumerate(scores, start):
            others = ids != query_ids[q]
            own, row = (ids, row) if others.all() else (ids[others], row[others])
            places = _selected(row, own, k)
            own, row = own[places], row[places]
            if q in best:
                own, row = np.concatenate([best[q][0], own]), np.concatenate([best[q][1], row])
                places = _selected(row, own, k)
                own, row = own[places], row[places]
            best[q] = own, row


def _group_lists(rows: DataFrame, queries, k: int, scale: int) -> DataFrame:
    """Each task's best k for the queries of one broadcast group."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, weights = queries.value
        best: dict = {}
        for batch in batches:
            for start in range(0, len(batch), BLOCK):
                part = batch.slice(start, BLOCK)
                _scanned(best, query_ids, weights, part.column(0).to_numpy(), part.column(1).to_pylist(), k, scale)
        out = ([], [], [])
        for q, (ids, scores) in best.items():
            out[0].extend([int(query_ids[q])] * len(ids))
            out[1].extend(map(int, ids))
            out[2].extend(map(int, scores))
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["query_id", "vec_id", "score"])

    return rows.mapInArrow(scan, "query_id long, vec_id long, score long")


def _merged(lists: DataFrame, k: int) -> DataFrame:
    """The best k of each query; partial selections come first, so no task gathers all lists of a query."""
    best = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("few")))), 1, k)
    item = F.struct((-F.col("score").cast("decimal(20,0)")).alias("below"), F.col("vec_id"), F.col("score"))
    lists = lists.select("query_id", F.array(item).alias("few"), F.pmod(F.xxhash64("vec_id"), F.lit(64)).alias("part"))
    for keys in (["query_id", "part"], ["query_id"]):
        lists = lists.groupBy(*keys).agg(best.alias("few"))
    ranked = lists.select("query_id", F.posexplode("few").alias("place", "hit"))
    return ranked.select("query_id", (F.col("place") + 1).cast("int").alias("rank"), "hit.vec_id", "hit.score")


def search(rows: DataFrame, queries: DataFrame, k: int = 10, scale: int = SCALE, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k rows with the highest scores for each query: query_id, rank from 1, vec_id, score.

    An id's different vectors, if it has several, ask together: their hits make one list.
    """
    spark: SparkSession = rows.sparkSession
    candidates, asked = usable(rows, key, vector), usable(queries, key, vector)
    total = asked.count()
    groups = max(1, math.ceil(total / GROUP))
    numbered = asked.withColumn("group", F.pmod(F.xxhash64("id", "vec"), F.lit(groups)))
    done = None
    for group in range(groups):
        part = numbered.where(F.col("group") == group).select("id", "vec").toPandas()
        held = spark.sparkContext.broadcast((part["id"].to_numpy(np.int64), _weights(part["vec"].tolist(), scale)))
        found = _group_lists(candidates, held, k, scale)
        if groups > 1:
            found = materialize(_merged(found, k).select("query_id", "vec_id", "score"), "topk")
            held.destroy()
        done = found if done is None else done.unionByName(found)
    return _merged(done, k)

