"""Ranked lexical search: a K2-treap over the grid of terms and documents.

A block of documents is a grid: a row for each of its terms, a column for each document, and in a cell
the term's impact on the document's score. The treap cuts the grid into quarters again and again; it
keeps of every quarter that is not empty which of its own quarters are not, and, as what it lacks to
the quarter above, the highest impact in it. Rows stand by falling document frequency, so that the
dense part lies in one corner, and rare terms of one document side by side.

An item's terms are rows. Their paths descend jointly: a range of documents has one cell of each row, and
the sum of the cells' maxima by weight bounds the scores in it. The ranges with the highest bounds are
halved first, some hundred at once; a range of one document has its exact score. A block ends when no
bound reaches the k-th score, that of earlier blocks of the task included. One block in sixteen is
searched before the others, which begin with the k-th scores found there. Only k rows an item and task
are shuffled, and partial rankings come before the last one.

The blocks are written to the shared folder as an index of whole texts, each bounded by its number of
impacts (one document may exceed it) and found by no other key. Weights follow from document frequencies, summed
over the blocks for the terms of the items. Items are read in chunks of bounded size; no other data is
broadcast, and each chunk reads the index again.

Null and empty texts have no terms: such documents are not counted, such items find nothing. Rows that
repeat an id, or whole rows, are documents (or items) each. Equal scores go to the smaller id; a null
id comes last. Ids are integers below 2^63 - 1. Other columns are ignored, whatever their names. Empty
tables give no rows.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenderlake.llm.common import utf8
from tenderlake.storage import materialize, new_path

FIRST = 50
# Impacts of a block, bytes of items searched at once, ranges opened at once, blocks of which one leads, and parts of a first ranking.
BLOCK_IMPACTS = 1_000_000
CHUNK_BYTES = 1 << 20
_AT_ONCE = 256
_LEADS = 16
_PARTS = 64
_NO_ID = (1 << 63) - 1
# Separators of terms, and letters in lower case.
_SEPARATED = bytes(b if b >= 0x80 or chr(b).isalnum() else 32 for b in range(256)).lower()
_ONES = np.array([i.bit_count() for i in range(16)], np.int32)


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_SEPARATED).split()


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def statistics(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """N, the documents with a term, and L, their terms."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [len(terms_of(t.as_py())) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([sum(n > 0 for n in sizes)]), pa.array([sum(sizes)])], names=["n", "terms"])

    found = docs.select(utf8(text).alias("text")).mapInArrow(sums, "n long, terms long")
    n, size = found.agg(F.sum("n"), F.sum("terms")).first()
    return n or 0, size or 0


def _spread(values: np.ndarray) -> np.ndarray:
    """Bits of 32-bit numbers, a zero before each."""
    x = values.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | x << np.uint64(shift)) & np.uint64(mask)
    return x


def built(rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray, height: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Masks of the cells that have quarters, in breadth-first order, what each cell lacks to the one above, cells by level."""
    codes = _spread(rows) << np.uint64(1) | _spread(columns)
    order = np.argsort(codes)
    codes, most = codes[order], impacts[order].astype(np.int64)
    masks, lacks, sizes = [], [], [len(codes)]
    for _ in range(height):
        above = codes >> np.uint64(2)
        first = np.flatnonzero(np.r_[True, above[1:] != above[:-1]])
        masks.append(np.bitwise_or.reduceat(np.left_shift(1, (codes & np.uint64(3)).astype(np.uint8)).astype(np.uint8), first))
        upper = np.maximum.reduceat(most, first)
        lacks.append(np.repeat(upper, np.diff(np.r_[first, len(codes)])) - most)
        codes, most = above[first], upper
        sizes.append(len(codes))
    lacks.append(-most)
    return np.concatenate(masks[::-1]), np.concatenate(lacks[::-1]).astype(np.int32), np.array(sizes[::-1], np.int64)


@dataclass
class Grid:
    """A block's treap, read: masks, place of each cell's first quarter, and maxima; the last place of each is that of no cell."""

    masks: np.ndarray
    first: np.ndarray
    most: np.ndarray
    height: int

    @classmethod
    def read(cls, masks: bytes, lacks: bytes, sizes: list[int]) -> Grid:
        mask = np.frombuffer(masks, np.uint8)
        ones = _ONES[mask]
        first = np.cumsum(np.r_[np.int32(1), ones[:-1]], dtype=np.int32)
        most = -np.frombuffer(lacks, np.int32)
        above = np.repeat(np.arange(len(mask), dtype=np.int32), ones)
        ends = np.cumsum(sizes)
        for start, end in zip(ends[:-1], ends[1:]):
            most[start:end] += most[above[start - 1:end - 1]]
        # Cells of single documents have no quarters.
        rest = len(most) - len(mask) + 1
        return cls(np.r_[mask, np.zeros(rest, np.uint8)], np.r_[first, np.zeros(rest, np.int32)], np.r_[most, np.int32(0)], len(sizes) - 1)

    def best(self, rows: np.ndarray, weights: np.ndarray, ids: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores and columns of the k best documents, of those that score `least` or more."""
        bits = (rows[None, :] >> np.arange(self.height - 1, -1, -1)[:, None] & 1).astype(np.uint8)
        # Sums of doubles are exact while they are below 2^53.
        exact = int(weights.sum()) * 10**6 < 1 << 53
        kind = np.float64 if exact else np.int64
        weights = weights.astype(kind)
        scores, columns = np.zeros(0, np.int64), np.zeros(0, np.int64)
        bounds, levels, ranges, cells = np.array([self.most[0] * weights.sum()]), np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros((1, len(rows)), np.int32)
        while True:
            kept = bounds >= max(least, 1)
            if not kept.any():
                break
            if not kept.all():
                bounds, levels, ranges, cells = bounds[kept], levels[kept], ranges[kept], cells[kept]
            opened = np.argpartition(-bounds, _AT_ONCE)[:_AT_ONCE] if len(bounds) > _AT_ONCE else np.arange(len(bounds))
            waiting = np.ones(len(bounds), bool)
            waiting[opened] = False
            own, at, held = levels[opened], ranges[opened], cells[opened]
            masks, quarter = self.masks[held], bits[own] * np.uint8(2)
            left = self.first[held] + _ONES[masks & (np.uint8(1) << quarter) - np.uint8(1)]
            has = masks >> quarter & 3
            below = np.concatenate([np.where(has & 1, left, -1), np.where(has & 2, left + (has & 1), -1)])
            found = self.most[below].astype(kind) @ weights
            at, own = np.concatenate([2 * at, 2 * at + 1]), np.concatenate([own, own]) + 1
            new = (found >= max(least, 1)) & (own == self.height)
            inner = (found >= max(least, 1)) & (own < self.height)
            bounds, levels = np.concatenate([bounds[waiting], found[inner]]), np.concatenate([levels[waiting], own[inner]])
            ranges, cells = np.concatenate([ranges[waiting], at[inner]]), np.concatenate([cells[waiting], below[inner]])
            if new.any():
                scores, columns = np.concatenate([scores, found[new].astype(np.int64)]), np.concatenate([columns, at[new]])
                places = selected(scores, ids[columns], k)
                scores, columns = scores[places], columns[places]
                if len(scores) == k:
                    least = max(least, int(scores[-1]))
        return scores, columns


def selected(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, best first."""
    return np.lexsort((ids, -scores))[:k]


_INDEX = "lead boolean, ids binary, terms array<string>, holding binary, masks binary, lacks binary, sizes array<long>"


def write_index(docs: DataFrame, key: str = "doc_id", text: str = "text", block_impacts: int = BLOCK_IMPACTS) -> tuple[DataFrame, int]:
    """The written index, one row per block, and N."""
    documents, size = statistics(docs, text)

    def block(number: int, ids: list, lengths: list, terms: dict, rows: array, counts: array, held: list) -> pa.RecordBatch:
        row, tf = np.frombuffer(rows, np.uint32).astype(np.int64), np.frombuffer(counts, np.int64)
        column = np.repeat(np.arange(len(ids)), held)
        m = np.array([50 + 50 * n * documents // size for n in lengths], np.int64)
        impacts = 10**9 * tf // (1000 * tf + 20 * m[column])
        holding = np.bincount(row)
        # Terms are numbered as they come, so rare terms of one document stay together.
        order = np.argsort(-holding, kind="stable")
        place = np.zeros(len(order), np.int64)
        place[order] = np.arange(len(order))
        height = max(1, (max(len(ids), len(order)) - 1).bit_length())
        masks, lacks, sizes = built(place[row], column, impacts, height)
        names = list(terms)
        lead = (TaskContext.get().partitionId() + number) % _LEADS == 0
        out = [lead, np.array([_NO_ID if i is None else i for i in ids], np.int64).tobytes(), [names[i] for i in order], holding[order].tobytes(), masks.tobytes(), lacks.tobytes(), sizes.tolist()]
        kinds = [pa.bool_(), pa.binary(), pa.list_(pa.string()), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip(out, kinds)], names=[f.split()[0] for f in _INDEX.split(", ")])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def nothing() -> tuple:
            terms: dict = defaultdict(lambda: len(terms))
            return [], [], terms, array("I"), array("q"), []

        number = 0
        state = ids, lengths, terms, rows, counts, held = nothing()
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = terms_of(value.as_py())
                if not found:
                    continue
                own = Counter(found)
                ids.append(name)
                lengths.append(len(found))
                held.append(len(own))
                rows.extend(map(terms.__getitem__, own))
                counts.extend(own.values())
                if len(rows) >= block_impacts:
                    yield block(number, *state)
                    number += 1
                    state = ids, lengths, terms, rows, counts, held = nothing()
        if ids:
            yield block(number, *state)

    path = new_path(docs.sparkSession, "treap")
    blocks = docs.select(F.col(key).cast("long").alias("id"), utf8(text).alias("text")).mapInArrow(build, _INDEX)
    # Readers take a file's rows at once.
    blocks.write.partitionBy("lead").option("maxRecordsPerFile", 1).option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(_INDEX).parquet(path), documents


def _holding(index: DataFrame, vocabulary: list[str]) -> np.ndarray:
    """Documents that hold each term of the vocabulary."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = pa.array(vocabulary, pa.string())
        for batch in batches:
            for terms, holding in zip(batch.column(0), batch.column(1)):
                rows = pc.index_in(asked, value_set=terms.values)
                at = np.flatnonzero(rows.is_valid())
                found = np.frombuffer(holding.as_py(), np.int64)[rows.take(pa.array(at)).to_numpy()]
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found)], names=["place", "n"])

    out = np.zeros(len(vocabulary), np.int64)
    # At most one row for each term of a chunk of items.
    for r in index.select("terms", "holding").mapInArrow(look, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect():
        out[r["place"]] = r["n"]
    return out


def _chunk(index: DataFrame, documents: int, items: list[tuple[int, list[str]]], k: int) -> DataFrame:
    """(item, doc_id, score): the best k of every task for each (number, terms) of `items`."""
    vocabulary = sorted({t for _, terms in items for t in terms})
    place = {t: i for i, t in enumerate(vocabulary)}
    weights = np.array([weight(documents, int(n)) for n in _holding(index, vocabulary)], np.int64)
    asked = [(number, np.array([place[t] for t in terms if weights[place[t]] > 0], np.int64)) for number, terms in items]
    leads = materialize(_ranked(_lists(index.where("lead"), vocabulary, weights, asked, {}, k), k).select("item", "doc_id", "score", "rank"), "leads")
    # One score for each item of a chunk.
    least = {r["item"]: r["score"] for r in leads.where(F.col("rank") == k).collect()}
    return leads.drop("rank").unionByName(_lists(index.where("not lead"), vocabulary, weights, asked, least, k))


def _lists(index: DataFrame, vocabulary: list[str], weights: np.ndarray, asked: list, least: dict[int, int], k: int) -> DataFrame:
    """(item, doc_id, score): each task's best k for the items, of documents that reach the item's least score."""
    held = index.sparkSession.sparkContext.broadcast((vocabulary, weights, asked, least))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, weights, asked, least = held.value
        names = pa.array(vocabulary, pa.string())
        best: dict = {}
        for batch in batches:
            for block in range(len(batch)):
                ids, terms, masks, lacks, sizes = (batch.column(i)[block] for i in range(5))
                ids = np.frombuffer(ids.as_py(), np.int64)
                grid = Grid.read(masks.as_py(), lacks.as_py(), sizes.as_py())
                rows = pc.fill_null(pc.index_in(names, value_set=terms.values), -1).to_numpy()
                for number, own in asked:
                    own = own[rows[own] >= 0]
                    if not len(own):
                        continue
                    before = best.get(number, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
                    known = max(least.get(number, 0), int(before[0][-1]) if len(before[0]) == k else 0)
                    scores, columns = grid.best(rows[own].astype(np.int64), weights[own], ids, k, known)
                    scores, found = np.concatenate([before[0], scores]), np.concatenate([before[1], ids[columns]])
                    places = selected(scores, found, k)
                    best[number] = scores[places], found[places]
        for number, (scores, ids) in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), number)), pa.array(ids, mask=ids == _NO_ID), pa.array(scores)], names=["item", "doc_id", "score"])

    return index.select("ids", "terms", "masks", "lacks", "sizes").mapInArrow(search, "item long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = FIRST, key: str = "doc_id", item: str = "item_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES, **options) -> DataFrame:
    """The k documents with the highest scores for each item: item, rank (from 1), key, score."""
    spark: SparkSession = docs.sparkSession
    index, documents = write_index(docs, key, text, **options)
    rows = items.select(F.col(item).alias("item_id"), utf8(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, math.ceil(size / chunk_bytes))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(chunks))
    name = rows.schema["item_id"].dataType.simpleString()
    done, asked = None, 0
    for chunk in range(chunks):
        held = rows.where(part == chunk).collect()
        terms = [[t.decode() for t in dict.fromkeys(terms_of(bytes(r["text"])))] for r in held]
        found = _chunk(index, documents, list(enumerate(terms, asked)), k)
        about = spark.createDataFrame([(asked + i, r["item_id"]) for i, r in enumerate(held)], f"item long, item_id {name}")
        found = _ranked(found, k).join(F.broadcast(about), "item")
        done = found if done is None else done.unionByName(found)
        asked += len(held)
    return done.select(F.col("item_id").alias(item), "rank", F.col("doc_id").alias(key), "score")


def _ranked(lists: DataFrame, k: int) -> DataFrame:
    """The best k of each item; parts of the lists are ranked before the whole."""
    lists = lists.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(_PARTS)))
    for keys in (["item", "part"], ["item"]):
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        lists = lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return lists
