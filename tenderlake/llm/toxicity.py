"""Toxicity: a linear-chain CRF tags toxic words; its marginals make document scores and offending offsets.

Labels are given by document. A word's features are the word and its first three to six bytes. A
feature is a marker if it stands in toxic documents more often than chance allows (a likelihood-ratio
test over all features seen); the labelled tokens are the words of toxic documents that have a
marker. The CRF learns the markers' weights and the transitions from these tokens, and a logistic
regression on a document's marginals turns them into a score. Its classes weigh what they weigh among
all labelled documents, not in the sample.

The model is fitted on a bounded sample of labelled rows (`SAMPLE` of either label, those whose hashed
ids come first) and holds at most `MARKERS` markers, so it is broadcast. Scoring is row-local.

Sequences are runs of up to 256 words of one document. Null and empty texts have no words and get the
score of a text without markers. Several labels of one id count as toxic if one is; null ids and null
labels teach nothing. Without documents of both labels all scores are 0.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderlake.llm.common import WORD_BYTES, column, utf8, words
from tenderlake.llm.crf import Chain
from tenderlake.llm.wordbpe import Remembered

SAMPLE = 10_000
CHAIN_SAMPLE = 1_500
MARKERS = 20_000
FOLDS = 5
_LENGTH = 256
_AT_ONCE = 1 << 16
# Rows that Spark hands to a scoring task at a time; a row may hold its text twice.
_BATCH = 1_000
_FLUSH = 400_000
# Words, or places of sequences, that the fit holds doubles of at a time; a multiple of _LENGTH.
_FIT_AT_ONCE = 1 << 17
_EPOCHS = 80


def fold(key: str) -> Column:
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(FOLDS))


def features(word: bytes) -> list[bytes]:
    return [b"=" + word, *(b"^" + word[:n] for n in range(3, min(6, len(word)) + 1))]


@dataclass
class Model:
    weights: dict[bytes, float] = field(default_factory=dict)
    bias: float = 0.0
    chain: Chain = field(default_factory=Chain)
    calibration: np.ndarray | None = None
    known: Remembered | None = None

    def emission(self, word: bytes) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in features(word))

    def marginals(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        """For each text, the probability that each of its words is toxic."""
        if self.known is None:
            self.known = Remembered(self.emission)
        scores = [np.fromiter(map(self.known.__getitem__, t), float, len(t)) for t in texts]
        filled, mask = sequences(scores)
        found = self.chain.marginals(filled, mask)[0].T.reshape(-1)
        ends = np.cumsum([-(-len(s) // _LENGTH) * _LENGTH for s in scores], dtype=np.int64)
        return [found[e - -(-len(s) // _LENGTH) * _LENGTH:][: len(s)] for s, e in zip(scores, ends)]

    def score(self, marginals: np.ndarray) -> float:
        if self.calibration is None:
            return 0.0
        return float(1 / (1 + math.exp(-float(summary(marginals) @ self.calibration))))


def summary(marginals: np.ndarray) -> np.ndarray:
    """What a document's score rests on: the largest marginal, their sum, and a constant."""
    top = min(max(float(marginals.max(initial=0.0)), 1e-5), 1 - 1e-5)
    return np.array([math.log(top / (1 - top)), math.log(float(marginals.sum()) + 1e-3), 1.0])


def sequences(scores: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Values and mask as (position, sequence), each text cut into sequences of 256."""
    rows = [-(-len(s) // _LENGTH) for s in scores]
    filled = np.zeros((sum(rows), _LENGTH))
    mask = np.zeros(filled.shape, bool)
    at = 0
    for s, n in zip(scores, rows):
        filled.reshape(-1)[at * _LENGTH: at * _LENGTH + len(s)] = s
        mask.reshape(-1)[at * _LENGTH: at * _LENGTH + len(s)] = True
        at += n
    return np.ascontiguousarray(filled.T), np.ascontiguousarray(mask.T)


def _labelled(labels: DataFrame, key: str, label: str, held_out: int | None) -> DataFrame:
    """(of, toxic): one row per labelled id, but for the fold `held_out`."""
    rows = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
    if held_out is not None:
        rows = rows.where(fold(key) != held_out)
    return rows.groupBy(F.col(key).alias("of")).agg((F.max(F.col(label).cast("int")) > 0).alias("toxic"))


def _toxic_share(docs: DataFrame, labels: DataFrame, key: str, label: str, held_out: int | None) -> float:
    """The share of toxic documents among all labelled ones."""
    rows = docs.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n"))
    rows = rows.join(_labelled(labels, key, label, held_out), F.col("key") == F.col("of"))
    total = rows.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("toxic"), F.col("n"))).alias("toxic")).first()
    return (total["toxic"] or 0) / total["n"] if total["n"] else 0.0


def _sampled(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, each: int, held_out: int | None) -> DataFrame:
    """Texts and labels of the sample; its ids, bounded by `each`, are broadcast to the documents."""
    rows = _labelled(labels, key, label, held_out)
    order = [F.xxhash64(F.lit("sample"), "of"), "of"]
    picked = [rows.where(condition).orderBy(*order).limit(each) for condition in (F.col("toxic"), ~F.col("toxic"))]
    ids = F.broadcast(picked[0].unionByName(picked[1]))
    return docs.select(F.col(key).alias("key"), utf8(text).alias("text")).join(ids, F.col("key") == F.col("of")).select("text", "toxic", "key")


def _counted(sample: DataFrame) -> DataFrame:
    """(feature, toxic, clean): numbers of documents; the empty feature has all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            names = list(counts[0].keys() | counts[1].keys())
            columns = [pa.array(names, pa.binary()), *(pa.array([c[n] for n in names], pa.int64()) for c in counts)]
            return pa.RecordBatch.from_arrays(columns, names=["feature", "toxic", "clean"])

        for batch in batches:
            for value, toxic in zip(batch.column(0), batch.column(1)):
                found = {f for w in set(words(value.as_py())) for f in features(w)}
                counts[0 if toxic.as_py() else 1].update([b"", *found])
                if len(counts[0]) + len(counts[1]) > _FLUSH:
                    yield out()
                    counts = (Counter(), Counter())
        yield out()

    rows = sample.select("text", "toxic").mapInArrow(count, "feature binary, toxic long, clean long")
    return rows.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _markers(counts: DataFrame) -> tuple[list[bytes], int, int]:
    """Features of toxic documents by a likelihood-ratio test; documents of either label."""
    counts = counts.cache()
    total = counts.where(F.col("feature") == F.lit(b"")).first()
    n_toxic, n_clean = (total["toxic"], total["clean"]) if total else (0, 0)
    if not n_toxic or not n_clean:
        counts.unpersist()
        return [], n_toxic, n_clean
    tested = counts.where((F.col("feature") != F.lit(b"")) & (F.col("toxic") > 0))
    # Twice the logarithm of the number of tests, and some more: none should pass by chance. Features too
    # rare to pass are no tests.
    frequent = tested.where(F.col("toxic") + F.col("clean") >= 5).count()
    least = 2 * math.log(max(frequent, 2)) + 3
    share = n_toxic / (n_toxic + n_clean)
    both = F.col("toxic") + F.col("clean")
    term = lambda n, p: F.when(n > 0, n * F.log(n / (both * p))).otherwise(0.0)
    ratio = 2 * (term(F.col("toxic"), F.lit(share)) + term(F.col("clean"), F.lit(1 - share)))
    odds = (F.col("toxic") / n_toxic) / ((F.col("clean") + 0.5) / n_clean)
    kept = tested.withColumn("ratio", ratio).where((F.col("ratio") >= least) & (odds >= 4)).orderBy(F.desc("ratio"), "feature").limit(MARKERS)
    found = [bytes(r["feature"]) for r in kept.select("feature").collect()]
    counts.unpersist()
    return found, n_toxic, n_clean


def _chain_rows(sample: DataFrame, each: int) -> tuple[list[list[bytes]], np.ndarray]:
    """Texts as words, each different word held once, and whether they are toxic."""
    order = [F.xxhash64("key"), "text"]
    texts, labels, known = [], [], {}
    for toxic in (True, False):
        for row in sample.where(F.col("toxic") == toxic).orderBy(*order).limit(each).select("text").toLocalIterator():
            texts.append([known.setdefault(w, w) for w in words(bytes(row["text"]))])
            labels.append(toxic)
    return texts, np.array(labels, bool)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", each: int = SAMPLE, held_out: int | None = 0) -> Model:
    """Fit on at most `each` documents of either label, none of the fold `held_out`.

    Only the share of toxic documents is that of all labelled documents outside the fold, so that scores
    do not depend on which labels are cut at `each`.
    """
    markers, n_toxic, n_clean = _markers(_counted(_sampled(docs, labels, key, text, label, each, held_out)))
    if not n_toxic or not n_clean:
        return Model()
    numbers = {f: i for i, f in enumerate(markers)}
    few = _sampled(docs, labels, key, text, label, min(each, CHAIN_SAMPLE), held_out)
    texts, toxic = _chain_rows(few, CHAIN_SAMPLE)
    active = Remembered(lambda w: [numbers[f] for f in features(w) if f in numbers])
    place, feature, tokens, at = array("q"), array("q"), array("q"), 0
    for t, bad in zip(texts, toxic):
        for i, found in enumerate(map(active.__getitem__, t)):
            if found:
                place.extend([at + i] * len(found))
                feature.extend(found)
                if bad:
                    tokens.append(at + i)
        at += -(-len(t) // _LENGTH) * _LENGTH
    weights, bias, chain = _learned(np.array(place, np.int64), np.array(feature, np.int64), len(markers), [len(t) for t in texts], np.array(tokens, np.int64))
    model = Model(dict(zip(markers, weights.tolist())), bias, chain)
    x = np.array([summary(m) for group in _groups(texts) for m in model.marginals(group)])
    counts = np.array([(~toxic).sum(), toxic.sum()])
    share = _toxic_share(docs, labels, key, label, held_out)
    prior = (n_clean + n_toxic) * np.array([1 - share, share]) / np.maximum(counts, 1)
    model.calibration, model.known = _logistic(x, toxic, prior[toxic.astype(int)]), None
    return model


def _groups(texts: list[list[bytes]]) -> Iterator[list[list[bytes]]]:
    """The texts in groups of about `_FIT_AT_ONCE` words."""
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t)
        if size >= _FIT_AT_ONCE:
            yield group
            group, size = [], 0
    if group:
        yield group


def _blocks(place: np.ndarray, lengths: list[int], tokens: np.ndarray) -> list[tuple[int, slice, np.ndarray, np.ndarray]]:
    """Runs of sequences: the first place, their part of `place` (which ascends), mask and labels as (position, sequence)."""
    starts = np.concatenate([[0], np.cumsum([-(-n // _LENGTH) * _LENGTH for n in lengths])]).astype(np.int64)
    mask, labels = np.zeros(starts[-1], bool), np.zeros(starts[-1], bool)
    for at, n in zip(starts, lengths):
        mask[at:at + n] = True
    labels[tokens] = True
    blocks = []
    for first in range(0, len(mask), _FIT_AT_ONCE):
        end = min(first + _FIT_AT_ONCE, len(mask))
        own = slice(*np.searchsorted(place, [first, end]))
        turned = [np.ascontiguousarray(x[first:end].reshape(-1, _LENGTH).T) for x in (mask, labels)]
        blocks.append((first, own, *turned))
    return blocks


def _learned(place: np.ndarray, feature: np.ndarray, n: int, lengths: list[int], tokens: np.ndarray) -> tuple[np.ndarray, float, Chain]:
    """Weights, bias and chain by gradient ascent with running moments; `place` counts sequence by sequence.

    The gradient is summed over blocks of sequences, so that the driver holds the doubles of one block only.
    """
    theta = np.concatenate([np.full(n, 1.0), [-4.0, -2.0, 0.0, 0.0, 0.0]])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    blocks = _blocks(place, lengths, tokens)
    for step in range(1, _EPOCHS + 1):
        chain = Chain(theta[n + 1:n + 4], theta[n + 4])
        slope = -0.1 * theta
        for start, own, mask, labels in blocks:
            at, known = place[own] - start, feature[own]
            flat = np.bincount(at, weights=theta[known], minlength=mask.size) + theta[n]
            by_score, by_transition, by_start = chain.gradient(flat.reshape(-1, _LENGTH).T, mask, labels.astype(float))
            spread = np.ascontiguousarray(by_score.T).reshape(-1)
            slope += np.concatenate([np.bincount(known, weights=spread[at], minlength=n), [spread.sum()], by_transition, [by_start]])
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        theta = theta + 0.2 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return theta[:n], float(theta[n]), Chain(theta[n + 1:n + 4], float(theta[n + 4]))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Coefficients by Newton's method, with a small ridge that keeps separable data finite."""
    theta = np.zeros(x.shape[1])
    ridge = np.diag([0.05] * (x.shape[1] - 1) + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        slope = x.T @ (weight * (y - p)) - ridge @ theta
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + ridge
        step = np.linalg.solve(curve, slope)
        theta = theta + step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
    return theta


_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def _spans(text: bytes, marginals: np.ndarray) -> list[dict]:
    """UTF-8 offsets of runs of words that are more likely toxic than not."""
    bad = np.flatnonzero(marginals > 0.5)
    if not len(bad):
        return []
    places = [m.span() for m in WORD_BYTES.finditer(text.lower())]
    runs = np.split(bad, np.flatnonzero(np.diff(bad) > 1) + 1)
    return [{"start": places[r[0]][0], "end": places[r[-1]][1]} for r in runs]


def _small_batches(spark: SparkSession) -> None:
    """Arrow batches of `_BATCH` rows at most: workers stay alive beside the next job and keep what they took."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(spark.conf.get(name))
    spark.conf.set(name, str(min(rows, _BATCH) if rows > 0 else _BATCH))


def tagged(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns `keep` (all but the text by default) of each row with `score` and `toxic_spans`."""
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    rows = docs.select(utf8(text).alias("text"), F.struct(*[F.col(column(c)) for c in keep]).alias("row"))
    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType()), T.StructField("toxic_spans", _SPANS)])
    spans_kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    _small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in batches:
            scores, spans, group, size = [], [], [], 0
            for i in range(len(batch)):
                value = batch.column(0)[i].as_py()
                group.append((value, words(value)))
                size += len(group[-1][1])
                if size >= _AT_ONCE or i == len(batch) - 1:
                    for (t, _), found in zip(group, own.marginals([w for _, w in group])):
                        scores.append(own.score(found))
                        spans.append(_spans(t, found))
                    group, size = [], 0
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(scores, pa.float64()), pa.array(spans, spans_kind)], names=["row", "score", "toxic_spans"])

    found = rows.mapInArrow(tag, schema)
    return found.select(*[F.col("row")[c].alias(c) for c in keep], "score", "toxic_spans")


def scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: key, held_out, score, predicted, and the number of toxic spans."""
    found = tagged(docs.select(key, text), fit(docs, labels, key, text), text)
    return found.select(
        key,
        F.coalesce(fold(key) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("toxic_spans").cast("long").alias("n_spans"),
    )


def clean(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` without the documents that are predicted to be toxic."""
    found = tagged(docs, fit(docs, labels, key, text), text, keep=docs.columns)
    return found.where(F.col("score") < 0.5).select(*docs.columns)
