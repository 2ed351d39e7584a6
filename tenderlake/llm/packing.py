"""Pattern packing: token pieces into sequences of bounded length, by non-negative least squares.

Each document's ids, with the end id last, are cut into pieces of at most `capacity` ids; only longer
documents are cut. What is packed is the histogram of piece lengths, which has at most `capacity`
entries whatever the number of documents, so the plan is made on the driver:

- lengths are rounded up to classes, and patterns of up to three classes that fill a sequence are
  enumerated;
- non-negative least squares fits how often each pattern is repeated to the histogram, every class
  weighed by its length, and the repeats are rounded and held to what is there;
- patterns are filled with lengths of their classes, longest first, and the residual goes best fit,
  longest first, into the room that is left and into new sequences. Equal sequences are one entry
  with a count all along.

The plan gives each length a list of slots. A piece's number among those of its length is its number
in its task plus those of earlier tasks (one sum for each task and length), and slots are found by
that number: no group of pieces, however many have one length, meets in one task. The plan is the only
broadcast data; its entries are bounded by the numbers of patterns and lengths.

Null and empty texts have the end id only; rows that repeat a key, or whole rows, are packed each; null
keys stay null. Texts of any length are cut by the same rule. Other columns are ignored, whatever
their names. An empty table has no pieces.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenderlake.llm.tokenfiles import END_ID, coder
from tenderlake.storage import materialize

CAPACITY = 4096
# Classes that lengths are rounded up to.
CLASSES = 512
# Columns that may enter the fit at once, and rounds of the fit; the residual is packed exactly in any case.
_AT_ONCE, _ROUNDS = 16, 300
_BATCH_BYTES = 8 << 20


@dataclass
class Group:
    """`repeats` sequences alike: (length, times) one after another, and the room left."""

    repeats: int
    parts: list[tuple[int, int]]
    rest: int

    def with_part(self, repeats: int, length: int, times: int) -> Group:
        return Group(repeats, [*self.parts, (length, times)], self.rest - length * times)


def patterns(classes: int) -> np.ndarray:
    """All (a, b, c) with a >= b >= c >= 0 and a + b + c = `classes`; 0 is no piece."""
    rows = []
    for a in range(-(-classes // 3), classes + 1):
        b = np.arange(-(-(classes - a) // 2), min(a, classes - a) + 1)
        rows.append(np.stack([np.full(len(b), a), b, classes - a - b], axis=1))
    return np.concatenate(rows)


def fitted_repeats(columns: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Non-negative least squares by active sets: how often each pattern is repeated.

    `target` counts pieces by class (place 0 is unused). Several columns without a common class enter
    at once.
    """
    weights = np.arange(len(target)) / (len(target) - 1)
    scale = target.max(initial=0)
    wanted = weights * target / max(scale, 1)
    active, x = np.zeros(0, np.int64), np.zeros(0)
    residual, least = wanted, 1e-9

    def matrix(chosen: np.ndarray) -> np.ndarray:
        out = np.zeros((len(target), len(chosen)))
        np.add.at(out, (columns[chosen].T, np.arange(len(chosen))), weights[columns[chosen].T])
        return out

    for _ in range(_ROUNDS):
        gain = (weights * residual)[columns].sum(axis=1)
        gain[active] = 0
        entering, used = [], set()
        for j in np.argsort(-gain)[: 40 * _AT_ONCE]:
            if gain[j] <= least or len(entering) == _AT_ONCE:
                break
            own = set(columns[j].tolist()) - {0}
            if not own & used:
                entering.append(j)
                used |= own
        if not entering:
            break
        active, x = np.concatenate([active, entering]), np.concatenate([x, np.zeros(len(entering))])
        while len(active):
            a = matrix(active)
            best = np.linalg.solve(a.T @ a + 1e-9 * np.eye(len(active)), a.T @ wanted)
            below = best <= 0
            if not below.any():
                x = best
                break
            step = np.min(x[below] / np.maximum(x[below] - best[below], 1e-300))
            x = x + step * (best - x)
            keep = (x > 1e-12) | ~below
            active, x = active[keep], x[keep]
        before, residual = residual, wanted - matrix(active) @ x
        if residual @ residual >= (before @ before) * (1 - 1e-6):
            break
    repeats = np.zeros(len(columns))
    repeats[active] = x * scale
    return repeats


def _taken(counts: np.ndarray, lengths: range, n: int) -> list[tuple[int, int]]:
    """(length, number) of n pieces of a class, longest first; they leave `counts`."""
    out = []
    for length in reversed(lengths):
        number = min(n, int(counts[length]))
        if number:
            out.append((length, number))
            counts[length] -= number
            n -= number
        if not n:
            break
    return out


def _from_patterns(counts: np.ndarray, capacity: int, width: int) -> list[Group]:
    """Sequences by the fitted patterns; what they use leaves `counts`."""
    classes = capacity // width
    place = -(-np.arange(capacity + 1) // width)
    columns = patterns(classes)
    repeats = np.rint(fitted_repeats(columns, np.bincount(place, counts, classes + 1) * (np.arange(classes + 1) > 0)))
    groups = []
    for j in sorted(np.flatnonzero(repeats), key=lambda j: (-repeats[j], j)):
        own = [int(c) for c in columns[j] if c]
        lengths = {c: range((c - 1) * width + 1, c * width + 1) for c in own}
        n = min(int(repeats[j]), *(sum(int(counts[i]) for i in lengths[c]) // own.count(c) for c in own))
        slots = [_taken(counts, lengths[c], n) for c in own]
        # Sequences are alike between two changes of length in any slot.
        while n:
            alike = min(slot[0][1] for slot in slots)
            parts = [(slot[0][0], 1) for slot in slots]
            groups.append(Group(alike, parts, capacity - sum(length for length, _ in parts)))
            n -= alike
            slots = [[(s[0][0], s[0][1] - alike), *s[1:]] if s[0][1] > alike else s[1:] for s in slots]
    return groups


def _best_fit(groups: list[Group], counts: np.ndarray, capacity: int) -> list[Group]:
    """All of `counts`, longest first, each into the sequence with the least room that takes it."""
    by_rest: list[list[Group]] = [[] for _ in range(capacity + 1)]
    for g in groups:
        by_rest[g.rest].append(g)
    filled = np.array([len(x) > 0 for x in by_rest])

    def put(g: Group) -> None:
        by_rest[g.rest].append(g)
        filled[g.rest] = True

    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            room = length + int(np.argmax(filled[length:]))
            if filled[room]:
                g = by_rest[room].pop()
                filled[room] = bool(by_rest[room])
            else:
                room, g = capacity, Group(left, [], capacity)
            # A sequence takes the length again while there is room: it has then the least room that does.
            times = min(room // length, left)
            n = min(g.repeats, left // times)
            put(g.with_part(n, length, times))
            if g.repeats > n and room < capacity:
                put(Group(g.repeats - n, g.parts, g.rest))
            left -= n * times
    return [g for held in by_rest for g in held]


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[Group]:
    """Groups of sequences that hold exactly `counts[i]` pieces of each length i."""
    counts = counts.astype(np.int64).copy()
    width = max(1, -(-capacity // CLASSES))
    groups = _from_patterns(counts, capacity - capacity % width, width) if capacity >= width and counts.sum() else []
    groups = [Group(g.repeats, g.parts, g.rest + capacity % width) for g in groups]
    return _best_fit(groups, counts, capacity)


def slots(groups: list[Group]) -> dict[int, np.ndarray]:
    """By length, rows of: pieces up to and with this entry, first sequence, times in a sequence, offset there."""
    out: dict[int, list[tuple]] = {}
    sequence = 0
    for g in groups:
        offset = 0
        for length, times in g.parts:
            rows = out.setdefault(length, [])
            before = rows[-1][0] if rows else 0
            rows.append((before + g.repeats * times, sequence, times, offset))
            offset += length * times
        sequence += g.repeats
    return {length: np.array(rows, np.int64) for length, rows in out.items()}


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text", end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, `ids` if asked for; part and nth number it among its length."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = f"key {rows.schema['key'].dataType.simpleString()}, piece int, start long, length int, ids_crc32 long, part int, nth long" + ", ids binary" * ids
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()][: len(names) - 1]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end, step = coder(path), struct.pack("<I", end_id), 4 * capacity
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            place, out, held = [], [], 0

            def finished() -> pa.RecordBatch:
                columns = [pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * len(kinds), kinds)]
                return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(place, pa.int64())), *columns], names=names)

            for row, value in enumerate(batch.column(1)):
                all_ids = words.encode(value.as_py()) + end
                for number, at in enumerate(range(0, len(all_ids), step)):
                    own = all_ids[at:at + step]
                    length = len(own) // 4
                    place.append(row)
                    out.append((number, at // 4, length, zlib.crc32(own), part, int(seen[length]), *[own] * ids))
                    seen[length] += 1
                    held += len(own) * ids + 40
                    if held > _BATCH_BYTES:
                        yield finished()
                        place, out, held = [], [], 0
            yield finished()

    return rows.mapInArrow(cut, schema)


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text", end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """One row per piece: key, piece (from 0), start, length, ids_crc32, sequence_id, offset, and `ids` if asked for."""
    spark = docs.sparkSession
    found = materialize(pieces(docs, path, capacity, key, text, end_id, ids), "pieces")
    totals = materialize(found.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-lengths")
    counts = np.zeros(capacity + 1, np.int64)
    # At most one row for each length.
    for r in totals.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[r["length"]] = r["n"]
    held = spark.sparkContext.broadcast(slots(plan(counts, capacity)))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    rest = ["key", "piece", "start", "ids_crc32", *["ids"] * ids]
    numbered = found.join(bases, ["part", "length"]).select("length", (F.col("base") + F.col("nth")).alias("number"), *rest)
    kinds = dict(numbered.dtypes)
    schema = ", ".join([f"{n} {kinds[n]}" for n in rest] + ["length long", "sequence_id long", "offset long"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_length = held.value
        for batch in batches:
            lengths, numbers = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            sequences, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            order = np.argsort(lengths, kind="stable")
            for at in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(order) else []:
                length, number = int(lengths[at[0]]), numbers[at]
                rows = by_length[length]
                entry = np.searchsorted(rows[:, 0], number, side="right")
                within = number - np.where(entry > 0, rows[entry - 1, 0], 0)
                sequences[at] = rows[entry, 1] + within // rows[entry, 2]
                offsets[at] = rows[entry, 3] + within % rows[entry, 2] * length
            columns = [*batch.columns[2:], pa.array(lengths.astype(np.int64)), pa.array(sequences), pa.array(offsets)]
            yield pa.RecordBatch.from_arrays(columns, names=[*rest, "length", "sequence_id", "offset"])

    return numbered.mapInArrow(place, schema).withColumnRenamed("key", key)


def sequences(placed: DataFrame) -> DataFrame:
    """The ids of each sequence, pieces in order of their offsets, from `packed(..., ids=True)`; a sequence is of bounded size."""
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(ordered, F.lit(b""), lambda whole, x: F.concat(whole, x["ids"]))
    return placed.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("length"))


def digests(docs: DataFrame, path: str, **options) -> DataFrame:
    """Where each piece stands, without its ids."""
    key = options.get("key", "doc_id")
    return packed(docs, path, **options).select(key, "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
