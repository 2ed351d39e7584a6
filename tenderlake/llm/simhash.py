"""Near-duplicate documents: SimHash fingerprints linked at few differing bits, found by Golay decoding.

A fingerprint is cut into three segments, each read as a word of the binary Golay code of 23 bits,
whose words lie within three bits of exactly one of 4,096 codewords. Two words that differ in one
bit share a codeword: the nearest of one is within four bits of the other. So each fingerprint has
one index a segment (its nearest codeword) and several nearby ones, and the first kind meets the
second in an equality join.

Three differing bits over three segments leave either one segment unchanged and another with at
most one difference, or one difference in each. Hence the keys: a segment as it is with the index
of another one (six ordered pairs), and the indices of the first two segments. Every join pair is
verified by counting the differing bits, so the links are exact.

Equal fingerprints are joined once, whatever their number of documents. Null and empty texts have
fingerprint zero and link like others. Repeated ids: each row keeps its own fingerprint, and the
component id is the smallest id reachable. A null id comes out as null and is never a component id
unless its component has no other.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.llm.common import column, orderable
from tenderlake.llm.components import components
from tenderlake.llm.fingerprints import fingerprints
from tenderlake.storage import materialize

# Fixed values of the binary Golay code: its length, information bits and generator polynomial.
LENGTH, INFORMATION, GENERATOR = 23, 12, 0b101011100011
MOST_BITS = 3
# First bit and width of each segment, and the ordered pairs (as it is, by index).
SEGMENTS = ((0, 22), (22, 21), (43, 21))
ORDERED = tuple((a, b) for a in range(3) for b in range(3) if a != b)
_CHECKS = LENGTH - INFORMATION


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of words after division by the generator."""
    rest = words.astype(np.uint32)
    for bit in range(LENGTH - 1, _CHECKS - 1, -1):
        rest = np.where(rest >> np.uint32(bit) & np.uint32(1), rest ^ np.uint32(GENERATOR << (bit - _CHECKS)), rest)
    return rest


@lru_cache(maxsize=1)
def error_patterns() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: the errors of up to four bits (up to three first), and how many there are."""
    patterns = np.array([sum(1 << i for i in places) for w in range(5) for places in combinations(range(LENGTH), w)], np.uint32)
    syndromes = _syndromes(patterns)
    table, counts = np.zeros((1 << _CHECKS, 6), np.uint32), np.zeros(1 << _CHECKS, np.int64)
    for pattern, syndrome in zip(patterns, syndromes):
        weight_four = int(pattern).bit_count() == 4
        # Beside a codeword at distance two or less, others are at distance five or more.
        if weight_four and int(table[syndrome, 0]).bit_count() < 3:
            continue
        table[syndrome, counts[syndrome]] = pattern
        counts[syndrome] += 1
    return table, counts


def indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codeword indices within four bits of each word, nearest first, and how many each word has."""
    table, counts = error_patterns()
    syndromes = _syndromes(words)
    near = (words.astype(np.uint32)[:, None] ^ table[syndromes]) >> np.uint32(_CHECKS)
    return near.astype(np.int64), counts[syndromes]


def _packed(kind: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One number of the key's kind, a segment or index of up to 22 bits, and an index of 12."""
    return (np.int64(kind) << 40) | (left << 12) | right


def keys(found: np.ndarray, nearby: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places in `found` and keys: by nearest codewords, or by all nearby ones."""
    bits = found.view(np.uint64)
    parts = [((bits >> np.uint64(start)) & np.uint64((1 << width) - 1)).astype(np.int64) for start, width in SEGMENTS]
    decoded = [indices(p) for p in parts]
    if not nearby:
        all_keys = [_packed(k, parts[a], decoded[b][0][:, 0]) for k, (a, b) in enumerate(ORDERED)]
        all_keys.append(_packed(len(ORDERED), decoded[0][0][:, 0], decoded[1][0][:, 0]))
        return np.tile(np.arange(len(found)), len(all_keys)), np.concatenate(all_keys)
    places, out = [], []
    width = decoded[0][0].shape[1]
    for k, (a, b) in enumerate(ORDERED):
        for i in range(width):
            at = np.flatnonzero(decoded[b][1] > i)
            places.append(at)
            out.append(_packed(k, parts[a][at], decoded[b][0][at, i]))
    for i in range(width):
        for j in range(width):
            at = np.flatnonzero((decoded[0][1] > i) & (decoded[1][1] > j))
            places.append(at)
            out.append(_packed(len(ORDERED), decoded[0][0][at, i], decoded[1][0][at, j]))
    return np.concatenate(places), np.concatenate(out)


def _keyed(found: DataFrame, nearby: bool) -> DataFrame:
    """(key, fp) rows of a table of distinct fingerprints."""
    at_once = 8192

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy()
            for start in range(0, len(values), at_once):
                part = values[start:start + at_once]
                places, found_keys = keys(part, nearby)
                yield pa.RecordBatch.from_arrays([pa.array(found_keys), pa.array(part[places])], names=["key", "fp"])

    return found.select("fp").mapInArrow(compute, "key long, fp long")


def links(found: DataFrame, bits: int = MOST_BITS) -> DataFrame:
    """Pairs (u, v) of distinct fingerprints in `fp` that differ in at most `bits` (three or fewer) bits."""
    if bits > MOST_BITS:
        raise ValueError(f"the keys find differences of {MOST_BITS} bits or fewer")
    nearest = _keyed(found, nearby=False).select(F.col("key").alias("k"), F.col("fp").alias("v"))
    near = _keyed(found, nearby=True).select("key", F.col("fp").alias("u"))
    different = F.bit_count(F.col("u").bitwiseXOR(F.col("v")))
    joined = near.join(nearest, (F.col("key") == F.col("k")) & (F.col("u") > F.col("v")) & (different <= bits))
    return joined.select("u", "v")


def _classes(rows: DataFrame, bits: int) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint in `rows`, which have key and fingerprint.

    The root is one fingerprint of the group, never null; component_id is the smallest key of the group.
    """
    distinct = materialize(rows.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("key").alias("first")), "distinct")
    roots = components(links(distinct, bits), "u", "v")
    classes = distinct.join(roots, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = classes.groupBy(F.col("root").alias("r")).agg(F.min("first").alias("component_id"))
    classes = classes.select("fp", "root").join(smallest, F.col("root") == F.col("r"))
    return classes.select((F.col("fp") + F.lit(0).cast("long")).alias("fp"), "root", "component_id")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", bits: int = MOST_BITS) -> DataFrame:
    """One row per row of `docs`: key, fingerprint, component_id (the smallest key reachable)."""
    rows = materialize(fingerprints(docs, key, text), "fingerprints")
    joined = rows.join(_classes(rows, bits).drop("root"), F.col("fingerprint") == F.col("fp"))
    text_form = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return joined.select(F.col("key").alias(key), text_form.alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text", bits: int = MOST_BITS) -> DataFrame:
    """`docs` with exactly one row of each near-duplicate group: that of the smallest key.

    Of the group's rows with this key, the one whose columns sort first stays (maps cannot be sorted and do not count). Rows are found again by
    key and text, so groups that share a key, or have none other than null, keep a row each.
    """
    text_id = F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))
    named = docs.select(F.struct(F.col(key).alias("key"), text_id.alias("text_id")).alias("at"), F.col(text).alias("text"))
    rows = materialize(fingerprints(named, "at", "text").select("key.key", "key.text_id", "fingerprint"), "fingerprints")
    found = rows.join(_classes(rows, bits), F.col("fingerprint") == F.col("fp"))
    keep = found.where(F.col("key").eqNullSafe(F.col("component_id"))).select("key", "text_id", "root").distinct()
    # Shuffled anew for the join, whose hot keys Spark may split then.
    keep = keep.select(F.col("key").alias("kept"), F.concat("text_id", F.lit(b"")).alias("kept_text"), "root")
    rows = docs.select(F.struct(*[F.col(column(c)) for c in docs.columns]).alias("row"))
    row_text = F.unhex(F.md5(F.coalesce(F.col("row")[text], F.lit(""))))
    kept = rows.join(keep, F.col("row")[key].eqNullSafe(F.col("kept")) & (row_text == F.col("kept_text")))
    order = F.struct(*[F.col("row")[c] for c in orderable(docs)])
    return kept.groupBy("root").agg(F.min_by("row", order).alias("row")).select("row.*")
