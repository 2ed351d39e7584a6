"""SimHash fingerprints of documents: 3-word shingles, XXH64, majority of each bit."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.llm.common import utf8

SEED = 42
SHINGLE = 3
_LANES = np.uint64(0x0101010101010101)
_PART = 255 * 256


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each of the 64 bits; sums of up to 255 stay in the eight bytes of a word."""
    padded = np.zeros(-(-len(hashes) // 255) * 255, np.uint64)
    padded[: len(hashes)] = hashes
    padded = padded.reshape(-1, 255)
    counts = np.zeros(64, np.int64)
    for bit in range(8):
        sums = ((padded >> np.uint64(bit)) & _LANES).sum(axis=1, dtype=np.uint64)
        counts[bit::8] = sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return counts


def fingerprint(text: bytes) -> int:
    """The 64-bit fingerprint of a text in UTF-8; zero if it has no words."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    if len(tokens) < SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(tokens), SEED)
    shingles = map(b" ".join, zip(*(islice(tokens, i, None) for i in range(SHINGLE))))
    counts, n, digest = np.zeros(64, np.int64), len(tokens) - SHINGLE + 1, xxhash.xxh64_intdigest
    for start in range(0, n, _PART):
        size = min(_PART, n - start)
        counts += bit_counts(np.fromiter((digest(s, SEED) for s in islice(shingles, size)), np.uint64, size))
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: key and fingerprint (a signed 64-bit integer)."""
    rows = docs.select(F.col(key).alias("key"), utf8(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py()) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=["key", "fingerprint"])

    return rows.mapInArrow(compute, f"key {kind}, fingerprint long")
