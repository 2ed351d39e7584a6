"""BPE encoding and decoding.

A pre-token's symbols stand in a doubly linked list; a priority queue holds the merge rank of every
neighbouring pair, lowest rank and leftmost first. A popped entry whose symbols have changed since
is stale and skipped. Decoding concatenates vocabulary strings.

Row-local: no shuffle, and a lost task is simply run again. Null texts are empty, empty texts have
no tokens, repeated rows and ids each give their own row; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderlake.llm import wordbpe

_END = "</w>"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class WordBpe:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        self.special = wordbpe.specials(path)
        self.strings = {i: s for s, i in vocab.items()} | {i: s for s, i in self.special.items()}
        self.vocab = vocab
        self.merges = {}
        for rank, (left, right) in enumerate(model["merges"]):
            self.merges[vocab[left], vocab[right]] = (rank, vocab[left + right])
        self.letters = byte_letters()
        self.library = wordbpe.load(path)
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.plain_ids = wordbpe.Remembered(lambda piece: self._packed(self.merge(self.spelled(piece))))
        self.other_ids = wordbpe.Remembered(lambda letters: self._packed(self.merge(letters)))

    def spelled(self, piece: str) -> str:
        return "".join([self.letters[b] for b in piece.encode("utf-8")])

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return array("I", ids).tobytes()

    def merge(self, letters: str) -> list[int]:
        """Ids of one pre-token, given as the letters of its bytes."""
        if not letters:
            return []
        ids = [self.vocab[c] for c in letters[:-1]] + [self.vocab[letters[-1] + _END]]
        last = len(ids) - 1
        before = list(range(-1, last))
        after = [*range(1, last + 1), -1]
        queue = []
        for at in range(last):
            if found := self.merges.get((ids[at], ids[at + 1])):
                queue.append((found[0], at, ids[at], ids[at + 1], found[1]))
        heapq.heapify(queue)
        while queue:
            _, at, left, right, merged = heapq.heappop(queue)
            follower = after[at]
            if ids[at] != left or follower < 0 or ids[follower] != right:
                continue
            ids[at], ids[follower] = merged, -1
            after[at] = following = after[follower]
            if following >= 0:
                before[following] = at
                if found := self.merges.get((merged, ids[following])):
                    heapq.heappush(queue, (found[0], at, merged, ids[following], found[1]))
            if (leading := before[at]) >= 0 and (found := self.merges.get((ids[leading], merged))):
                heapq.heappush(queue, (found[0], leading, ids[leading], merged, found[1]))
        return [i for i in ids if i >= 0]

    def _part(self, text: str) -> bytes:
        if wordbpe.plain(text):
            return b"".join(map(self.plain_ids.__getitem__, wordbpe.pieces(text)))
        normal = self.library.normalizer.normalize_str(text)
        return b"".join([self.other_ids[p] for p, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)])

    def encode(self, text: str) -> Iterator[bytes]:
        """Ids as little-endian unsigned 32-bit integers, in parts that follow each other."""
        for chunk in wordbpe.chunks(text):
            if self.split is None or not self.split.search(chunk):
                yield self._part(chunk)
                continue
            for part in self.split.split(chunk):
                yield self._packed([self.special[part]]) if part in self.special else self._part(part)

    def decode(self, ids: bytes) -> str:
        """Vocabulary strings one after another, a blank between two, as a vocabulary without a decoder asks."""
        return " ".join(map(self.strings.__getitem__, array("I", ids)))


@lru_cache(maxsize=1)
def coder(path: str) -> WordBpe:
    """One coder in each Python worker, kept from task to task."""
    return WordBpe(path)


def encoded(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: its key, `n_tokens`, `ids` and `decoded` (both as bytes)."""
    return _coded(docs, path, key, text, digests=False)


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Like `encoded`, with the SHA-256 of the ids and of the decoded text instead of both."""
    return _coded(docs, path, key, text, digests=True)


def _coded(docs: DataFrame, path: str, key: str, text: str, digests: bool) -> DataFrame:
    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).cast("string").alias("text"))
    names, kind = (("ids_sha256", "decoded_sha256"), T.StringType()) if digests else (("ids", "decoded"), T.BinaryType())
    schema = T.StructType([rows.schema[0], T.StructField("n_tokens", T.LongType()), *(T.StructField(n, kind) for n in names)])
    arrow = pa.string() if digests else pa.binary()

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path)
        for batch in batches:
            counts, first, second = [], [], []
            for value in batch.column(1):
                ids_sum, text_sum, n, ids_parts, strings = hashlib.sha256(), hashlib.sha256(), 0, [], []
                for ids in bpe.encode(value.as_py()):
                    if not ids:
                        continue
                    spoken = ((" " if n else "") + bpe.decode(ids)).encode("utf-8")
                    n += len(ids) // 4
                    if digests:
                        ids_sum.update(ids)
                        text_sum.update(spoken)
                    else:
                        ids_parts.append(ids)
                        strings.append(spoken)
                counts.append(n)
                first.append(ids_sum.hexdigest() if digests else b"".join(ids_parts))
                second.append(text_sum.hexdigest() if digests else b"".join(strings))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(first, arrow), pa.array(second, arrow)], names=schema.names)

    return rows.mapInArrow(code, schema)
