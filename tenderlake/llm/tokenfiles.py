"""Token ids in files: one zstandard dictionary, one frame per document, and an offset index.

A data set has two tables in the shared folder. `dictionary` holds the shared dictionary, trained on
the serialised ids of a sample of documents, and its SHA-256. `blocks` holds binary blocks of about
four megabytes in ascending key order: a header (magic, version, dictionary hash, number of frames)
and the frames, each a document's ids as little-endian unsigned 32-bit integers with the end id last.
Beside each block stands its index (key, first id, number of ids, offset and length of the frame), a
column of its own, so that finding a document reads no frames, and reading it one frame.

Documents are range-partitioned by key, so that no task sees more than its range; where ranges begin
among all ids follows from one sum per partition.

Null and empty texts have the end id only. Rows that repeat a key stand in the order of their text's
hash; null keys come first. A data set too small to train a dictionary uses its sample as one.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenderlake.llm import wordbpe
from tenderlake.storage import new_path

END_ID = 1
MAGIC, VERSION = b"TOKB", 1
BLOCK_BYTES = 4 << 20
# Documents that train the dictionary (those whose keys' hashes come first), and its size.
SAMPLE_DOCUMENTS = 512
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
_HEADER = "<4sI32sI"
_HEADER_BYTES = struct.calcsize(_HEADER)
_SHORT = 10_000


class WordCoder:
    """The library's encoder, asked once for each word it has not lately seen."""

    def __init__(self, path: str):
        self.library = wordbpe.load(path)
        self.special = [*wordbpe.specials(path)]
        self.ends = {i for s, i in self.library.get_vocab(with_added_tokens=False).items() if s.endswith("</w>")}
        self.known = wordbpe.Remembered(lambda piece: self._ids(piece))

    def _ids(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def _learn(self, pieces: list[str]) -> None:
        """Encode the unknown words of a text in one call; the last symbol of each word says where it ends."""
        new = [p for p in dict.fromkeys(pieces) if p not in self.known and p not in self.known.older]
        ids = self.library.encode(" ".join(new), add_special_tokens=False).ids if new else []
        start, at = 0, 0
        cut = []
        for at, i in enumerate(ids, 1):
            if i in self.ends:
                cut.append(array("I", ids[start:at]).tobytes())
                start = at
        if len(cut) == len(new):
            self.known.update(zip(new, cut))

    def encode(self, text: str) -> bytes:
        out = []
        for chunk in wordbpe.chunks(text):
            if not wordbpe.plain(chunk) or any(s in chunk for s in self.special):
                out.append(self._ids(chunk))
                continue
            pieces = wordbpe.pieces(chunk)
            self._learn(pieces)
            out.append(b"".join(map(self.known.__getitem__, pieces)))
        return b"".join(out)


@lru_cache(maxsize=1)
def coder(path: str) -> WordCoder:
    """One coder in each Python worker, kept from task to task."""
    return WordCoder(path)


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    value = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).alias("key"), value.alias("text"), F.xxhash64(value).alias("doc"))


def trained(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> bytes:
    """The shared dictionary, from a bounded sample; raw bytes of the sample where it is too small to train."""
    sample = _rows(docs, key, text).orderBy(F.xxhash64("key"), "doc").limit(SAMPLE_DOCUMENTS).select("text")

    def serialised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([coder(path).encode(t.as_py()) for t in batch.column(0)], pa.binary())], names=["ids"])

    samples = [bytes(r["ids"]) for r in sample.mapInArrow(serialised, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def write(docs: DataFrame, folder: str, path: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID) -> None:
    """Encode `docs` with the vocabulary at `path` into a data set under `folder`."""
    spark = docs.sparkSession
    dictionary = trained(docs, path, key, text)
    digest = hashlib.sha256(dictionary).digest()
    spark.createDataFrame([(digest.hex(), bytearray(dictionary))], "sha256 string, dictionary binary").coalesce(1).write.parquet(f"{folder}/dictionary")
    rows = _rows(docs, key, text).withColumn("place", F.monotonically_increasing_id())
    order = ["key", "doc", "place"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "text")
    kind = rows.schema["key"].dataType.simpleString()
    held = spark.sparkContext.broadcast(dictionary)
    arrow_key = pa.string() if kind == "string" else pa.int32() if kind == "int" else pa.int64()
    entry = pa.struct([("key", arrow_key), ("start", pa.int64()), ("n_tokens", pa.int64()), ("offset", pa.int64()), ("length", pa.int64())])
    schema = f"part int, block int, n_tokens long, data binary, index array<struct<key:{kind},start:bigint,n_tokens:bigint,offset:bigint,length:bigint>>"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(held.value), write_content_size=True)
        words, end = coder(path), struct.pack("<I", end_id)
        part, number, start = TaskContext.get().partitionId(), 0, 0
        frames, index, size, first = [], [], _HEADER_BYTES, 0

        def block() -> pa.RecordBatch:
            data = b"".join([struct.pack(_HEADER, MAGIC, VERSION, digest, len(frames)), *frames])
            columns = [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([start - first]), pa.array([data], pa.binary()), pa.array([index], pa.list_(entry))]
            return pa.RecordBatch.from_arrays(columns, names=["part", "block", "n_tokens", "data", "index"])

        for batch in batches:
            for name, text_value in zip(batch.column(0), batch.column(1)):
                ids = words.encode(text_value.as_py()) + end
                frame = compressor.compress(ids)
                index.append({"key": name.as_py(), "start": start, "n_tokens": len(ids) // 4, "offset": size, "length": len(frame)})
                frames.append(frame)
                size += len(frame)
                start += len(ids) // 4
                if size >= BLOCK_BYTES or len(frames) >= _SHORT:
                    yield block()
                    frames, index, size, first, number = [], [], _HEADER_BYTES, start, number + 1
        if frames:
            yield block()

    rows.mapInArrow(pack, schema).write.parquet(f"{folder}/blocks")


def read(spark: SparkSession, folder: str, key: str = "doc_id", ids: bool = False) -> DataFrame:
    """One row per document: key, start (ids of all documents before it), n_tokens, ids_crc32, and `ids` if asked for."""
    dictionary = spark.read.parquet(f"{folder}/dictionary").first()
    held = spark.sparkContext.broadcast((dictionary["sha256"], bytes(dictionary["dictionary"])))
    blocks = spark.read.parquet(f"{folder}/blocks")
    totals = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # One row per partition of the writing job.
    placed = blocks.join(F.broadcast(bases), "part").select("base", "data", "index")
    kind = blocks.schema["index"].dataType.elementType["key"].dataType.simpleString()
    schema = f"key {kind}, start long, n_tokens long, ids_crc32 long" + ", ids binary" * ids

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, raw = held.value
        if hashlib.sha256(raw).hexdigest() != digest:
            raise ValueError("the dictionary is not the one its hash names")
        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
        for batch in batches:
            for base, data, index in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                yield from _documents(base, data.as_py(), index.values, reader, digest, ids)

    return placed.mapInArrow(unpack, schema).withColumnRenamed("key", key)


def _documents(base: int, data: bytes, index: pa.StructArray, reader: zstandard.ZstdDecompressor, digest: str, ids: bool) -> Iterator[pa.RecordBatch]:
    magic, version, used, count = struct.unpack_from(_HEADER, data)
    if (magic, version, used.hex(), count) != (MAGIC, VERSION, digest, len(index)):
        raise ValueError("not a block of this format, dictionary and index")
    view, sums, frames, lengths = memoryview(data), [], [], []
    for offset, length in zip(index.field("offset").to_pylist(), index.field("length").to_pylist()):
        frame = reader.decompress(view[offset:offset + length])
        sums.append(zlib.crc32(frame))
        lengths.append(len(frame) // 4)
        frames.append(frame if ids else None)
    starts = [base + s for s in index.field("start").to_pylist()]
    columns = [index.field("key"), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())]
    columns += [pa.array(frames, pa.binary())] * ids
    yield pa.RecordBatch.from_arrays(columns, names=["key", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write `docs` to the shared folder and read them back."""
    folder = new_path(docs.sparkSession, "tokens")
    write(docs, folder, path, key, text)
    return read(docs.sparkSession, folder, key)
