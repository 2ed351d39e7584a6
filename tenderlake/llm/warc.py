"""WARC archives of captured pages: writing, reading, and assembling transactions.

A capture is written as a request, a response (or revisit) and a metadata record; request and
metadata name the response in WARC-Concurrent-To. Equal payloads of at least `revisit_bytes` bytes
are stored once, in the response with the largest page id; the others are revisits that refer to it.

Archives go through Spark's text writer, which commits whole files or none: a record is one row, and
its closing blank lines are the line separator. Reading parses records by Content-Length and joins
the three kinds on the id of the response, one nested row per capture.

Null html or url is empty; line breaks in a url are written as blanks. Every row is a capture: of equal
rows (page id, url, html) one is as if it stood alone, the others are copies of it with ids of their own.
A null page id is written as an empty field and read back as null, and counts as smaller than any id. Of
captures with one page id and one payload, the one with the largest url is the response. Pages of any
size that one task can hold are written whole, each in one record. Other columns are ignored, whatever
their names. An empty table gives an empty archive and no captures.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.operators.joins import splittable
from tenderlake.storage import materialize, new_path

# Fixed values of the format.
VERSION = "WARC/1.1"
LINE = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
FILE_BYTES = 32 << 20
# Numbers that tasks are dealt to for counting equal rows.
_PARTS = 4096
_STATUS = f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "


def base32_sha1(data: Column) -> Column:
    """SHA-1 in upper-case base32: five hex digits are four base32 digits."""
    digits = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _urn(kind: str, capture: str = "capture") -> Column:
    """A record id made of the capture and the kind of record, so that a task run again writes the same."""
    h = F.md5(F.concat_ws("/", F.col(capture), F.lit(kind)))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(kind: str, fields: list[tuple[str, Column]], body: Column) -> Column:
    """A whole record but for the blank lines after it."""
    head = [F.lit(f"{VERSION}{LINE}WARC-Type: {kind}{LINE}WARC-Date: {DATE}{LINE}")]
    head += [F.concat(F.lit(f"{name}: "), value, F.lit(LINE)) for name, value in fields if value is not None]
    length = F.octet_length(body).cast("string")
    return F.concat(*head, F.lit("Content-Length: "), length, F.lit(LINE + LINE), body)


def _rows(pages: DataFrame) -> DataFrame:
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce("url", F.lit("")).alias("raw_url"),
        F.coalesce("html", F.lit("")).alias("html"),
    )
    rows = rows.select("*", F.octet_length("html").cast("long").alias("bytes"), base32_sha1(F.col("html").cast("binary")).alias("digest"))
    rows = rows.withColumn("capture", F.md5(F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("")), "digest", "raw_url")))
    return rows.withColumn("url", F.regexp_replace("raw_url", r"[\r\n]", " "))


def captures(pages: DataFrame, revisit_bytes: int = 0) -> DataFrame:
    """Different captures with payload size and digest, the capture that holds the payload, and how many rows are equal.

    Equal rows are counted by task (`counts` has pairs of a task's number and its rows), so that what has to be
    written for them can be dealt over tasks again. Only keys are shuffled here. The holders of payloads are a
    joined side with an exchange of its own, so that Spark can split the captures of a payload that many
    pages share.
    """
    keys = ["capture", "page_id", "url", "bytes", "digest"]
    rows = _rows(pages).select(*keys, F.pmod(F.spark_partition_id(), F.lit(_PARTS)).alias("part"))
    rows = rows.groupBy(*keys, "part").agg(F.count("*").alias("n"))
    rows = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("part", "n"))).alias("counts"))
    holder = F.max(F.struct("page_id", "url", "capture"))
    groups = rows.where(F.col("bytes") >= revisit_bytes).groupBy("digest").agg(holder.alias("holder"))
    return rows.join(splittable(groups, ["digest"]), "digest", "left")


def _copies(known: DataFrame, rows: DataFrame, revisit_bytes: int) -> DataFrame:
    """The second and further of equal rows, as captures of their own.

    A copy of a payload that is stored once is a revisit and needs no html; shorter payloads are written again.
    """
    counted = F.transform("counts", lambda x, i: F.struct(x["part"], (x["n"] - F.when(i == 0, 1).otherwise(0)).alias("n")))
    parts = known.withColumn("of", F.explode(counted)).where("of.n > 0").repartition("capture", "of.part")
    copies = parts.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "of.n")).alias("copy"))
    number = F.concat_ws("+", "capture", F.col("of.part").cast("string"), F.col("copy").cast("string"))
    first = F.when(F.col("bytes") >= revisit_bytes, F.col("holder"))
    copies = copies.select("page_id", "url", "bytes", "digest", "capture", number.alias("own"), first.alias("holder"))
    stored = copies.where(F.col("bytes") >= revisit_bytes).withColumn("html", F.lit(""))
    if revisit_bytes <= 0:
        return stored.drop("capture").withColumnRenamed("own", "capture")
    again = rows.where(F.col("bytes") < revisit_bytes).select("capture", "html").dropDuplicates(["capture"])
    again = copies.where(F.col("bytes") < revisit_bytes).join(splittable(again, ["capture"]), "capture")
    return stored.unionByName(again).drop("capture").withColumnRenamed("own", "capture")


def records(pages: DataFrame, revisit_bytes: int = 0) -> DataFrame:
    """The text of every record, in a column `value`."""
    # Written, so that both uses see the same numbers of equal rows.
    known = materialize(captures(pages, revisit_bytes), "captures")
    rows = _rows(pages).join(known.select("capture", "holder"), "capture").dropDuplicates(["capture"])
    rows = rows.select("page_id", "url", "bytes", "digest", "holder", "html", "capture")
    rows = rows.unionByName(_copies(known.where((F.size("counts") > 1) | (F.col("counts")[0]["n"] > 1)), _rows(pages), revisit_bytes))
    response = _urn("response")
    revisit = F.col("holder").isNotNull() & (F.col("holder.capture") != F.col("capture"))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    uri = ("WARC-Target-URI", F.col("url"))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    http = F.concat(F.lit(_STATUS), F.col("bytes").cast("string"), F.lit(LINE + LINE))
    http_type = ("Content-Type", F.lit("application/http; msgtype=response"))
    stored = _record("response", [("WARC-Record-ID", response), uri, digest, http_type], F.concat(http, F.col("html")))
    refers = [("WARC-Refers-To", _urn("response", "holder.capture")), ("WARC-Profile", F.lit(REVISIT_PROFILE))]
    again = _record("revisit", [("WARC-Record-ID", response), uri, digest, *refers, http_type], http)
    asked = F.concat(F.lit("GET "), F.col("url"), F.lit(f" HTTP/1.1{LINE}{LINE}"))
    concurrent = ("WARC-Concurrent-To", response)
    request = _record("request", [("WARC-Record-ID", _urn("request")), uri, concurrent, ("Content-Type", F.lit("application/http; msgtype=request"))], asked)
    holder_page = F.when(revisit, F.coalesce(F.col("holder.page_id").cast("string"), F.lit(""))).otherwise(F.lit(""))
    about = F.concat(F.lit("page-id: "), page, F.lit(f"{LINE}payload-bytes: "), F.col("bytes").cast("string"), F.lit(f"{LINE}holder-page-id: "), holder_page, F.lit(LINE))
    metadata = _record("metadata", [("WARC-Record-ID", _urn("metadata")), uri, concurrent, ("Content-Type", F.lit("application/warc-fields"))], about)
    return rows.select(F.explode(F.array(request, F.when(revisit, again).otherwise(stored), metadata)).alias("value"))


def write(pages: DataFrame, path: str, revisit_bytes: int = 0, file_bytes: int = FILE_BYTES) -> None:
    """Gzipped archives of about `file_bytes` each, before compression, under `path`."""
    n, size = pages.agg(F.count("*"), F.sum(F.octet_length("html"))).first()
    each = (size or 0) / max(n, 1) / 3 + 400
    rows = records(pages, revisit_bytes)
    rows.write.option("lineSep", LINE + LINE).option("compression", "gzip").option("maxRecordsPerFile", int(file_bytes / each) + 1).text(path)


def parsed(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode("utf-8").split(LINE)
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = {name.lower(): value for name, _, value in (x.partition(": ") for x in lines)}
        start = end + 4
        stop = start + int(fields["content-length"])
        if data[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where its length says")
        yield fields, data[start:stop]
        at = stop + 4


_KINDS = {
    "kind": pa.string(), "record_id": pa.string(), "of": pa.string(), "uri": pa.string(), "digest": pa.string(), "refers_to": pa.string(),
    "head": pa.string(), "payload": pa.binary(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
}
_READ = ", ".join(f"{n} {'binary' if k == pa.binary() else 'bigint' if k == pa.int64() else 'string'}" for n, k in _KINDS.items())


def _read_row(fields: dict[str, str], block: bytes) -> tuple:
    record = fields["warc-record-id"]
    payload = size = digest = None
    if fields["warc-type"] == "response":
        block, _, payload = block.partition(b"\r\n\r\n")
        size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if fields["warc-payload-digest"] != f"sha1:{digest}":
            raise ValueError(f"the payload of {record} has another digest than its header says")
    return (
        fields["warc-type"], record, fields.get("warc-concurrent-to", record), fields.get("warc-target-uri"), fields.get("warc-payload-digest"),
        fields.get("warc-refers-to"), block.decode("utf-8"), payload, size, digest,
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives under `path`; `of` is the id of the response they belong to.

    `head` is the HTTP header, the request or the metadata fields; payload, its size and its digest
    (computed from the payload and held against the header's) are those of responses.
    """

    def records_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for fields, block in parsed(zlib.decompress(content.as_py(), 31)):
                    rows.append(_read_row(fields, block))
                    held += len(block)
                    if held > 8 << 20 or len(rows) >= 5000:
                        yield _batch(rows)
                        rows, held = [], 0
                yield _batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(records_of, _READ)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(_KINDS)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, _KINDS.values())], names=list(_KINDS))


def transactions(found: DataFrame) -> DataFrame:
    """One nested row per capture: its response or revisit, with the request and metadata concurrent to it."""
    main = found.where(F.col("kind").isin("response", "revisit"))
    answer = F.struct("record_id", "digest", "refers_to", "head", "payload", "payload_bytes", "payload_digest")
    main = main.select(F.col("record_id").alias("of"), "kind", "uri", answer.alias("answer"))
    request = found.where(F.col("kind") == "request").select("of", F.struct("record_id", "uri", "head").alias("request"))
    fields = F.str_to_map(F.rtrim(F.translate("head", "\r", "")), F.lit("\n"), F.lit(": "))
    metadata = found.where(F.col("kind") == "metadata").select("of", F.struct("record_id", fields.alias("fields")).alias("metadata"))
    joined = main.join(request, "of", "left").join(metadata, "of", "left")
    return joined.withColumnRenamed("of", "capture_id")


def round_trip(pages: DataFrame, revisit_bytes: int = 0) -> DataFrame:
    """Write archives to the shared folder and read them back as transactions."""
    path = new_path(pages.sparkSession, "warc")
    write(pages, path, revisit_bytes)
    return transactions(read(pages.sparkSession, path))


def page_digests(assembled: DataFrame) -> DataFrame:
    """Page id, payload size and digest, kind of record, and for revisits the page that holds the payload."""
    field = lambda name: F.nullif(F.col("metadata.fields")[name], F.lit(""))
    revisit = F.col("kind") == "revisit"
    return assembled.select(
        field("page-id").cast("long").alias("page_id"),
        F.when(revisit, field("payload-bytes").cast("long")).otherwise(F.col("answer.payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.substring_index("answer.digest", ":", -1)).otherwise(F.col("answer.payload_digest")).alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.when(revisit, field("holder-page-id").cast("long")).alias("refers_to"),
    )
