"""Sharding by extendible hashing, in DataFrame operations only.

Documents are placed by the leading bits of a hash of their key. The directory has one entry for each
prefix; a bucket that holds more bytes than a shard may is split on the next bit, others are left
alone, until every shard fits. A round looks at fifteen bits at once: bytes are summed for each
fifteen-bit prefix of the buckets still open, these sums are added up for all shorter prefixes, and
each bucket closes at the first bit where it fits. Only buckets that are still too large go on.

After the 60 bits of the key's hash come 60 bits of a hash of the row's place in a written table, so
that rows of one key split as well. A bucket of one row is a shard whatever its size.

Null keys hash like the text 'null', null texts have no bytes, each repeated row is a row of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlake.operators.joins import splittable
from tenderlake.storage import materialize

SHARD_BYTES = 1 << 20
_STEP = 15
_BITS = 60


def _hash(value: Column) -> Column:
    """The first 60 bits of an MD5 digest as a text of zeros and ones."""
    return F.lpad(F.conv(F.substring(F.md5(value), 1, 15), 16, 2), _BITS, "0")


def _closed(open_rows: DataFrame, depth: int, limit: int) -> DataFrame:
    """(full, shard): for each prefix of `depth + _STEP` bits, the bucket that closes in this round, or null."""
    sums = open_rows.groupBy(F.substring("bits", 1, depth + _STEP).alias("full")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"))
    lengths = F.sequence(F.lit(depth), F.lit(depth + _STEP))
    each = sums.select("full", "bytes", "n", F.explode(lengths).alias("length")).withColumn("prefix", F.expr("substring(full, 1, length)"))
    fits = each.groupBy("prefix").agg(F.sum("bytes").alias("total"), F.sum("n").alias("rows"))
    fits = fits.where((F.col("total") <= limit) | (F.col("rows") == 1)).select(F.col("prefix").alias("fitting"))
    # All of a table's prefixes share the short ones, so Spark must be free to split this join.
    found = each.join(splittable(fits, ["fitting"]), F.col("prefix") == F.col("fitting"), "left")
    # Of the fitting prefixes of one path, the shortest sorts first.
    return found.groupBy("full").agg(F.min("fitting").alias("shard"))


def shards(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = SHARD_BYTES) -> DataFrame:
    """One row per row of `docs`: key, bytes, shard (its prefix, '' if one shard holds all) and depth (bits)."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("place"))
    rows = materialize(rows, "shard-rows")
    own, place = _hash(F.coalesce(F.col("key").cast("string"), F.lit("null"))), _hash(F.concat(F.lit("#"), F.col("place").cast("string")))
    still = rows.select("key", "bytes", F.concat(own, place).alias("bits"))
    done = None
    for depth in range(0, 2 * _BITS, _STEP):
        directory = splittable(_closed(still, depth, limit), ["full"])
        met = still.join(directory, F.substring("bits", 1, depth + _STEP) == F.col("full"))
        met = materialize(met.select("key", "bytes", "bits", "shard"), "shard-round")
        closed = met.where("shard is not null").select("key", "bytes", "shard")
        done = closed if done is None else done.unionByName(closed)
        still = met.where("shard is null").select("key", "bytes", "bits")
        if still.isEmpty():
            break
    else:
        done = done.unionByName(still.select("key", "bytes", F.col("bits").alias("shard")))
    return done.select(F.col("key").alias(key), "bytes", "shard", F.length("shard").alias("depth"))
