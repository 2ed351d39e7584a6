"""Source divergence audit: how far each source's words are from other sources and from its language.

Every (lang, source) group and every lang gives each kept term (one that stands in at least
`least_documents` documents of the lang) a smoothed share p in billionths. Two shares differ by
floor((p - q)^2 / (p + q)). A pair of sources differs by the sum over all kept terms; a source's terms
are those it has more of than its lang, the most different first.

The first terms come from dominance skybands. A term dominates another if its group count is not lower,
its lang count not higher and its spelling earlier in UTF-8; it then differs as much at least, and
wins ties. So a term dominated by k others is not among the first k. Each bucket of terms keeps those
dominated by fewer than k of its terms, skybands are merged over slices of buckets and then once
more, and what is left is ranked by its exact differences.

One pass over the documents counts terms by group; a task's partial counts are bounded, and what it
emits is shuffled by lang and term once. Terms of a lang are dealt over buckets of bounded size, so a
lang with most rows is many buckets; each holds a small matrix of terms by groups of the lang. Its pair
sums are of the size of the result. Counts are exact at any size: where 64 bits might not hold a
product, Python integers do.

Null lang, source and text count as empty. Empty texts make a group without terms; rows that repeat an
id, or whole rows, are documents each. Texts of any length are read whole. Other columns are ignored,
whatever their names. An empty table has no groups.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenderlake.llm.common import utf8
from tenderlake.storage import materialize

UNIT = 10**9
LEAST_DOCUMENTS = 10
FIRST_TERMS = 10
# Terms of a bucket on average, buckets merged by a first merge, and partial counts a task holds at most.
BUCKET_TERMS = 4096
SLICES = 16
HELD_COUNTS = 250_000
# All bytes but letters and those beyond ASCII separate terms; letters go to lower case.
_SEPARATED = bytes(b if b >= 0x80 or chr(b).isalpha() else 32 for b in range(256)).lower()


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_SEPARATED).split()


def _partial_counts(docs: DataFrame, text: str) -> DataFrame:
    """(lang, source, term, n, docs) by task; the term '' stands for the group's documents."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = docs.select(name("lang"), name("source"), utf8(text).alias("text"))

    def emit(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (counts, documents) in held.items():
            n = len(counts)
            columns = [pa.array([lang] * n), pa.array([source] * n), pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(map(documents.__getitem__, counts), pa.int64())], names=["lang", "source", "term", "n", "docs"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = defaultdict(lambda: (Counter(), Counter()))
        size = 0
        for batch in batches:
            for lang, source, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                counts, documents = held[lang, source]
                found = terms_of(value.as_py())
                size -= len(counts)
                counts.update(found)
                counts[b""] += 0
                size += len(counts)
                documents.update(set(found))
                documents[b""] += 1
                if size > HELD_COUNTS:
                    yield from emit(held)
                    held.clear()
                    size = 0
        yield from emit(held)

    return rows.mapInArrow(count, "lang string, source string, term string, n long, docs long")


def grid(docs: DataFrame, text: str = "text", least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, term, n, docs, cells of source and n) of every kept term; a row of the term '' lists the lang's groups."""
    # Shuffled by lang and term, which serves both groupings.
    parts = _partial_counts(docs, text).repartition("lang", "term")
    cells = parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    rows = cells.groupBy("lang", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("cells")
    )
    return rows.where((F.col("docs") >= least_documents) | (F.col("term") == ""))


def _groups(found: DataFrame) -> DataFrame:
    """(lang, source, n, lang_n, v): counts over kept terms, and how many terms the lang keeps."""
    langs = found.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.count_if(F.col("term") != "").alias("v"))
    langs = langs.withColumn("lang_n", F.when(F.col("v") > 0, F.col("lang_n")).otherwise(F.lit(0)))
    cells = found.select("lang", F.inline("cells"))
    return cells.groupBy("lang", "source").agg(F.sum("n").alias("n")).join(langs, "lang")


def shares(counts: np.ndarray, total) -> np.ndarray:
    """p of each count; `total` is N + 2 V."""
    if counts.max(initial=0) + 2 > (1 << 63) // UNIT - 1:
        return (1 + UNIT * (counts.astype(object) + 2) // total).astype(np.int64)
    return 1 + UNIT * (counts + 2) // total


def differences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def skyband(high: np.ndarray, low: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """Places of those dominated by fewer than k others: by a higher `high`, a lower `low`, an earlier `order` (all different).

    In this order no one is dominated by a later one, and whoever has k dominators has k in the skyband.
    """
    places = np.lexsort((order, low, -high))
    low, order = low[places], order[places]
    band_low, band_order, kept, at_once = low[:0], order[:0], [], 256
    for start in range(0, len(places), at_once):
        own_low, own_order = low[start:start + at_once], order[start:start + at_once]
        n = ((band_low <= own_low[:, None]) & (band_order < own_order[:, None])).sum(axis=1)
        n += np.tril((own_low <= own_low[:, None]) & (own_order < own_order[:, None]), -1).sum(axis=1)
        few = np.flatnonzero(n < k)
        kept.append(places[start + few])
        band_low, band_order = np.concatenate([band_low, own_low[few]]), np.concatenate([band_order, own_order[few]])
    return np.concatenate(kept) if kept else places


def _spelling(terms: list[bytes]) -> np.ndarray:
    """Each term's place in UTF-8 order."""
    order = np.zeros(len(terms), np.int64)
    order[sorted(range(len(terms)), key=terms.__getitem__)] = np.arange(len(terms))
    return order


_FOUND = "lang string, source string, part string, item string, bucket int, value long, n long, lang_n long, p long, q long"
_KINDS = [pa.string()] * 4 + [pa.int32()] + [pa.int64()] * 5
_SCHEMA = pa.schema([(f.split()[0], kind) for f, kind in zip(_FOUND.split(", "), _KINDS)])


def _bucket(terms: pa.Table, groups: pa.Table, k: int) -> pa.Table:
    """Pair sums and each group's skyband over one bucket of a lang's terms."""
    lang, bucket = groups.column("lang")[0].as_py(), groups.column("bucket")[0].as_py()
    sources = groups.column("source").to_pylist()
    totals = groups.column("n").to_numpy() + 2 * groups.column("v").to_numpy()
    lang_total = groups.column("lang_n")[0].as_py() + 2 * groups.column("v")[0].as_py()
    names = [t.encode() for t in terms.column("term").to_pylist()]
    counts = np.zeros((len(names), len(sources)), np.int64)
    place = {s: i for i, s in enumerate(sources)}
    for row, cells in enumerate(terms.column("cells").to_pylist()):
        for cell in cells:
            counts[row, place[cell["source"]]] = cell["n"]
    lang_counts = terms.column("n").to_numpy().astype(np.int64)
    p = np.stack([shares(counts[:, s], int(totals[s])) for s in range(len(sources))], axis=1) if names else counts
    q = shares(lang_counts, lang_total) if names else lang_counts
    spelling, out = _spelling(names), []
    for s, source in enumerate(sources):
        sums = differences(p, p[:, s:s + 1]).sum(axis=0)
        out.extend((lang, source, "pair", other, bucket, int(sums[t]), None, None, None, None) for t, other in enumerate(sources) if t != s)
        more = np.flatnonzero((counts[:, s] > 0) & (p[:, s] > q))
        for i in more[skyband(counts[more, s], lang_counts[more], spelling[more], k)]:
            out.append((lang, source, "term", names[i].decode(), bucket, None, int(counts[i, s]), int(lang_counts[i]), int(p[i, s]), int(q[i])))
    return pa.Table.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out) if out else [()] * len(_KINDS), _KINDS)], schema=_SCHEMA)


def _merged(found: DataFrame, keys: list, k: int) -> DataFrame:
    """The skyband of the skybands that share `keys`."""

    def merge(held: pa.Table) -> pa.Table:
        names = [t.encode() for t in held.column("item").to_pylist()]
        high, low = held.column("n").to_numpy(), held.column("lang_n").to_numpy()
        return held.take(pa.array(skyband(high, low, _spelling(names), k))).select(_SCHEMA.names)

    return found.groupBy(*keys).applyInArrow(merge, _FOUND)


def audit(docs: DataFrame, text: str = "text", least_documents: int = LEAST_DOCUMENTS, first_terms: int = FIRST_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: of part `pair` all other sources of the lang, of part `term` the first terms."""
    found = materialize(grid(docs, text, least_documents), "term-grid")
    groups = materialize(_groups(found), "term-groups")
    most = groups.agg(F.max("v")).first()[0] or 0
    buckets = max(1, math.ceil(most / BUCKET_TERMS))
    terms = found.where("term <> ''").withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int"))
    # Each bucket meets the groups of its lang, also where the lang keeps no term.
    about = groups.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    met = terms.groupBy("lang", "bucket").cogroup(about.groupBy("lang", "bucket"))
    found = materialize(met.applyInArrow(lambda left, right: _bucket(left, right, first_terms), _FOUND), "divergence")
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    bands = _merged(found.where("part = 'term'"), ["lang", "source", F.pmod("bucket", F.lit(SLICES))], first_terms)
    bands = _merged(bands, ["lang", "source"], first_terms)
    bands = bands.select("lang", "source", "part", "item", F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [x.withColumn("rank", F.row_number().over(order)) for x in (pairs, bands)]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= first_terms))
