"""Fuzzy line deduplication, in DataFrame operations only.

Lines are normalised: lower case, no blanks at either end. Equal lines are one node. A line's SimHash is
the majority, bit by bit, of the hashes of its different pieces, the halves of its words. Its 64 bits are sixteen blocks, and the blocks are the points of the affine plane of order four: each of
the plane's twenty lines of four points makes a key of sixteen bits. It takes seven points to meet every
line of that plane, so fingerprints that differ in six bits or fewer share a key with certainty, and most
of those with a few more. Length is a part of the key: classes of a factor `CLASS`, and a text near the
end of a class is in the next one too.

Fingerprints that share a key and differ in `MOST_BITS` or fewer are verified by the edit similarity of
their texts, `LEAST_SIMILARITY` or more. Pairs go before that whose counts of `SIGNS` differ by more than
twice the edits allowed: an edit changes two counts by one at most, so none of them can be alike. Connected
groups keep the occurrence that comes first by document and line number, and all other occurrences go.
README has the measured recall.

A group of many near copies would have a link for every two of them. So key rows without a close partner
go first, by a semi-join that stops at the first partner it meets; then texts are linked to the first
fingerprint of each of their keys, and only pairs that are still apart after that are formed. Those left
out are in one group already, so the groups are those of all links.

Hashes are computed where the lines are read; bits are counted by a tree of adders, in a line of up to `ADDED` pieces. Texts are shuffled for lines only that have a partner to be
verified against: others are kept back by a map of `MAP_BITS` bits, a constant of two megabytes at any
size of the data.

Empty lines stay. Null and empty texts have no lines to compare; lines of any length are hashed and
compared whole. Rows equal in key and text are one document; of other rows that repeat a key each is a
document, the one with the smaller text hash first. Null keys come before all others. Other columns are
untouched, whatever their names and types. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.llm.common import column, orderable
from tenderlake.llm.components import components
from tenderlake.storage import materialize

MOST_BITS = 9
LEAST_SIMILARITY = 0.97
# Factor from one class of lengths to the next.
CLASS = 1.25
BLOCK_BITS, ORDER = 4, 4
MAP_BITS = 24
# Most pieces of a line that are counted by adders.
ADDED = 255
# Eight signs that are counted in every text before two texts are compared.
SIGNS = "eantiosr"
# HotSpot compiles no method with more bytes of code.
LARGEST_METHOD = "spark.sql.codegen.hugeMethodLimit", "8000"


def _product(a: int, b: int) -> int:
    """Multiplication in the field of four elements."""
    return 0 if not a or not b else (a + b - 2) % 3 + 1


def plane() -> list[list[int]]:
    """The lines of the affine plane of order four as lists of its points: any two points are on one line."""
    numbers = range(ORDER)
    sloped = [[x * ORDER + (_product(m, x) ^ c) for x in numbers] for m in numbers for c in numbers]
    return sloped + [[c * ORDER + y for y in numbers] for c in numbers]


def _lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, doc, line, norm): one row per line, normalised; empty lines are not compared.

    The text is put in lower case before it is cut, once for all uses of its lines.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(value).alias("doc"), F.posexplode(F.split(F.lower(value), "\n", -1)).alias("line", "low"))
    return rows.select("key", "doc", "line", F.trim("low").alias("norm"))


def _id(norm: Column) -> Column:
    return F.unhex(F.md5(norm))


def _anew(lookup: DataFrame, key: str) -> DataFrame:
    """The lookup with its key as an expression: it is shuffled for the join, whose hot keys Spark may split then."""
    same = F.concat(key, F.lit(b"")) if dict(lookup.dtypes)[key] == "binary" else F.col(key) + F.lit(0).cast("long")
    return lookup.withColumn(key, same)


def _pieces(norm: Column) -> Column:
    """Hashes of a line's different pieces: both halves of its words, or runs of three where a script has no blanks."""
    half = lambda w: F.shiftright(F.length(w) + 1, 1)
    words = F.split(norm, " ")
    begins = F.transform(words, lambda w: F.xxhash64(F.substring(w, F.lit(1), half(w))))
    ends = F.transform(words, lambda w: F.xxhash64(F.substring(w, half(w) + 1, F.lit((1 << 31) - 1)), F.lit(1)))
    runs = F.transform(F.regexp_extract_all(norm, F.lit("[^ ]{1,3}"), F.lit(0)), lambda w: F.xxhash64(w))
    return F.when(F.octet_length(norm) > 2 * F.length(norm), F.array_distinct(runs)).otherwise(F.array_union(begins, ends))


def _shifts(width: int) -> list[int]:
    """By how much hashes are shifted so that, with the parts of `width` bits of a number below its sign, every bit is counted."""
    return [*range(width), *range(63 // width * width, 64)]


def _mask(width: int) -> Column:
    """The lowest bit of every part of `width` bits below the sign."""
    return F.lit(sum(1 << width * at for at in range(63 // width))).cast("long")


def _sums(hashes: Column, width: int) -> Column:
    """Counts of ones, side by side in parts of `width` bits."""

    def added(shift: int) -> Column:
        return F.aggregate(hashes, F.lit(0).cast("long"), lambda n, h: n + F.shiftrightunsigned(h, shift).bitwiseAND(_mask(width)))

    return F.array(*map(added, _shifts(width)))


def _majority(width: int) -> Column:
    """The fingerprint from the sums: bits that are ones in over half the `n` hashes, fewer than half of what a part can hold.

    All parts of a number are compared at once: what is added to each lifts counts over half of `n`, and
    no others, to the part's highest bit.
    """
    lift = F.lit((1 << width - 1) - 1).cast("long") - F.shiftright(F.col("n").cast("long"), 1)
    over = lambda sums: F.shiftrightunsigned(sums + lift * _mask(width), width - 1).bitwiseAND(_mask(width))
    bits = [F.shiftleft(over(F.get("sums", F.lit(at))), shift) for at, shift in enumerate(_shifts(width))]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def _planes(rows: DataFrame, kept: list[str]) -> DataFrame:
    """`kept` columns of `rows` and, as plane0, plane1 and so on, the bits of how many of `ADDED` hashes have a one, for 64 places at once.

    A tree of adders over whole numbers: three of one weight become one of that weight and one of the next.
    Every layer is a projection, so each number is computed once. Hashes that a line does not have are zeros.
    """
    names = [f"hash{i}" for i in range(ADDED)]
    rows = rows.select(*kept, *[F.coalesce(F.get("hashes", F.lit(i)), F.lit(0).cast("long")).alias(n) for i, n in enumerate(names)])
    weights, made = [names], 0
    while any(len(w) > 1 for w in weights):
        layer, after = [], [[] for _ in range(len(weights) + 1)]
        for at, weight in enumerate(weights):
            # Two are left alone while more may come from the weights below.
            last = len(weight) == 2 and all(len(w) == 1 for w in weights[:at])
            for group in (weight[i : i + 3] for i in range(0, len(weight), 3)):
                if len(group) == 3 or len(group) == 2 and last:
                    a, b, *c = map(F.col, group)
                    either = a.bitwiseXOR(b)
                    carry = a.bitwiseAND(b).bitwiseOR(either.bitwiseAND(c[0])) if c else a.bitwiseAND(b)
                    layer += [(either.bitwiseXOR(c[0]) if c else either).alias(f"s{made}"), carry.alias(f"c{made}")]
                    after[at].append(f"s{made}")
                    after[at + 1].append(f"c{made}")
                    made += 1
                else:
                    layer += group
                    after[at] += group
        rows, weights = rows.select(*kept, *layer), [w for w in after if w]
    return rows.select(*kept, *[F.col(w).alias(f"plane{i}") for i, (w,) in enumerate(weights)])


def _over_half(planes: int) -> Column:
    """The fingerprint from the planes: bits whose count is over half of `n`, compared from the lowest plane up."""
    over = F.lit(0).cast("long")
    for at in range(planes):
        limit = -F.shiftright("n", at + 1).bitwiseAND(F.lit(1)).cast("long")
        plane = F.col(f"plane{at}")
        over = plane.bitwiseAND(F.bitwise_not(limit)).bitwiseOR(F.bitwise_not(plane.bitwiseXOR(limit)).bitwiseAND(over))
    return over


def _hashed(rows: DataFrame) -> DataFrame:
    """(key, doc, line, id, fp, size), null but for the first three where a line is empty.

    Lines of up to `ADDED` pieces are counted by adders. For others counts stand in parts as wide as the
    number of pieces asks for.
    """
    some = F.when(F.col("norm") != "", F.col("norm"))
    fits = lambda width: F.col("n") < 1 << width - 1
    pick = lambda make: F.when(fits(9), make(9)).when(fits(12), make(12)).otherwise(make(31))
    few = F.col("n") <= ADDED
    rows = rows.select("key", "doc", "line", _id(some).alias("id"), F.length(some).alias("size"), _pieces(some).alias("hashes"))
    rows = rows.select("key", "doc", "line", "id", "size", F.size("hashes").alias("n"), "hashes")
    rows = rows.withColumn("sums", F.when(~few, pick(lambda w: _sums(F.col("hashes"), w))))
    rows = _planes(rows, ["key", "doc", "line", "id", "size", "n", "sums"])
    fp = F.when(few, _over_half(ADDED.bit_length())).otherwise(pick(_majority))
    return rows.select("key", "doc", "line", "id", "size", F.when(F.col("id").isNotNull(), fp).alias("fp"))


def _keyed(prints: DataFrame, similarity: float) -> DataFrame:
    """(key, fp): the twenty keys of each fingerprint in its class of lengths, and in the next where a longer partner may be."""
    place = lambda size, more: F.floor(F.log(size) / F.lit(math.log(CLASS)) + F.lit(more)).cast("int")
    classes = F.sequence(place(F.col("size"), 0.0), place(F.col("size") / F.lit(similarity), 1e-9))
    rows = prints.select("fp", F.explode(classes).alias("class"))
    block = lambda at: F.shiftrightunsigned("fp", BLOCK_BITS * at).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))
    keys = []
    for number, points in enumerate(plane()):
        bits = reduce(lambda a, b: a.bitwiseOR(b), [F.shiftleft(block(p), BLOCK_BITS * i) for i, p in enumerate(points)])
        keys.append(F.shiftleft((F.lit(number * 64) + F.col("class")).cast("long"), 16).bitwiseOR(bits).cast("int"))
    return rows.select(F.explode(F.array(*keys)).alias("key"), "fp")


def _differing(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _close(prints: DataFrame, bits: int, similarity: float) -> DataFrame:
    """Key rows that have a partner of another fingerprint within `bits`; both sides are one shuffle."""
    keyed = _keyed(prints, similarity)
    near = F.expr(f"ours.key = theirs.key and ours.fp <> theirs.fp and bit_count(ours.fp ^ theirs.fp) <= {bits}")
    return keyed.alias("ours").join(keyed.alias("theirs"), near, "left_semi").select("key", "fp")


def _allowed(left: Column, right: Column, similarity: float) -> Column:
    """Edits that two lengths allow."""
    return F.floor(F.greatest(left, right) * F.lit(1 - similarity) + F.lit(1e-9)).cast("int")


def _sized(pairs: DataFrame, similarity: float) -> DataFrame:
    """Pairs whose lengths, `left_size` and `right_size`, do not rule them out, with the edits allowed as `most`."""
    apart = F.abs(F.col("left_size") - F.col("right_size"))
    pairs = pairs.withColumn("most", _allowed(F.col("left_size"), F.col("right_size"), similarity))
    return pairs.where(apart <= F.col("most")).drop("left_size", "right_size")


def _counted(text: Column) -> Column:
    """How often each of `SIGNS` stands in the text, up to 255, a byte each."""
    size = F.octet_length(text)
    counts = [F.least(size - F.octet_length(F.replace(text, F.lit(sign))), F.lit(255)).cast("long") for sign in SIGNS]
    return reduce(lambda a, b: a.bitwiseOR(b), [F.shiftleft(c, 8 * i) for i, c in enumerate(counts)])


def _counts_apart(left: str, right: str) -> Column:
    """By how much two texts' counts differ in all: by two at most for an edit, so by more than twice the edits allowed only if too many are needed."""
    part = lambda name, i: F.shiftrightunsigned(name, 8 * i).bitwiseAND(F.lit(255).cast("long"))
    return reduce(lambda a, b: a + b, [F.abs(part(left, i) - part(right, i)) for i in range(len(SIGNS))])


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often it is named there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _middles(left: Column, right: Column, use: Callable[[Column, Column], Column]) -> Column:
    """`use` of what is left of two arrays of words without their common beginning and end, every word with a blank after it."""
    equal = lambda a, b: F.coalesce(F.array_position(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), False), F.lit(0)).cast("int")

    def counted(p: Column) -> Column:
        shorter = F.least(F.size(p["a"]), F.size(p["b"]))
        return F.struct(p["a"].alias("a"), p["b"].alias("b"), shorter.alias("shorter"), equal(p["a"], p["b"]).alias("at"), equal(F.reverse(p["a"]), F.reverse(p["b"])).alias("back"))

    def cut(p: Column, words: Column) -> Column:
        before = F.when(p["at"] == 0, p["shorter"]).otherwise(p["at"] - 1)
        after = F.least(F.when(p["back"] == 0, p["shorter"]).otherwise(p["back"] - 1), p["shorter"] - before)
        return F.array_join(F.transform(F.slice(words, before + 1, F.size(words) - before - after), lambda w: F.concat(w, F.lit(" "))), "")

    both = F.struct(left.alias("a"), right.alias("b"))
    return _once(both, lambda p: _once(counted(p), lambda q: use(cut(q, q["a"]), cut(q, q["b"]))))


def _word_edits(left: Column, right: Column) -> Column:
    """Edits that turn two arrays of equally many words into each other word by word, at least the edit distance of their texts; else null."""
    edits = F.zip_with(left, right, lambda x, y: F.when(x == y, F.lit(0)).otherwise(F.levenshtein(x, y)))
    return F.when(F.size(left) == F.size(right), F.aggregate(edits, F.lit(0), lambda n, e: n + e))


def _alike(pairs: DataFrame, similarity: float) -> DataFrame:
    """Those (u, v, left_text, right_text) whose edit distance is within 1 - `similarity` of the longer one.

    Most near copies have as many words, and few enough edits word by word; others are compared whole. A
    common beginning or end does not change the distance, and most near copies have long ones.
    """
    allowed = _allowed(F.length("left_text"), F.length("right_text"), similarity)
    apart = lambda a, b: F.call_function("levenshtein", a, b, allowed)
    both = F.struct(F.split("left_text", " ").alias("a"), F.split("right_text", " ").alias("b"))
    by_word = lambda p: F.coalesce(_word_edits(p["a"], p["b"]) <= allowed, F.lit(False))
    alike = _once(both, lambda p: F.when(by_word(p), F.lit(True)).otherwise(_middles(p["a"], p["b"], apart) >= 0))
    return pairs.where(alike).drop("left_text", "right_text")


def _place(ids: DataFrame) -> DataFrame:
    """`ids` with the word and the bit of the map that stand for `id`."""
    at = F.pmod(F.xxhash64("id"), F.lit(1 << MAP_BITS))
    return ids.withColumns({"word": F.shiftright(at, 6).cast("int"), "bit": F.pmod(at, F.lit(64)).cast("int")})


def _bit_map(ids: DataFrame) -> DataFrame:
    """One row: the words of a map of `MAP_BITS` bits in which every id's bit is set."""
    marked = _place(ids).groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
    every = ids.sparkSession.range(1 << MAP_BITS - 6).select(F.col("id").cast("int").alias("word"))
    rows = every.join(marked, "word", "left").select(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")).alias("one"))
    return rows.agg(F.transform(F.sort_array(F.collect_list("one")), lambda x: x["bits"]).alias("map"))


def _texts(docs: DataFrame, key: str, text: str, needed: DataFrame) -> DataFrame:
    """(nid, text, signs) of the lines whose id is in `needed` (id, nid)."""
    marks = materialize(_bit_map(needed), "line-map")
    rows = _lines(docs, key, text).where("norm <> ''").select("norm", _id(F.col("norm")).alias("id"))
    held = F.get(marks.scalar(), F.col("word")).alias("held")
    rows = _place(rows).select("id", "norm", "bit", held).where("shiftrightunsigned(held, bit) & 1L = 1L")
    met = rows.select("id", "norm").join(_anew(needed.withColumnRenamed("id", "of"), "of"), F.col("id") == F.col("of"))
    return met.groupBy("nid").agg(F.any_value("norm").alias("text")).withColumn("signs", _counted(F.col("text")))


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Those (u, v, most, ...) of `pairs` that are alike; texts are read for pairs only whose counts allow it."""
    left, right = texts.select("nid", "signs").toDF("u", "left_signs"), texts.select("nid", "signs").toDF("v", "right_signs")
    pairs = pairs.join(_anew(left, "u"), "u").join(_anew(right, "v"), "v").where(_counts_apart("left_signs", "right_signs") <= F.col("most") * 2)
    pairs = pairs.drop("left_signs", "right_signs", "most")
    left, right = texts.select("nid", "text").toDF("u", "left_text"), texts.select("nid", "text").toDF("v", "right_text")
    return _alike(pairs.join(_anew(left, "u"), "u").join(_anew(right, "v"), "v"), similarity)


def _groups(docs: DataFrame, key: str, text: str, distinct: DataFrame, bits: int, similarity: float) -> DataFrame:
    """(node, root) of the distinct lines that are linked; both are numbers of `distinct` (nid, id, fp, size)."""
    least = math.ceil(1 / (1 - similarity) - 1e-9) if similarity < 1 else 1 << 30
    # Shorter lines have no room for an edit, but a line one character short of that may lack the one that a partner has.
    long_enough = distinct.where(F.col("size") >= least - 1)
    # A fingerprint that several lines have is keyed by all their lengths.
    prints = long_enough.select("fp", "size").distinct()
    close = materialize(_close(prints, bits, similarity).distinct(), "line-keys")
    one = long_enough.groupBy("fp").agg(F.min("nid").alias("lead"), F.count("*").alias("n"))
    wanted = close.select("fp").distinct()
    several = one.where("n > 1").select("fp")
    members = long_enough.select("nid", "id", "fp", "size").join(_anew(wanted.unionByName(several).distinct().withColumnRenamed("fp", "f"), "f"), F.col("fp") == F.col("f"), "left_semi")
    members = materialize(members, "line-members")
    texts = materialize(_texts(docs, key, text, members.select("id", "nid")), "line-texts")
    first = members.groupBy("fp").agg(F.min(F.struct("nid", "size")).alias("lead"))
    left = _anew(first, "fp").select("fp", F.col("lead.nid").alias("u"), F.col("lead.size").alias("left_size"))
    right = _anew(first, "fp").select(F.col("fp").alias("first"), F.col("lead.nid").alias("v"), F.col("lead.size").alias("right_size"))
    firsts = close.groupBy("key").agg(F.min("fp").alias("first"))
    stars = close.join(_anew(firsts.withColumnRenamed("key", "k"), "k").withColumn("k", F.col("k").cast("int")), F.col("key") == F.col("k"))
    stars = stars.where((F.col("fp") != F.col("first")) & (_differing("fp", "first") <= bits)).select("fp", "first").distinct()
    stars = stars.join(left, "fp").join(right, "first").drop("fp", "first")
    same = members.select(F.col("fp").alias("first"), F.col("nid").alias("u"), F.col("size").alias("left_size"))
    same = same.join(right, "first").where("u <> v").drop("first")
    links = materialize(_verified(_sized(stars.unionByName(same), similarity), texts, similarity).select("u", "v"), "line-links")
    roots = components(links, "u", "v")
    placed = members.join(_anew(roots, "node"), F.col("nid") == F.col("node"), "left").select("nid", "fp", "size", F.coalesce("root", "nid").alias("root"))
    placed = materialize(placed, "line-groups")
    others = _verified(_sized(_apart(placed, close, bits), similarity), texts, similarity).select("left_root", "right_root")
    merged = components(materialize(others.distinct(), "line-pairs"), "left_root", "right_root").toDF("from", "to")
    found = placed.join(_anew(merged, "from"), F.col("root") == F.col("from"), "left")
    return found.select(F.col("nid").alias("node"), F.coalesce("to", "root").alias("root"))


def _apart(placed: DataFrame, close: DataFrame, bits: int) -> DataFrame:
    """Pairs (u, v, left_root, right_root, left_size, right_size) of close lines that the first links leave apart.

    Pairs that are in one group already need no link.
    """
    columns = ["u", "v", "left_root", "right_root", "left_size", "right_size"]
    left, right = placed.toDF("u", "fp", "left_size", "left_root"), placed.toDF("v", "fp", "right_size", "right_root")
    same = left.join(right, "fp").where("left_root < right_root").select(*columns)
    rooted = close.join(_anew(placed.select("fp", "root").distinct(), "fp"), "fp")
    ours, theirs = rooted.toDF("a", "j", "left_root"), rooted.toDF("b", "k", "right_root")
    apart = (F.col("j") == F.col("k")) & (F.col("a") < F.col("b")) & (F.col("left_root") != F.col("right_root")) & (_differing("a", "b") <= bits)
    met = ours.join(theirs, apart).select("a", "left_root", "b", "right_root").distinct()
    met = met.join(left.withColumnRenamed("fp", "a"), ["a", "left_root"]).join(right.withColumnRenamed("fp", "b"), ["b", "right_root"])
    return same.unionByName(met.select(*columns))


@contextmanager
def _compiled(spark: SparkSession) -> Iterator[None]:
    """Meanwhile Spark runs steps one by one that would be too large to compile as one method."""
    name, value = LARGEST_METHOD
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", bits: int = MOST_BITS, similarity: float = LEAST_SIMILARITY) -> DataFrame:
    """One row per document: key, doc (hash of its text), n_lines compared, removed (line numbers from 0, sorted)."""
    with _compiled(docs.sparkSession):
        lines = materialize(_hashed(_lines(docs, key, text)), "lines")
    distinct = lines.where("id is not null").groupBy("id").agg(
        F.max("fp").alias("fp"), F.max("size").alias("size"), F.min(F.struct("key", "doc", "line")).alias("first"), F.count("*").alias("n")
    )
    distinct = materialize(distinct.withColumn("nid", F.monotonically_increasing_id()), "distinct-lines")
    groups = _groups(docs, key, text, distinct.select("nid", "id", "fp", "size"), bits, similarity)
    classes = distinct.select("nid", "id", "first", "n").join(_anew(groups, "node"), F.col("nid") == F.col("node"), "left")
    kept = classes.where("root is not null").groupBy(F.col("root").alias("r")).agg(F.min("first").alias("kept"))
    # Only lines that occur again, equal or alike, can have anything to remove.
    again = classes.where("n > 1 or root is not null").join(_anew(kept, "r"), F.col("root") == F.col("r"), "left")
    again = again.select(F.concat("id", F.lit(b"")).alias("again"), F.coalesce("kept", "first").alias("kept"))
    met = lines.select("key", "doc", "line", "id").join(again, F.col("id") == F.col("again"), "left")
    extra = F.col("kept").isNotNull() & ~F.struct("key", "doc", "line").eqNullSafe(F.col("kept"))
    return met.groupBy("key", "doc").agg(
        F.size(F.collect_set(F.when(F.col("id").isNotNull(), F.col("line")))).alias("n_lines"),
        F.sort_array(F.collect_set(F.when(extra, F.col("line")))).alias("removed"),
    )


def without_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """`docs` without the repeated lines; documents that lose all their lines go, all others stay.

    Documents that lose no line come out as they were. Of rows equal in key and text the one whose
    columns sort first stays (maps cannot be sorted and do not count).
    """
    found = repeated_lines(docs, key, text, **options).withColumnRenamed("key", "k_")
    rows = docs.select(F.struct(*[F.col(column(c)) for c in docs.columns]).alias("row"))
    value = F.coalesce(F.col("row")[text], F.lit(""))
    joined = rows.join(found, F.col("row")[key].eqNullSafe(F.col("k_")) & (F.xxhash64(value) == F.col("doc")))
    joined = joined.where((F.col("n_lines") == 0) | (F.size("removed") < F.col("n_lines")))
    kept = F.filter(F.split(value, "\n", -1), lambda _, i: ~F.array_contains(F.col("removed"), i))
    cut = F.when(F.size("removed") > 0, F.array_join(kept, "\n")).otherwise(F.col("row")[text])
    order = F.struct(*[F.col("row")[c] for c in orderable(docs)])
    first = joined.groupBy("k_", "doc").agg(F.min_by(F.struct(F.col("row"), cut.alias("cut")), order).alias("one"))
    return first.select(*[F.col("one.cut").alias(c) if c == text else F.col("one.row")[c].alias(c) for c in docs.columns])


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per document: lines compared, lines removed, and their numbers as text."""
    found = repeated_lines(docs, key, text, **options)
    numbers = F.array_join(F.transform("removed", lambda i: i.cast("string")), ",")
    return found.select(F.col("key").alias(key), F.col("n_lines").cast("long").alias("n_lines"), F.size("removed").cast("long").alias("n_removed"), numbers.alias("removed"))
