"""Running totals, forward fill, ranks and risk bands without a one-partition window on data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderlake.fixed_values import BAND_CUTS, BAND_LABELS, SCORECARD_SHARE
from tenderlake.functions.columns import ratio
from tenderlake.operators.joins import splittable
from tenderlake.storage import materialize

_POSITION_BITS = (1 << 33) - 1


def group_total(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """The group's sum on every row: grouped first, joined back.

    A window would bring each group into one task; this sends only partial sums, and AQE
    splits a hot group's rows in the join. Null keys get no total.
    """
    totals = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias(name))
    return df.join(splittable(totals, keys), list(keys), "left")


def running_total(df: DataFrame, keys: Sequence[str], order: str, value: Column | str) -> Column:
    """Cumulative sum; for tables that hold one row per key and `order` value."""
    frame = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return F.sum(value).over(frame)


def forward_fill(column: str, keys: Sequence[str], order: str, default=0.0) -> Column:
    """Last known value up to the row, `default` before the first one."""
    frame = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return F.coalesce(F.last(column, ignorenulls=True).over(frame), F.lit(default))


def as_of(events: DataFrame, questions: DataFrame, keys: Sequence[str], order: str, value: str, default=0.0) -> DataFrame:
    """The last known value of `events` at every event and every question, `default` before the first.

    Both have at most one row per key and `order` value; they are stacked and read once in order, so the
    rows follow what is known and asked, however far apart the days are. A null event keeps what was known.
    """
    columns = [*keys, order]
    asked = questions.select(*columns, F.lit(None).cast(events.schema[value].dataType).alias(value))
    rows = events.select(*columns, value).unionByName(asked).groupBy(*columns).agg(F.max(value).alias(value))
    return rows.withColumn(value, forward_fill(value, keys, order, default))


def capacity_share(daily: DataFrame, keys: Sequence[str], date: str, quantity: str, factor: float) -> DataFrame:
    """Cumulative share of each group's total quantity by date; one row per group and day."""
    whole = Window.partitionBy(*keys)
    share = ratio(F.col(quantity), F.sum(quantity).over(whole)) / F.lit(factor)
    shared = daily.withColumn("_share", share)
    filled = running_total(shared, keys, date, "_share")
    # A day without its own share stays missing, as a skipped entry of the running sum.
    return shared.withColumn("fill_rate", F.when(F.col("_share").isNotNull(), filled)).drop("_share")


def rank_by(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Exact 0-based position in a total order, for any table size.

    Rows are range-partitioned and sorted once into a written table; a row's position is its
    place in its partition plus the counts of the partitions before it. Only those counts
    (one row per partition) are broadcast.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "*",
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS)).alias("_place"),
    )
    placed = materialize(placed, "ranked")
    counts = placed.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_place"))
        .drop("_part", "_place", "_start")
    )


def band_by_rank(
    df: DataFrame, score: str, key: str, scored_rows: int, name: str,
    share: float = SCORECARD_SHARE, cuts: Sequence[float] = BAND_CUTS, labels: Sequence[str] = BAND_LABELS,
) -> DataFrame:
    """Label rows by their position when sorted by score (descending, then key).

    With N = round(share * scored_rows), rows before N*cut get that cut's label, the last cut
    includes its own position, all others get the last label. `df` must be a written table.
    The rows at the cuts are found by counting (see `_rows_at`); labelling is then a comparison with
    them, without a join, a sort or a window.
    """
    return df.withColumn(name, band_label(df, score, key, scored_rows, share, cuts, labels))


def band_label(
    df: DataFrame, score: str, key: str, scored_rows: int,
    share: float = SCORECARD_SHARE, cuts: Sequence[float] = BAND_CUTS, labels: Sequence[str] = BAND_LABELS,
) -> Column:
    """The label of `band_by_rank` as an expression of score and key, with the cuts of `df`."""
    wanted = round(scored_rows * share)
    ends = [int(wanted * c) for c in cuts]
    ends[-1] += 1
    edges, rows = _rows_at(df, score, key, [e - 1 for e in ends if e > 0])
    label = F.lit(labels[-1])
    for end, text in reversed(list(zip(ends, labels))):
        if end <= 0:
            continue
        edge = edges.get(end - 1)
        if edge is None and end <= rows:
            raise RuntimeError(f"no row at position {end - 1} of {rows}")
        if edge is None:
            # Fewer rows than the cut: it takes all of them.
            label = F.when(F.col(score).isNotNull(), text).otherwise(label)
            continue
        before = (F.col(score) > edge[score]) | ((F.col(score) == edge[score]) & (F.col(key) <= edge[key]))
        label = F.when(before, text).otherwise(label)
    return label


# Values of one pass of a selection are counted in so many classes; so few rows are looked at one by one.
_CLASSES, _FEW = 1024, 4096
# Bytes of a text key that are one number, and bits of a whole number that are: both are exact as doubles.
_CHUNK, _HALF = 6, 32


def _digits(df: DataFrame, score: str, key: str) -> list[Column]:
    """Numbers that order rows by descending score, then by key: the negative score, then the key in pieces."""
    held = F.col(key)
    if df.schema[key].dataType.typeName() != "string":
        number = F.coalesce(held.cast("long"), F.lit(-(1 << 63)).cast("long"))
        pieces = [F.shiftright(number, _HALF), number.bitwiseAND(F.lit((1 << _HALF) - 1))]
        return [-F.col(score).cast("double"), *[p.cast("double") for p in pieces]]
    longest = df.agg(F.max(F.octet_length(key))).first()[0] or 0
    data = F.coalesce(held, F.lit("")).cast("binary")
    parts = [F.substring(data, 1 + at, _CHUNK) for at in range(0, longest, _CHUNK)]
    pieces = [F.conv(F.rpad(F.hex(p), 2 * _CHUNK, "0"), 16, 10) for p in parts]
    return [-F.col(score).cast("double"), *[p.cast("double") for p in pieces]]


@dataclass
class _Search:
    """One position on its way: digits found, the range of the next one, and where it lies among its rows."""

    place: int
    found: list[float]
    low: float
    high: float
    rows: int

    def holds(self, digits: Sequence[Column]) -> Column:
        """Whether a row is among those left; all of them agree once no digit is."""
        known = [d == value for d, value in zip(digits, self.found)]
        own = [d.between(self.low, self.high) for d in digits[len(self.found):][:1]]
        return reduce(lambda a, b: a & b, [*known, *own])


def _rows_at(df: DataFrame, score: str, key: str, positions: list[int]) -> tuple[dict, int]:
    """The rows at the given positions by descending score and key, and the number of scored rows.

    Selection by counting: a pass counts the rows around each position in classes of the next digit,
    with the least and highest value of each class, and goes on in the class that holds the position.
    No row is moved or sorted, whatever the ties; a class of few rows is fetched at last.
    """
    scores = df.where(F.col(score).isNotNull()).select(score, key)
    digits = _digits(scores, score, key)
    low, high, rows = scores.agg(F.min(digits[0]), F.max(digits[0]), F.count("*")).first()
    wanted = {p: _Search(p, [], low, high, rows) for p in positions if p < rows}
    while open_ := {p: s for p, s in wanted.items() if s.rows > _FEW and len(s.found) < len(digits)}:
        for s in open_.values():
            if s.low == s.high:
                s.found.append(s.low)
                s.low, s.high = -float(1 << _HALF), float(1 << 8 * _CHUNK)
        _narrow(scores, digits, {p: s for p, s in open_.items() if len(s.found) < len(digits)})
    return _fetched(scores, score, key, digits, wanted), rows


def _narrow(scores: DataFrame, digits: Sequence[Column], searches: dict[int, _Search]) -> None:
    """One pass: each search goes on in the class of its digit that holds its position."""
    if not searches:
        return
    entries = []
    for p, s in searches.items():
        value = digits[len(s.found)]
        # Differences, quotients and products keep the order of the values.
        place = F.floor((value - F.lit(s.low)) / F.lit(s.high - s.low) * F.lit(float(_CLASSES)))
        entry = F.struct(F.lit(p).alias("p"), place.cast("int").alias("class"), value.alias("value"))
        entries.append(F.when(s.holds(digits), entry))
    counted = scores.select(F.explode(F.array_compact(F.array(*entries))).alias("x")).groupBy("x.p", "x.class").agg(
        F.count("*").alias("n"), F.min("x.value").alias("low"), F.max("x.value").alias("high")
    )
    # At most the number of classes for each position.
    by_search: dict[int, list] = {}
    for r in counted.collect():
        by_search.setdefault(r["p"], []).append(r)
    for p, classes in by_search.items():
        s = searches[p]
        for r in sorted(classes, key=lambda r: r["class"]):
            if s.place < r["n"]:
                s.low, s.high, s.rows = r["low"], r["high"], r["n"]
                break
            s.place -= r["n"]


def _fetched(scores: DataFrame, score: str, key: str, digits: Sequence[Column], searches: dict[int, _Search]) -> dict:
    """The row of each search out of the few it has left; rows that agree in score and key are one."""
    if not searches:
        return {}
    marks = [F.when(s.holds(digits), F.lit(p)) for p, s in searches.items()]
    rows = scores.select(score, key, F.explode(F.array_compact(F.array(*marks))).alias("p"))
    counted = rows.groupBy("p", score, key).agg(F.count("*").alias("n")).collect()
    found = {}
    for p, s in searches.items():
        place = s.place
        own = [r for r in counted if r["p"] == p]
        for r in sorted(own, key=lambda r: (-r[score], r[key] is not None, r[key].encode() if isinstance(r[key], str) else r[key])):
            if place < r["n"]:
                found[p] = r
                break
            place -= r["n"]
    return found


def win_probability(predictions: DataFrame, price: str = "price") -> DataFrame:
    """Per key, prices from high to low against the share of trees at or above them.

    A key holds one row per tree, so a window partition is as large as the model, not the data.
    """
    ordered = Window.partitionBy("key").orderBy(F.col(price).desc(), F.col("tree_id"))
    return predictions.select(
        "key",
        (F.lit(100.0) * F.row_number().over(ordered) / F.count("*").over(Window.partitionBy("key"))).alias(
            "win_probability"
        ),
        F.col(price),
    )


def top_names(long: DataFrame, key: str, name: str, value: str, n: int, prefix: str) -> DataFrame:
    """Names of the n highest values per key as columns; ties go by name.

    Rows per key are as many as there are names. The n winners come from sorting one small
    array per key, built by a partial aggregation.
    """
    pair = F.struct((-F.col(value)).alias("v"), F.col(name).alias("n"))
    ordered = F.sort_array(F.collect_list(pair))
    ranked = long.groupBy(key).agg(ordered.alias("_top"))
    picks = [F.get(F.col("_top"), F.lit(i)).getField("n").alias(f"{prefix}{i + 1}") for i in range(n)]
    return ranked.select(key, *picks)


def top_columns(wide: DataFrame, key: str, n: int, prefix: str) -> DataFrame:
    """As `top_names`, for rows that hold a key's values in a column per name: no shuffle."""
    names = [c for c in wide.columns if c != key]
    pairs = F.array(*[F.struct((-F.col(f"`{c}`")).alias("v"), F.lit(c).alias("n")) for c in names])
    ranked = wide.select(key, F.sort_array(pairs).alias("_top"))
    picks = [F.get(F.col("_top"), F.lit(i)).getField("n").alias(f"{prefix}{i + 1}") for i in range(n)]
    return ranked.select(key, *picks)
