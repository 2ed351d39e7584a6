"""Column expressions whose null, division and rounding rules differ from Spark's defaults."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def differs_from(column: str, value) -> Column:
    """True where the column is another value or null (plain != would drop the nulls)."""
    return ~F.col(column).eqNullSafe(F.lit(value))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division that is null, not an error, for a zero denominator."""
    return F.try_divide(_col(numerator), _col(denominator))


def finite(column: Column | str) -> Column:
    """Null in place of NaN and both infinities."""
    c = _col(column).cast("double")
    bad = F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    return F.when(~bad, c)


def non_negative(column: Column | str) -> Column:
    c = _col(column)
    return F.when(c < 0, F.lit(0.0)).otherwise(c)


def bid_key(fiscal: Column | str = "fiscal", shift: int = 0) -> Column:
    """fiscal_destination_line; null if any part is. `shift` moves the fiscal year."""
    year = _col(fiscal) + shift if shift else _col(fiscal)
    return F.concat(
        year.cast("int").cast("string"), F.lit("_"),
        F.col("destination_no").cast("string"), F.lit("_"),
        F.col("bid_line_no").cast("string"),
    )


def key_parts(key: Column | str = "key") -> list[Column]:
    """fiscal, destination and bidlineno out of a bid key."""
    parts = F.split(_col(key), "_")
    return [
        parts[0].try_cast("int").alias("fiscal"),
        parts[1].alias("destination"),
        parts[2].try_cast("int").alias("bidlineno"),
    ]


def split_once(column: Column | str, first: str, rest: str) -> list[Column]:
    """Split at the first underscore only."""
    parts = F.split(_col(column), "_", 2)
    return [parts[0].alias(first), F.get(parts, F.lit(1)).alias(rest)]


def starts_with_word(column: Column | str, word: str) -> Column:
    """Case-insensitive match anchored at the start; null stays null."""
    return F.lower(_col(column)).startswith(word)


def mentions(column: Column | str, text: str) -> Column:
    """Case-insensitive literal substring test."""
    return F.lower(_col(column)).contains(text.lower())


def lenient_int(column: Column | str) -> Column:
    """Text to int: null on bad input, decimals cut off."""
    number = finite(_col(column).try_cast("double"))
    return F.when(number >= 0, F.floor(number)).otherwise(F.ceil(number)).try_cast("int")


def lenient_double(column: Column | str) -> Column:
    """Text to double: null, never NaN, on bad input."""
    number = _col(column).try_cast("double")
    return F.when(~F.isnan(number), number)


def day_month_year(column: Column | str, formats: Sequence[str]) -> Column:
    """Timestamp text, day first, to date; dashes and dots separate like slashes."""
    text = F.regexp_replace(F.trim(_col(column)), "[-.]", "/")
    return F.to_date(F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats]))


def yes_no(column: Column | str) -> Column:
    """Y is true, other text false, null stays null."""
    return _col(column) == F.lit("Y")


def plain_e(column: Column | str) -> Column:
    """Accented e to e everywhere; the replacement character only at its first place."""
    accents = F.translate(_col(column), "éè", "ee")
    return F.regexp_replace(accents, "^([^�]*)�", "$1e")


def cents(column: Column | str) -> Column:
    """Two decimals, half to even, after float noise beyond the sixth decimal is cut off."""
    return F.bround(_col(column).cast("decimal(24,6)"), 2).cast("double")


def percent_number(column: Column | str) -> Column:
    """'12.5%' to 12.5."""
    return F.replace(_col(column), F.lit("%"), F.lit("")).try_cast("double")


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column
