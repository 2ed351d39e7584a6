"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: what counts as a word in the scans.
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same words in UTF-8: every byte of a character beyond ASCII is 0x80 or more.
WORD_BYTES = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lowered(text: Column) -> Column:
    """The text in lower case; null counts as empty.

    The two other letters whose lower case has an ASCII letter (the Kelvin sign and the dotted I) become
    a dotless i first, so that ASCII words come out as if only A to Z had been lowered.
    """
    other = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u0131")), F.lit("\u0130"), F.lit("\u0131"))
    return F.lower(other)


def utf8(text: str) -> Column:
    """The text as UTF-8 bytes, null as none; Python tasks work on bytes without decoding them."""
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def words(text: bytes) -> list[bytes]:
    """Words of a text with ASCII letters in lower case (bytes.lower leaves other letters alone)."""
    return WORD_BYTES.findall(text.lower())


def column(name: str) -> str:
    """A name quoted for use in expressions."""
    return "`" + name.replace("`", "``") + "`"


def orderable(rows: DataFrame) -> list[str]:
    """Columns whose values Spark can sort; maps and variants it cannot."""
    return [n for n, kind in rows.dtypes if "map<" not in kind and "variant" not in kind]
