"""Word-level text functions built from Spark SQL expressions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Blanks that separate words, and every Unicode space str.strip() removes.
WORD_BREAK = "[ \\t\\n\\r\\f]+"
EDGE_SPACE = "(?U)^\\s+|\\s+$"

# Languages written without blanks; their n-gram unit is the character.
CHARACTER_LANGUAGES = frozenset({"zh", "ja", "th"})


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` as a bound variable."""
    return F.transform(F.array(value), body)[0]


def strip(text: Column) -> Column:
    """Remove leading and trailing Unicode space (``trim`` only removes U+0020)."""
    return F.regexp_replace(text, EDGE_SPACE, "")


def words(text: Column) -> Column:
    return F.filter(F.split(text, WORD_BREAK), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.size(words(text)), F.lit(0)).cast("bigint")


def bucket(key: Column, modulus: int) -> Column:
    """A stable bucket in ``[0, modulus)`` from the first 28 bits of the key's md5."""
    digits = F.substring(F.md5(key.cast("string").cast("binary")), 1, 7)
    return F.conv(digits, 16, 10).cast("bigint") % F.lit(modulus)


def fraction(key: Column) -> Column:
    """A stable number in ``[0, 1)`` from the first 52 bits of the key's md5."""
    digits = F.substring(F.md5(key.cast("string").cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("bigint").cast("double") / F.lit(float(1 << 52))


def digest(text: Column) -> Column:
    """128-bit content digest as 16 bytes; half the shuffle width of the hex form."""
    return F.unhex(F.md5(text.cast("binary")))
