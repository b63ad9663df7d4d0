"""Text-to-number casts that turn junk into null instead of failing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed pattern: what counts as a number. The JVM alone would also read ``12d`` and hexadecimal.
_NUMBER = r"(?i)^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|inf(?:inity)?)\s*$"


def safe_double(value: Column) -> Column:
    """Double value of a text or number; infinities pass, NaN and junk become null.

    Junk is sorted out before the cast, because a failing ``try_cast`` raises and
    catches an exception for every row.
    """
    text = value.cast("string")
    return F.when(text.rlike(_NUMBER), text).try_cast("double")


def whole(number: Column) -> Column:
    """Long value of a double without fraction, else null; infinity has no remainder and drops out."""
    return F.when(number % 1 == 0, number).try_cast("bigint")


def number_text(value: Column) -> Column:
    """The text of a number, null for NaN and junk."""
    text = value.cast("string")
    return F.when(text.rlike(_NUMBER), F.btrim(text))


def exact_int(text: Column) -> Column:
    """Whole number of a ``number_text``; digits are read exactly, other spellings as doubles."""
    digits = F.when(text.rlike(r"^[+-]?\d{1,19}$"), text).try_cast("bigint")
    return F.coalesce(digits, whole(text.try_cast("double")))


def safe_int(value: Column) -> Column:
    """Whole number of a text or number (``452.0`` is 452); fractions and junk become null.

    Integers are exact over the whole range of a long.
    """
    return exact_int(number_text(value))
