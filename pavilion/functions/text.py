"""Text parsing for scraped career tables."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pavilion.functions.numbers import safe_int

# Fixed patterns: trailing bracketed tag, year span, numbered JSON file.
# (?U) makes \s cover no-break spaces, which scraped names contain.
TAG_PATTERN = r"(?U)\s*\(([^)]+)\)\s*$"
SPAN_PATTERN = r"^\d{4}-\d{4}$"
FILE_KEY_PATTERN = r"(\d+)\.json"


def strip_space(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def clean_name(text: Column) -> Column:
    """Player name without its tag, trimmed and lower-case."""
    return F.lower(strip_space(F.regexp_replace(text.cast("string"), TAG_PATTERN, "")))


def name_tag(text: Column) -> Column:
    """Lower-case text of the trailing bracket, or null."""
    found = F.regexp_extract(text.cast("string"), TAG_PATTERN, 1)
    return F.lower(F.when(found != "", found))


def span_years(text: Column) -> tuple[Column, Column]:
    """Start and end year of ``YYYY-YYYY``; both null for anything else."""
    span = F.when(text.cast("string").rlike(SPAN_PATTERN), text.cast("string"))
    return F.substring(span, 1, 4).try_cast("bigint"), F.substring(span, 6, 4).try_cast("bigint")


def has_mark(text: Column, mark: str) -> Column:
    """Whether the text ends in the mark; false for null."""
    return F.coalesce(text.cast("string").endswith(mark), F.lit(False))


def without_mark(text: Column, mark: str) -> Column:
    return F.rtrim(text.cast("string"), F.lit(mark))


def marked_number(text: Column, mark: str) -> tuple[Column, Column]:
    """Number with an optional trailing mark, and whether the mark was there."""
    return safe_int(without_mark(text, mark)), has_mark(text, mark)


def file_key(path: Column) -> Column:
    """Digits of a ``<digits>.json`` path, or an empty string."""
    return F.regexp_extract(path, FILE_KEY_PATTERN, 1)


def contains_text(column: Column, part: str, literal: bool = False) -> Column:
    """Case-insensitive substring test.

    ``%`` and ``_`` in ``part`` act as wildcards unless ``literal`` is set.
    """
    if literal:
        return F.contains(F.lower(column), F.lower(F.lit(part)))
    return column.ilike(f"%{part}%")


def same_text(column: Column, value: str) -> Column:
    """Case-insensitive equality."""
    return F.lower(column) == F.lower(F.lit(value))
