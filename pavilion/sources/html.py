"""Tables in scraped HTML pages, found by the columns they must have.

Everything is a row-local expression: a page is parsed where it lies, without
shuffle and without Python. Headers of all tables are read, cells of the chosen one only.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame, functions as F

from pavilion.functions.text import strip_space
from pavilion.operators.columns import computed_once

SIGNATURE = ("player", "runs")  # fixed default: header texts that mark a career table

# Named character references of HTML 4, from the standard library; the ampersand comes last.
_NAMED = {name: chr(point) for name, point in name2codepoint.items() if name != "amp"}
# The largest spans that HTML allows.
_COLSPAN_MAX, _ROWSPAN_MAX = 1000, 65534
_CELL = "array<struct<text: string, below: int>>"


class SchemaDriftError(Exception):
    """A page lacks the expected table."""


def _each(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def _element(tag: str, ends_at: str) -> str:
    """Content of ``tag``, which its end tag, the next ``ends_at`` or the end of text closes."""
    return rf"(?is)<{tag}\b[^>]*>(.*?)(?=</{tag}\s*>|<{ends_at}\b|\z)"


def _character(point: Column) -> Column:
    """The character with a Unicode number, null outside the range."""

    def utf16(number: Column) -> Column:
        return F.lpad(F.hex(number), 4, "0")

    beyond = point - 0x10000
    units = F.when(point < 0x10000, utf16(point)).otherwise(
        F.concat(utf16(F.shiftright(beyond, 10) + 0xD800), utf16(beyond.bitwiseAND(F.lit(0x3FF)) + 0xDC00))
    )
    surrogate = point.between(0xD800, 0xDFFF)
    return F.when((point > 0) & (point <= 0x10FFFF) & ~surrogate, F.decode(F.unhex(units), "UTF-16BE"))


def _replaced(text: Column, pattern: str, prefix: str, character: Callable[[Column], Column]) -> Column:
    """Each reference ``prefix...;`` that ``pattern`` finds, replaced where its character is known."""
    names = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))
    return F.aggregate(
        names,
        text,
        lambda done, name: F.coalesce(F.replace(done, F.concat(F.lit(prefix), name, F.lit(";")), character(name)), done),
    )


def unescaped(text: Column) -> Column:
    """The text with its character references (named, decimal, hexadecimal) replaced."""
    named = F.create_map(*[F.lit(x) for pair in _NAMED.items() for x in pair])
    out = _replaced(text, r"&#(\d{1,7});", "&#", lambda n: _character(n.cast("int")))
    for x in ("x", "X"):
        out = _replaced(out, rf"&#{x}([0-9A-Fa-f]{{1,6}});", f"&#{x}", lambda n: _character(F.conv(n, 16, 10).cast("int")))
    out = _replaced(out, r"&([A-Za-z]{2,8}\d{0,2});", "&", lambda n: F.try_element_at(named, n))
    return F.when(F.contains(text, F.lit("&")), F.replace(out, F.lit("&amp;"), F.lit("&"))).otherwise(text)


def _cell_text(cell: Column) -> Column:
    content = F.regexp_extract(cell, r"(?is)^<[^>]*>(.*)$", 1)
    text = unescaped(F.regexp_replace(content, r"<[^>]*>", ""))
    return strip_space(F.regexp_replace(text, r"[\s\u00a0]+", " "))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _span(cell: Column, name: str, most: int) -> Column:
    written = F.regexp_extract(cell, rf"(?is)^<[^>]*\b{name}\s*=\s*[\"']?(\d{{1,5}})", 1)
    return F.least(F.greatest(F.coalesce(written.try_cast("int"), F.lit(1)), F.lit(1)), F.lit(most))


def _row_cells(row: Column) -> Column:
    """array<struct<text, below>> of a row: a cell for each column it spans, with the number of rows below it spans."""
    cells = F.regexp_extract_all(row, F.lit(_element("t[hd]", "t[hd]")), F.lit(0))

    def spread(cell: Column) -> Column:
        below = _span(cell, "rowspan", _ROWSPAN_MAX) - 1
        one = F.struct(_cell_text(cell).alias("text"), below.alias("below"))
        return F.array_repeat(one, _span(cell, "colspan", _COLSPAN_MAX))

    return F.flatten(F.transform(cells, spread))


def _texts(cells: Column) -> Column:
    return F.transform(cells, lambda c: c["text"])


def _filled(rows: Column) -> Column:
    """array<array<string>> of rows of cells, each cell repeated in the rows below that it spans.

    ``carry`` holds the cells that reach into the next row, by column. A row's own cells take the columns
    that are free; where the row has too few, the carried cells follow at its end. Cells that
    span more rows than there are make rows of their own.
    """
    start = F.struct(
        F.array().cast("array<struct<at: int, text: string, below: int>>").alias("carry"),
        F.array().cast("array<array<string>>").alias("grid"),
    )

    def placed(carry: Column, own: Column) -> Column:
        def cell(at: Column) -> Column:
            # In order: what reaches down to this column, the next own cell, what is left of the carried ones.
            down = F.get(F.filter(carry, lambda c: c["at"] == at), F.lit(0))
            place = at - F.size(F.filter(carry, lambda c: c["at"] < at))
            rest = F.get(carry, at - F.size(own))
            carried = F.coalesce(down, F.when(place >= F.size(own), rest))
            return F.when(
                carried.isNotNull(), F.struct(carried["text"].alias("text"), (carried["below"] - 1).alias("below"))
            ).otherwise(F.get(own, place))

        width = F.size(carry) + F.size(own)
        columns = F.when(width > 0, F.sequence(F.lit(0), width - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(columns, cell).cast(_CELL)

    def step(state: Column, own: Column) -> Column:
        def next_state(cells: Column) -> Column:
            at = F.transform(cells, lambda c, i: F.struct(i.alias("at"), c["text"].alias("text"), c["below"].alias("below")))
            carry = F.filter(at, lambda c: c["below"] > 0)
            return F.struct(carry.alias("carry"), F.array_append(state["grid"], _texts(cells)).alias("grid"))

        return _let(placed(state["carry"], own), next_state)

    def finish(state: Column) -> Column:
        most = F.array_max(F.transform(state["carry"], lambda c: c["below"]))
        more = F.transform(F.sequence(F.lit(1), most), lambda n: _texts(F.filter(state["carry"], lambda c: c["below"] >= n)))
        return F.when(F.size(state["carry"]) > 0, F.concat(state["grid"], more)).otherwise(state["grid"])

    return F.aggregate(rows, start, step, finish)


def _body_rows(rows: Column) -> Column:
    """array<array<string>>: the cells' texts of a table's rows, with spans filled."""
    reaching = F.exists(rows, lambda r: r.rlike(r"(?i)\browspan\b"))
    return F.when(reaching, _filled(F.transform(rows, _row_cells))).otherwise(F.transform(rows, lambda r: _texts(_row_cells(r))))


def table_contents(html: Column) -> Column:
    """array<string>: what lies within each table, in the order of the start tags.

    A depth is counted over the start and end tags, so a table ends at its own end tag. Tables inside a
    table are entries of their own, and bare text where they stand, as part of their cell.
    """
    visible = F.regexp_replace(html, r"(?is)<!--.*?-->|<script\b.*?</script\s*>", "")

    def opens(piece: Column) -> Column:
        return piece.rlike(r"(?i)^<table\b")

    def depths(pieces: Column) -> Column:
        def step(done: Column, piece: Column) -> Column:
            last = F.coalesce(F.get(done, F.size(done) - 1), F.lit(0))
            closed = F.when(piece.rlike(r"(?i)^</table"), F.greatest(last - 1, F.lit(0))).otherwise(last)
            return F.array_append(done, F.when(opens(piece), last + 1).otherwise(closed))

        return F.aggregate(pieces, F.array().cast("array<int>"), step)

    def contents(both: Column) -> Column:
        pieces, levels = both["pieces"], both["levels"]

        def content(at: Column) -> Column:
            level = F.get(levels, at)
            ends = F.array_position(F.transform(F.slice(levels, at + 2, F.size(levels)), lambda x: x < level), F.lit(True))
            length = F.when(ends > 0, ends.cast("int")).otherwise(F.size(levels) - at)
            own = F.zip_with(
                F.slice(pieces, at + 1, length),
                F.slice(levels, at + 1, length),
                lambda piece, x: F.when(x == level, piece).otherwise(F.regexp_replace(piece, r"<[^>]*>", "")),
            )
            return F.regexp_replace(F.array_join(own, ""), r"(?is)^<table\b[^>]*>", "")

        starts = F.filter(F.sequence(F.lit(0), F.size(pieces) - 1), lambda i: opens(F.get(pieces, i)))
        return F.transform(starts, content)

    pieces = F.split(visible, r"(?i)(?=<table\b|</table\s*>)")
    return _let(pieces, lambda p: _let(F.struct(p.alias("pieces"), depths(p).alias("levels")), contents))


def table_parts(html: Column) -> Column:
    """array<struct<header array<string>, body array<string>>> of a page: header texts and unread rows.

    The header is the first row in ``<thead>``, whatever its cells; without one it is the first row
    if that has ``<th>`` cells only, else empty. Further rows in ``<thead>`` and rows of ``<th>`` cells
    only are dropped. Columns that a cell spans are filled.
    """

    def is_header(row: Column) -> Column:
        return row.rlike(r"(?i)<th\b") & ~row.rlike(r"(?i)<td\b")

    def parts(content: Column) -> Column:
        top = r"(?is)<thead\b[^>]*>(.*?)(?:</thead\s*>|(?=<tbody\b)|\z)"
        head = _each(F.regexp_extract(content, top, 1), _element("tr", "tr"))
        rows = _each(F.regexp_replace(content, top, ""), _element("tr", "tr"))
        first = F.get(rows, F.lit(0))
        header = F.when(F.size(head) > 0, F.get(head, F.lit(0))).when(is_header(first), first)
        empty = F.array().cast("array<string>")
        return F.struct(
            F.coalesce(_texts(_row_cells(header)), empty).alias("header"),
            F.filter(rows, lambda r: ~is_header(r)).alias("body"),
        )

    return F.transform(table_contents(html), parts)


def parsed_tables(html: Column) -> Column:
    """array<struct<header array<string>, rows array<array<string>>>> of a page; see ``table_parts``."""
    return F.transform(table_parts(html), lambda t: F.struct(t["header"].alias("header"), _body_rows(t["body"]).alias("rows")))


def _judged(pages: DataFrame, keep: Sequence[str], html: str, signature: Sequence[str], third_table_fallback: bool) -> DataFrame:
    """``keep``, ``status``, ``n_tables``, and ``header`` and unread ``body`` of the table that is looked for."""

    def has_column(table: Column, text: str) -> Column:
        return F.exists(table["header"], lambda h: F.contains(F.lower(h), F.lit(text.lower())))

    def matches(table: Column) -> Column:
        return reduce(lambda a, b: a & b, [has_column(table, text) for text in signature])

    parsed = computed_once(table_parts(F.col(html)))
    tables = pages.select(*keep, parsed.alias("tables"))
    chosen = F.get(F.filter("tables", matches), F.lit(0))
    if third_table_fallback:
        chosen = F.coalesce(chosen, F.get("tables", F.lit(2)))
    found = tables.select(*keep, F.size("tables").alias("n_tables"), chosen.alias("chosen"))
    status = (
        F.when(F.coalesce(F.col("n_tables"), F.lit(0)) <= 0, "no_tables")
        .when(F.col("chosen").isNull(), "signature_missing")
        .otherwise("ok")
    )
    return found.select(*keep, status.alias("status"), "n_tables", "chosen.header", "chosen.body")


def find_table(
    pages: DataFrame,
    keep: Sequence[str],
    html: str = "html",
    signature: Sequence[str] = SIGNATURE,
    third_table_fallback: bool = False,
) -> DataFrame:
    """One row per page: ``keep``, ``status``, ``n_tables``, ``header`` and ``rows``.

    The table is the first whose header contains every signature text, ignoring
    case. ``status`` is ``ok``, ``no_tables`` or ``signature_missing``. With the
    fallback, a page with more than two tables yields its third one instead. Cells are
    read of that table only.
    """
    judged = _judged(pages, keep, html, signature, third_table_fallback)
    return judged.select(*keep, "status", "n_tables", "header", computed_once(_body_rows(F.col("body"))).alias("rows"))


def drift_status(
    pages: DataFrame, keep: Sequence[str], html: str = "html", signature: Sequence[str] = SIGNATURE
) -> DataFrame:
    """``keep`` and the page's status, from the headers alone."""
    return _judged(pages, keep, html, signature, False).select(*keep, "status")


def require_table(found: DataFrame) -> DataFrame:
    """The frame of ``find_table``; a page without its table fails the job that reads it."""
    message = F.concat(F.lit("schema drift detected: "), F.col("status"))
    checked = F.when(F.col("status") != "ok", F.raise_error(message)).otherwise(F.col("status"))
    return found.withColumn("status", checked)


def table_rows(found: DataFrame, keep: Sequence[str]) -> DataFrame:
    """One row per table row: ``keep``, ``header``, ``row_idx`` and ``cells``."""
    return found.where(F.col("status") == "ok").select(
        *keep, "header", F.posexplode("rows").alias("row_idx", "cells")
    )


def rows_to_columns(rows: DataFrame, keep: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Cells as text columns, by exact header name; a header the page lacks gives null."""

    def cell(name: str) -> Column:
        place = F.array_position("header", F.lit(name)).cast("int")
        return F.when(place > 0, F.get("cells", place - 1)).alias(name)

    return rows.select(*keep, *[cell(n) for n in names])


def until_first_empty(
    pages: DataFrame, source: str = "source", page: str = "page", rows: str = "rows"
) -> DataFrame:
    """Pages of each source before its first page without rows."""
    is_empty = F.coalesce(F.size(rows), F.lit(0)) <= 0
    # One row per source that has an empty page; the pages' content is not grouped.
    stops = pages.where(is_empty).groupBy(source).agg(F.min(page).alias("__stop"))
    kept = pages.join(stops, source, "left").where(
        F.col("__stop").isNull() | (F.col(page) < F.col("__stop"))
    )
    return kept.drop("__stop")


def paged_union(
    pages: DataFrame, source: str = "source", page: str = "page", rows: str = "rows"
) -> DataFrame:
    """The rows of all pages before each source's first empty page."""
    return until_first_empty(pages, source, page, rows).select(
        source, page, F.posexplode(rows).alias("row_idx", "cells")
    )


def sources_without_rows(pages: DataFrame, source: str = "source", page: str = "page") -> DataFrame:
    """Sources that have no row before their first empty page."""
    kept = until_first_empty(pages, source, page).select(source).distinct()
    return pages.select(source).distinct().join(kept, source, "left_anti")


def require_rows(pages: DataFrame, source: str = "source", page: str = "page") -> None:
    """Raise with the number of ``sources_without_rows`` and one of them, if there are any."""
    found = sources_without_rows(pages, source, page).agg(F.count(F.lit(1)).alias("n"), F.min(source).alias("first")).first()
    if found["n"]:
        raise RuntimeError(f"no rows scraped for {found['n']} sources, {found['first']!r} among them")


def union_tables(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Concatenate frames by column name; columns a frame lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames.values())
