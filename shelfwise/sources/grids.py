"""HTML tables as grids of cells (S10), with array functions only.

Tables are taken from a text in document order, nested ones too: the innermost
tables go first, each leaving its plain text in the cell around it, until none
is left. Cells with ``colspan`` and ``rowspan`` fill every place they cover, so
a value stands in the column whose header it belongs to. Closing tags of rows
and cells may be missing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions import scalars as S

#: The greatest spans that HTML allows; a row span of 0 reaches to the end.
MOST_COLUMNS, MOST_ROWS = 1000, 65534

_TABLE = r"(?is)<table\b(?:(?!<table\b).)*?</table\s*>"
_ROW = r"(?is)<tr\b[^>]*>(.*?)(?=</tr\s*>|<tr\b|</table|\z)"
_CELL = r"(?is)<t[dh]\b([^>]*)>(.*?)(?=</t[dh]\s*>|<t[dh]\b|\z)"
_LINES = "array<array<string>>"


def text_of(html: Column) -> Column:
    return F.trim(S.html_entities(S.strip_tags(html)))


def tables(html: Column) -> Column:
    """Array of the tables of a text, in document order; each with the tables
    inside it replaced by their text."""
    parts = F.split(html, r"(?i)<table\b")
    numbered = F.array_join(F.transform(parts, lambda x, i: F.when(i == 0, x).otherwise(
        F.concat(F.lit('<table data-place="'), i.cast("string"), F.lit('"'), x))), "")

    def step(s, _):
        found = F.regexp_extract_all(s["html"], F.lit(f"({_TABLE})"), F.lit(1))
        between = F.split(s["html"], _TABLE)
        rest = F.array_join(F.zip_with(between, found, lambda a, t: F.concat(a, F.coalesce(S.strip_tags(t), F.lit("")))), "")
        return F.when(s["open"], F.struct(rest.alias("html"), F.concat(s["found"], found).alias("found"),
                                          (F.size(found) > 0).alias("open"))).otherwise(s)

    start = F.struct(F.coalesce(numbered, F.lit("")).alias("html"), F.array().cast("array<string>").alias("found"), F.lit(True).alias("open"))
    rounds = F.sequence(F.lit(1), F.greatest(F.size(parts), F.lit(1)))
    every = F.aggregate(rounds, start, step, lambda s: s["found"])
    place = lambda t: F.regexp_extract(t, 'data-place="([0-9]+)"', 1).cast("int")
    return F.transform(F.array_sort(F.transform(every, lambda t: F.struct(place(t).alias("n"), t.alias("t")))), lambda x: x["t"])


def cells(table: Column) -> Column:
    """Array of rows, each an array of (text, columns, rows) of its cells as written."""
    def span(attributes: Column, name: str, most: int) -> Column:
        n = F.regexp_extract(attributes, rf"(?i)\b{name}\s*=\s*[\"']?\s*([0-9]+)", 1).try_cast("int")
        whole = F.lit(most) if name == "rowspan" else F.lit(1)
        wide = F.least(F.when(n == 0, whole).otherwise(F.coalesce(n, F.lit(1))), F.lit(most))
        # most cells have no span: no pattern to try, and no failing cast, which costs an exception
        return F.when(F.contains(F.lower(attributes), F.lit("span")), wide).otherwise(F.lit(1))

    def row(tr: Column) -> Column:
        attributes = F.regexp_extract_all(tr, F.lit(_CELL), F.lit(1))
        inner = F.regexp_extract_all(tr, F.lit(_CELL), F.lit(2))
        return F.zip_with(attributes, inner, lambda a, x: F.struct(
            text_of(x).alias("text"), span(a, "colspan", MOST_COLUMNS).alias("columns"), span(a, "rowspan", MOST_ROWS).alias("rows")))
    return F.transform(F.regexp_extract_all(table, F.lit(_ROW), F.lit(1)), row)


def grid(rows: Column) -> Column:
    """Array of rows, each an array of texts by column, from rows of
    :func:`cells`. The state is the columns that cells of earlier rows still cover;
    a table without spans needs none."""
    none = F.array().cast("array<struct<text:string,left:int>>")

    def covered(carry: Column, i: Column) -> Column:
        return F.coalesce(F.get(carry, i)["left"], F.lit(0)) > 0

    def line(carry: Column, row: Column) -> Column:
        """(line, spans): the row's texts by column, and what reaches below it."""
        def put(s, c):
            at = F.size(s["line"])
            free = F.array_min(F.filter(F.sequence(at, F.greatest(F.size(carry), at)), lambda i: ~covered(carry, i)))
            before = F.transform(F.slice(carry, at + 1, free - at), lambda x: x["text"])
            below = F.transform(F.sequence(free, free + c["columns"] - 1), lambda i: F.struct(
                i.alias("column"), c["text"].alias("text"), (c["rows"] - 1).alias("left")))
            return F.struct(F.concat(s["line"], before, F.array_repeat(c["text"], c["columns"])).alias("line"),
                            F.when(c["rows"] > 1, F.concat(s["spans"], below)).otherwise(s["spans"]).alias("spans"))
        start = F.struct(F.array().cast("array<string>").alias("line"),
                         F.array().cast("array<struct<column:int,text:string,left:int>>").alias("spans"))

        def end(s):
            last = F.coalesce(F.array_max(F.transform(carry, lambda x, i: F.when(x["left"] > 0, i + 1))), F.lit(0))
            rest = F.slice(carry, F.size(s["line"]) + 1, F.greatest(last - F.size(s["line"]), F.lit(0)))
            return F.struct(F.concat(s["line"], F.transform(rest, lambda x: F.when(x["left"] > 0, x["text"]).otherwise(F.lit("")))).alias("line"),
                            s["spans"].alias("spans"))
        return F.aggregate(row, start, put, end)

    def step(s, row):
        def joined(x):
            width = F.greatest(F.size(x["line"]), F.size(s["carry"]))

            def below(i):
                own = F.get(F.filter(x["spans"], lambda y: y["column"] == i), F.lit(0))
                old = F.get(s["carry"], i)
                return F.struct(F.coalesce(own["text"], old["text"], F.lit("")).alias("text"),
                                F.coalesce(own["left"], old["left"] - 1, F.lit(0)).alias("left"))
            more = (F.size(x["spans"]) > 0) | F.exists(s["carry"], lambda y: y["left"] > 1)
            carry = F.when(more & (width > 0), F.transform(F.sequence(F.lit(0), F.greatest(width - 1, F.lit(0))), below)).otherwise(none)
            return F.struct(F.concat(s["grid"], F.array(x["line"])).alias("grid"), carry.alias("carry"))
        # the row is laid out once, and used twice
        return F.get(F.transform(F.array(line(s["carry"], row)), joined), F.lit(0))

    start = F.struct(F.array().cast(_LINES).alias("grid"), none.alias("carry"))

    def laid_out(rows):
        spans = F.exists(rows, lambda row: F.exists(row, lambda c: (c["columns"] > 1) | (c["rows"] > 1)))
        return F.when(spans, F.aggregate(rows, start, step, lambda s: s["grid"])).otherwise(
            F.transform(rows, lambda row: F.transform(row, lambda c: c["text"])))
    return F.get(F.transform(F.array(rows), laid_out), F.lit(0))


def header_names(header: Column) -> Column:
    """Names of the columns: blank ones by place, repeated ones numbered."""
    named = F.transform(header, lambda h, i: F.when(h == "", F.concat(F.lit("Unnamed: "), i.cast("string"))).otherwise(h))

    def number(h, i):
        before = F.size(F.filter(F.slice(named, F.lit(1), i), lambda x: x == h))
        return F.when(before > 0, F.concat(h, F.lit("."), before.cast("string"))).otherwise(h)
    return F.transform(named, number)
