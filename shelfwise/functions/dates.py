"""Lenient dates of exports (F10, S3): one parse attempt per cell.

A cell's shape decides how it is read. Regular expressions bring every known
form into year-month-day order with the time behind it, and one ``try_cast``
reads that; no failing parser runs in between, so bad cells cost no more than
good ones. Only the order of day and month in all-number dates cannot be seen
in a cell. It is a property of the column: :func:`day_orders` counts, in one
aggregate over all rows, the cells that each order can read, and the order that
reads more wins (month first when equal).

Forms: ISO dates and timestamps, ``2024/10/15``, ``20241015`` (with ``Thhmmss``
or ``hhmmss``), ``10/15/2024``, ``10-15-24``, ``15.10.2024``, ``15 October
2024``, ``15-Oct-24``, ``Tue, Oct 15 2024``, ``October 15th, 2024``, each with
an optional time, on a 12-hour or 24-hour clock. Two-digit years up to 68 are
of this century. Null, blank and other text is null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONTH_FIRST, DAY_FIRST = "month first", "day first"

_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_NAME = (r"(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?"
         r"|nov(?:ember)?|dec(?:ember)?)\.?")
_WEEKDAY = r"(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+)?"
_YEAR = r"([0-9]{4}|[0-9]{2})"
_REST = r"(?:(?:,\s*|\s+|T)(?=[0-9])|$)"           # before a time, or the end

ISO = r"^[0-9]{4}(?:-|$)"
LIKELY = r"^(?:[0-9]{8}|[0-9]{4}[/.-]|[0-9]{1,2}[^0-9:].*[0-9]|[A-Za-z]{3}.*[0-9])"
SLASHED = r"^([0-9]{4})[/.]([0-9]{1,2})[/.]([0-9]{1,2})" + _REST
COMPACT = r"^([0-9]{4})([0-9]{2})([0-9]{2})(?:[T ]?([0-9]{2})([0-9]{2})([0-9]{2})?)?$"
NUMBERS = r"^([0-9]{1,2})([/.-])([0-9]{1,2})\2" + _YEAR + _REST
DAY_NAME = r"(?i)^" + _WEEKDAY + r"([0-9]{1,2})(?:st|nd|rd|th)?(?:\s+|-|\.\s*|/)" + _NAME + r"(?:,?\s+|-|/)" + _YEAR + _REST
NAME_DAY = r"(?i)^" + _WEEKDAY + _NAME + r"(?:\s+|-)([0-9]{1,2})(?:st|nd|rd|th)?(?:,?\s+|-)" + _YEAR + _REST
KINDS = {"iso": ISO, "numbers": NUMBERS, "compact": COMPACT, "slashed": SLASHED, "name_day": NAME_DAY, "day_name": DAY_NAME}
CLOCK = r"(?i)(:[0-9]{2}(?:\.[0-9]{1,6})?|\s[0-9]{1,2})\s*([ap])\.?m\.?$"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _trimmed(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(c.cast("string"))


def _kind(t: Column) -> Column:
    """The family of forms of a cell; a cell fits one at most, null: none."""
    (first, form), *more = KINDS.items()
    out = F.when(t.rlike(form), first)
    for kind, form in more:
        out = out.when(t.rlike(form), kind)
    return out


def _bare(t: Column) -> Column:
    """The cell without the AM or PM of a 12-hour time; other than the cell only if there is one."""
    return F.when(t.contains("m") | t.contains("M"), F.regexp_replace(t, CLOCK, "$1")).otherwise(t)


def _ordered(t: Column, kind: Column, bare: Column, first: Column) -> Column:
    """A cell in year-month-day order, the time behind it."""
    compact = F.regexp_replace(F.regexp_replace(F.regexp_replace(bare, COMPACT, "$1-$2-$3 $4:$5:$6"), r"\s?::$", ""), ":$", "")
    name = F.when(kind == "name_day", F.regexp_extract(bare, NAME_DAY, 1)).otherwise(F.regexp_extract(bare, DAY_NAME, 2))
    number = ((F.position(F.lower(F.substring(name, 1, 3)), F.lit(_MONTHS)) + 2) / 3).cast("int").cast("string")
    named = F.when(kind == "name_day", F.regexp_replace(bare, NAME_DAY, "$3-$1-$2 ")).otherwise(F.regexp_replace(bare, DAY_NAME, "$3-$2-$1 "))
    return (F.when(kind == "iso", bare)
            .when(kind == "numbers", F.regexp_replace(bare, F.lit(NUMBERS), F.when(first, "$4-$3-$1 ").otherwise("$4-$1-$3 ")))
            .when(kind == "compact", compact)
            .when(kind == "slashed", F.regexp_replace(bare, SLASHED, "$1-$2-$3 "))
            .when(t.rlike(LIKELY), F.regexp_replace(named, F.lit(r"-[A-Za-z.]+-"), F.concat(F.lit("-"), number, F.lit("-")))))


def _cast(ymd: Column) -> Column:
    """Timestamp of a cell in order, the century put before a year of two digits."""
    year = F.substring(ymd, 1, 2)
    return (F.when(F.substring(ymd, 3, 1) != "-", ymd).when(year <= "68", F.concat(F.lit("20"), ymd))
            .otherwise(F.concat(F.lit("19"), ymd))).try_cast("timestamp_ntz")


def _clocked(t: Column, bare: Column, at: Column) -> Column:
    """The timestamp with a 12-hour time, whose hour must be 1 to 12, moved to its half of the day."""
    pm = F.lower(F.regexp_extract(t, CLOCK, 2)) == "p"
    hours = F.when(pm, 12).otherwise(0) - F.when(F.hour(at) == 12, 12).otherwise(0)
    return F.when(bare == t, at).when(F.hour(at).between(1, 12), at + F.make_dt_interval(hours=hours))


def to_timestamp_lenient(c, day_first: Column | bool = False) -> Column:
    """Timestamp (naive) of a text cell; ``day_first`` may be a column, as
    :func:`with_dates` makes it."""
    first = day_first if isinstance(day_first, Column) else F.lit(day_first)

    def parsed(t: Column, kind: Column, bare: Column) -> Column:
        return _let(_let(_ordered(t, kind, bare, first), _cast), lambda at: _clocked(t, bare, at))

    # ISO cells are read outright (that cast does not throw)
    text = _trimmed(c)
    other = _let(text, lambda t: _let(_kind(t), lambda kind: F.when(kind.isNotNull(), _let(_bare(t), lambda bare: parsed(t, kind, bare)))))
    return F.coalesce(F.when(text.rlike(ISO), text.try_cast("timestamp_ntz")), other)


def _steps(df: DataFrame, *steps: dict) -> DataFrame:
    """Columns added in steps: what a step makes is computed once, however often the next one uses it."""
    for step in steps:
        df = df.withColumns(step)
    return df


def _readable(t: Column) -> tuple[Column, Column]:
    """Whether an all-number date can be read month first, and day first."""
    month, day = "(?:0?[1-9]|1[0-2])", "(?:0?[1-9]|[12][0-9]|3[01])"
    return tuple(t.rlike(f"^{a}([/.-]){b}\\1{_YEAR}{_REST}") for a, b in ((month, day), (day, month)))


def day_orders(df: DataFrame, columns: Sequence[str], by: str | None = None) -> DataFrame:
    """Per column, whether its all-number dates are read day first: one row, or one a value of ``by``."""
    def more(c):
        month, day = _readable(_trimmed(F.col(f"`{c}`")))
        return (F.count_if(day) > F.count_if(month)).alias(c)
    return df.groupBy(*([by] if by else [])).agg(*[more(c) for c in columns])


def with_dates(df: DataFrame, columns: Sequence[str], by: str | None = None) -> DataFrame:
    """``df`` with text columns parsed, each in the order that reads more of its
    cells; with ``by`` (a file name, say) the order is found for each value of
    it. The orders are an aggregate of the same frame, joined to every row;
    nothing runs while the frame is built."""
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    if by is None:
        out = df.crossJoin(F.broadcast(day_orders(df, columns).select(F.struct("*").alias("_day_first"))))
    else:
        orders = day_orders(df, columns, by).select(F.col(by).alias("_by"), F.struct(*[f"`{c}`" for c in columns]).alias("_day_first"))
        out = df.join(orders, F.col(by).eqNullSafe(F.col("_by")))
    parsed = {c: to_timestamp_lenient(F.col(f"`{c}`"), F.col("_day_first").getField(c)) for c in columns}
    return out.withColumns(parsed).select(*[F.col(f"`{c}`") for c in df.columns])


def _read(df: DataFrame, first: Column) -> DataFrame:
    """Adds ``_at``, the timestamp of ``_text`` with its ``_kind``: what :func:`to_timestamp_lenient`
    does, in steps that are compiled, where its lambdas are interpreted. One column a
    frame: several would make a method that the JVM no longer compiles."""
    text, kind, bare, read = (F.col(c) for c in ("_text", "_kind", "_bare", "_read"))
    return _steps(df, {"_bare": F.when(kind.isNotNull(), _bare(text))}, {"_ymd": _ordered(text, kind, bare, first)},
                  {"_read": _cast(F.col("_ymd"))}, {"_at": _clocked(text, bare, read)})


def date_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: cells, blank cells, the order of its all-number dates,
    cells of each family of forms, cells that no form or no calendar day fits.

    A cell is read once. An order loses the all-number dates that it cannot
    read; where both can, day and month are at most 12 and only the time
    decides, which is the same in either order."""
    texts = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), _trimmed(F.col(f"`{c}`")).alias("t")) for c in columns])).alias("x")
    text, kind, at = F.col("_text"), F.col("_kind"), F.col("_at")
    month, day = (F.when(kind == "numbers", x) for x in _readable(text))
    cells = _steps(df.select(texts).select("x.column", F.col("x.t").alias("_text")), {"_kind": _kind(text)}, {"_month": month, "_day": day})
    cells = _read(cells, ~F.col("_month"))
    some, numbers = text.isNotNull() & (text != ""), F.coalesce(kind == "numbers", F.lit(False))
    forms = {"iso": ["iso"], "numbers": ["numbers"], "compact": ["compact"], "slashed": ["slashed"], "named": ["name_day", "day_name"]}
    sums = [F.count(F.lit(1)).alias("cells"), F.count_if(~some).alias("blank"), F.count_if("_month").alias("_month"), F.count_if("_day").alias("_day"),
            F.count_if(some & (at.isNull() | (numbers & ~F.col("_month")))).alias("_lost_m"),
            F.count_if(some & (at.isNull() | (numbers & ~F.col("_day")))).alias("_lost_d"),
            *[F.count_if(kind.isin(kinds)).alias(n) for n, kinds in forms.items()]]
    out = cells.groupBy("column").agg(*sums)
    first = F.col("_day") > F.col("_month")
    return out.select("column", "cells", "blank", F.when(first, DAY_FIRST).otherwise(MONTH_FIRST).alias("day_order"), *forms,
                      F.when(first, F.col("_lost_d")).otherwise(F.col("_lost_m")).alias("lost"))
