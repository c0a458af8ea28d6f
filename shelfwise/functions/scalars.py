"""Column -> Column scalar functions.

All are built from Spark SQL expressions, so they stay inside whole-stage
codegen; none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions.dates import to_timestamp_lenient

# Fixed values that must equal the reference's for identical results.
FISCAL_WEEK_PATTERN = r"Fiscal Week (\d+) of (\d+)"
SAFE_LABEL_BAD_CHARS = r"[\\*?:/\[\]]"     # \ * ? : / [ ]  -> _
SAFE_LABEL_MAX = 31
SAFE_LABEL_BLANK = "No_BU"
NO_DATE = "No Date"
UNKNOWN_CODE = "Unknown"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# F1 -------------------------------------------------------------------------
def week_num(week) -> Column:
    """Week number from 'Fiscal Week W of Y'; null when the text does not match."""
    return F.nullif(F.regexp_extract(_c(week).cast("string"), FISCAL_WEEK_PATTERN, 1),
                    F.lit("")).try_cast("int")


def week_year(week) -> Column:
    return F.nullif(F.regexp_extract(_c(week).cast("string"), FISCAL_WEEK_PATTERN, 2),
                    F.lit("")).try_cast("int")


def fiscal_week_label(day) -> Column:
    """Week label of a day: 7-day blocks from Jan 1 ('Fiscal Week W of Y')."""
    d = _c(day)
    wk = F.floor((F.dayofyear(d) - 1) / 7) + 1
    return F.concat(F.lit("Fiscal Week "), wk.cast("string"), F.lit(" of "),
                    F.year(d).cast("string"))


# F2 -------------------------------------------------------------------------
def clean_text(c) -> Column:
    """Strip, unwrap ="...", drop leading spaces/=/quotes and trailing
    spaces/quotes. Null stays null."""
    return F.regexp_replace(F.trim(_c(c)), r"""^[\s="']*|[\s"']*$""", "")


# F3 -------------------------------------------------------------------------
def _digits_no_lead_zero(c: Column) -> Column:
    d = F.regexp_replace(c, r"\D", "")
    return F.regexp_replace(d, r"^0+(?=\d)", "")


def full_upc(upc, plus) -> Column:
    """'0' || digits(upc) without leading zeros || digits(plus) without leading
    zeros. Both are cleaned first (F2; 'nan' counts as blank). Blank/null upc
    -> null; a part with no digits -> empty. Strings only (no float round trip)."""
    u, p = (clean_text(_c(x).cast("string")) for x in (upc, plus))
    u, p = (F.when(F.lower(x) == "nan", F.lit("")).otherwise(x) for x in (u, p))
    blank = u.isNull() | (u == "")
    return F.when(blank, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("0"), _digits_no_lead_zero(u),
                 F.coalesce(_digits_no_lead_zero(p), F.lit(""))))


# F4 -------------------------------------------------------------------------
def strip_point_zero(c) -> Column:
    """Null -> '', to string, drop a trailing '.0'. Numbers in scientific text
    (as doubles from ten million on print) are written out in full."""
    t = F.coalesce(_c(c).cast("string"), F.lit(""))
    whole = t.try_cast("decimal(38,10)").cast("string")
    out = F.when(t.rlike(r"^-?[0-9]\.[0-9]+E[0-9]+$") & whole.isNotNull(),
                 F.regexp_replace(whole, r"\.?0+$", "")).otherwise(t)
    return F.regexp_replace(out, r"\.0$", "")


# F5 -------------------------------------------------------------------------
def clean_upc_key(c) -> Column:
    """Drop leading spaces followed by a run of zeros, then every whitespace char."""
    return F.regexp_replace(F.regexp_replace(_c(c).cast("string"), r"^\s*0+", ""), r"\s+", "")


# F6 -------------------------------------------------------------------------
def prefix(c, n: int) -> Column:
    return F.substring(_c(c).cast("string"), 1, n)


# F7 / F8 --------------------------------------------------------------------
def concat_code(a, b, sep: str = "-") -> Column:
    """Null-propagating concat (Polars concat_str)."""
    return F.concat(_c(a), F.lit(sep), _c(b))


def concat_code_default(a, b, sep: str = "-", default: str = UNKNOWN_CODE) -> Column:
    """Concat where '-' or '' becomes the default label (inputs already text)."""
    v = F.concat(_c(a), F.lit(sep), _c(b))
    return F.when(v.isin(sep, ""), F.lit(default)).otherwise(v)


# F9 / F10 -------------------------------------------------------------------
def to_number(c, dtype: str = "double") -> Column:
    """Numeric coercion; unparsable -> null, and NaN text -> null."""
    v = _c(c).cast("string").try_cast(dtype)
    if dtype in ("double", "float"):
        v = F.when(F.isnan(v), F.lit(None).cast(dtype)).otherwise(v)
    return v


def whole_int(c) -> Column:
    """A numeric text/double as int only when it is a whole number in
    int range (a fractional rating would not fit an int column); else null."""
    v = to_number(c, "double")
    ok = (v == F.floor(v)) & (F.abs(v) <= F.lit(2147483647))
    return F.when(ok, v.cast("int"))


def to_timestamp_safe(c, day_first: Column | bool = False) -> Column:
    """Lenient timestamp parse (naive, timestamp_ntz), one attempt per cell;
    bad -> null. See :mod:`shelfwise.functions.dates`, which also finds a
    column's order of day and month."""
    return to_timestamp_lenient(c, day_first)


def lost_share(text, parsed) -> Column:
    """Aggregate: share of non-blank cells that did not parse."""
    some = _c(text).isNotNull() & (F.trim(_c(text).cast("string")) != "")
    return F.try_divide(F.count_if(some & _c(parsed).isNull()), F.count_if(some))


# F11 ------------------------------------------------------------------------
def date_text(c, fmt: str = "yyyy-MM-dd", missing: str = NO_DATE) -> Column:
    return F.coalesce(F.date_format(_c(c), fmt), F.lit(missing))


# F12 ------------------------------------------------------------------------
def safe_label(c) -> Column:
    """Sheet/partition-safe label: bad chars -> '_', trim, max 31, blank -> No_BU."""
    v = F.substring(F.trim(F.regexp_replace(F.coalesce(_c(c).cast("string"), F.lit("")),
                                            SAFE_LABEL_BAD_CHARS, "_")), 1, SAFE_LABEL_MAX)
    return F.when(F.trim(v) == "", F.lit(SAFE_LABEL_BLANK)).otherwise(v)


# F13 ------------------------------------------------------------------------
def strip_tags(c) -> Column:
    return F.regexp_replace(_c(c), r"<[^>]+>", "")


#: Entities decoded in table cells; the ampersand last.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&"))


def html_entities(c) -> Column:
    out = _c(c)
    for e, put in ENTITIES:
        out = F.replace(out, F.lit(e), F.lit(put))
    return out


# F15 ------------------------------------------------------------------------
def nz(c) -> Column:
    """Zero-safe denominator: 0 -> 1 (ANSI Spark raises on x/0)."""
    v = _c(c)
    return F.when(v == 0, F.lit(1)).otherwise(v)


# F18 ------------------------------------------------------------------------
def file_safe(c) -> Column:
    return F.regexp_replace(F.regexp_replace(_c(c), " ", "_"), ":", "")


# F19 ------------------------------------------------------------------------
def money_text(c) -> Column:
    return F.concat(F.lit("$"), F.format_number(_c(c), 2))
