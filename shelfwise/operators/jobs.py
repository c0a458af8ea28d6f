"""Composite jobs as plain functions of their input frames:
wide weekly fact, weekly report, review and question pipelines, price lists.
Column names are parameters or those of the frames; nothing here knows where a
frame comes from.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import scalars as S
from shelfwise.operators import backlog as BL
from shelfwise.operators import enrich as E
from shelfwise.operators import kpis as K
from shelfwise.operators import schema as P
from shelfwise.sources import files as FS


# ------------------------------------------------------------------- C3
def combine(sales: DataFrame, totals: DataFrame, classification: DataFrame, scorecard: DataFrame, stores: DataFrame,
            metrics: Sequence[str], calendar: DataFrame | None = None, dense: bool = False,
            keys: Sequence[str] = ("week", "item"), item: str = "item", store: str = "store") -> DataFrame:
    """Sales rows with the web totals of their key spread evenly, then the
    catalogue, scorecard and store columns (left joins). Keys with totals and no
    sales row give one row. ``dense`` adds a row for every calendar week and
    item without any (K7): items x weeks of the calendar, nothing else."""
    x = E.distribute_evenly(sales, totals, list(keys), list(metrics))
    if dense:
        if calendar is None:
            raise ValueError("dense needs a calendar")
        week = keys[0]
        items = x.select(item).where(F.col(item).isNotNull()).distinct()
        weeks = sorted(r[0] for r in calendar.select(week).where(F.col(week).isNotNull()).distinct().collect())
        if len(weeks) > MAX_WEEKS:
            raise ValueError(f"a calendar of {len(weeks)} weeks")
        grid = items.select(F.explode(F.array(*map(F.lit, weeks))).alias(week), item)
        seen = x.select(week, item).distinct()
        x = x.unionByName(grid.join(seen, [week, item], "left_anti"), allowMissingColumns=True)
    elif calendar is not None:
        x = x.join(calendar.select(keys[0]).distinct(), keys[0], "left_semi")
    return (x.join(classification, item, "left").join(scorecard, item, "left").join(stores, store, "left"))


#: A calendar holds at most two hundred years of weeks (they are one array literal in ``combine``).
MAX_WEEKS = 10_400


# ------------------------------------------------------------------- C4
def report_base(sales: DataFrame, classification: DataFrame, stores: DataFrame, weeks: str,
                days: tuple[_dt.datetime | str, _dt.datetime | str] | None = None, item: str = "item",
                store: str = "store", day: str = "day", week: str = "week", measure: str = "sales") -> DataFrame:
    """C4 base: positive sales with a store in the report's weeks (a pattern on
    the label), with catalogue columns (left) and store columns (inner).
    ``days`` is the same window as a half-open day range; it reaches the scan."""
    s = sales.filter((F.col(measure) > 0) & F.col(store).isNotNull() & F.col(week).rlike(weeks))
    if days:
        first, after = (F.lit(str(x)).cast("timestamp_ntz") for x in days)
        s = s.filter((F.col(day) >= first) & (F.col(day) < after))
    return s.join(classification, item, "left").join(stores, store, "inner")


def weekly_report(base: DataFrame, dims: Sequence[str], weeks_back: int = 8, top_n: int = 5, bottom_n: int = 5,
                  rate: float = 20.0, share_dims: Sequence[str] = ()) -> dict[str, DataFrame]:
    """C4: the report's tables by name: KPIs of the latest week, standouts,
    trend, groups with high return or cancel rates, shares."""
    agg = K.latest_kpis(base, dims)
    out = {
        "kpis": agg,
        "standouts": K.standouts(agg, "sales_diff", top_n, bottom_n, tie_break=dims),
        "trend": K.weekly_trend(base, weeks_back),
        "high_return": agg.filter(F.col("return_rate") > rate),
        "high_cancel": agg.filter(F.col("cancel_rate") > rate),
    }
    for d in share_dims:
        out[f"share_{d}"] = K.share_of_total(base, d, period="week")
    return out


# ------------------------------------------------------------------- C5 / C6
def reviews(raw: DataFrame, fg: DataFrame, exclude: tuple[str, str] | None = None,
            text: Sequence[str] = ("network", "product_id", "upc")) -> DataFrame:
    """Reviews without the excluded value (nulls stay), text columns
    normalised (F4), with the finished-goods columns of the code's first
    eleven characters. ``fg``: output of ``enrich.fg_grouped``."""
    r = BL.keep_unless_equal(raw, *exclude) if exclude else raw
    return BL.enrich_with_fg(r.withColumns({c: S.strip_point_zero(c) for c in text}), fg)


def questions(raw: DataFrame, fg: DataFrame, text: Sequence[str] = ("product_id", "upc")) -> DataFrame:
    """Questions with the finished-goods columns."""
    return reviews(raw, fg, None, text)


# ------------------------------------------------------------------- C10
def price_list(pages: DataFrame, id_col: str, html: str, columns: Mapping[str, str], default_label: str = "page_",
               upc: str = "upc", plus: str = "upc_plus", item: str = "item") -> DataFrame:
    """Rows of the price table of every page. ``columns``: table header ->
    output name (``files.PRICE_LIST_COLUMNS`` has all headers). Cells are
    cleaned (F2), the page's description is the Price File (S11), Full UPC is
    built (F3), rows without code and item go. The label travels with the rows,
    so nothing is joined. Pages without a table: ``files.html_missing``."""
    label = FS.html_field(F.col(html), FS.DESCRIPTION_PATTERN, F.concat(F.lit(default_label), F.col(id_col).cast("string")))
    rows = FS.html_rows(pages.withColumn("price_file", label), id_col, html, list(columns), keep=["price_file"])
    out = rows.select(id_col, "row_no", "price_file", *[S.clean_text(F.col(f"`{h}`")).alias(n) for h, n in columns.items()])
    out = out.withColumn("full_upc", S.full_upc(upc, plus))
    return P.drop_all_null(out, [upc, item])
