"""Weekly sales KPIs.

Every function is DataFrame -> DataFrame. Global totals are one-row
aggregates joined back with a broadcast (one row is a proven size bound), so
no un-partitioned window pulls the data into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions import scalars as S


def _dbl(c) -> F.Column:
    return c.cast("double")


def with_week_parts(df: DataFrame, week: str = "week") -> DataFrame:
    """F1 applied to a frame: adds week_num and year."""
    return df.withColumns({"week_num": S.week_num(week), "year": S.week_year(week)})


def weekly_totals(df: DataFrame, week: str = "week", measure: str = "sales",
                  units: str = "units") -> DataFrame:
    """A1 + O1: SUM by week, ordered by (year, week number)."""
    g = df.groupBy(week).agg(_dbl(F.sum(measure)).alias("total_sales"),
                             F.sum(units).cast("bigint").alias("total_units"),
                             F.count("*").alias("row_count"))
    return with_week_parts(g, week).orderBy("year", "week_num")


def latest_week(df: DataFrame, week: str = "week") -> DataFrame:
    """The latest period by (year, week number) — not by week text (K5).
    One row: week, week_num, year."""
    w = with_week_parts(df.select(week).filter(F.col(week).isNotNull()), week)
    m = w.agg(F.max(F.struct("year", "week_num", F.col(week).alias("week"))).alias("m"))
    return m.select(F.col("m.week").alias("week"), F.col("m.week_num").alias("week_num"),
                    F.col("m.year").alias("year"))


def in_latest_week(df: DataFrame, week: str = "week") -> DataFrame:
    """Rows of the latest week. The one-row period is broadcast."""
    lw = latest_week(df, week).select(F.col("week_num").alias("_lw_num"), F.col("year").alias("_lw_year"))
    x = with_week_parts(df, week)
    return (x.join(F.broadcast(lw), (x.week_num == lw._lw_num) & (x.year == lw._lw_year))
            .drop("_lw_num", "_lw_year"))


def latest_period(agg: DataFrame, week: str = "week") -> DataFrame:
    """Rows of the latest week of an already aggregated frame (one row per
    week and group). The latest week is taken from the aggregate itself, so
    the fact is scanned and shuffled once: both uses share the same
    exchange, which Spark reuses."""
    x = with_week_parts(agg, week)
    # The struct carries every column of the aggregate so that column pruning
    # leaves both branches with the same aggregate; Spark then reuses the one
    # shuffle (ReusedExchange) instead of scanning the fact twice.
    rest = [c for c in x.columns if c not in ("year", "week_num")]
    lw = (x.agg(F.max(F.struct("year", "week_num", *rest)).alias("_m"))
          .select(F.col("_m.year").alias("_lw_year"), F.col("_m.week_num").alias("_lw_num")))
    # null-safe equality: a plain inner equi-join would let Spark infer
    # isnotnull() filters and push them into one branch only, which breaks
    # the exchange reuse
    return (x.join(F.broadcast(lw), x.week_num.eqNullSafe(lw._lw_num) & x.year.eqNullSafe(lw._lw_year))
            .drop("_lw_num", "_lw_year"))


def latest_kpis(df: DataFrame, dims: Sequence[str], week: str = "week", **kw) -> DataFrame:
    """A2 for the latest week: KPI sums by (week, dims) in one pass, the
    latest week's groups kept, then the derived columns, filter and sort."""
    sums = latest_period(kpi_sums(df, [week, *dims], **kw), week).drop(week, "week_num", "year")
    return kpi_finish(sums, dims)


SUM_COLS = ["_ty", "_ly", "_u", "_uly", "_ret", "_can", "_gross", "_cv"]


def kpi_sums(df: DataFrame, dims: Sequence[str], sales: str = "sales", sales_ly: str = "sales_ly",
             units: str = "units", units_ly: str = "units_ly", returns: str = "return_amt",
             cancels: str = "cancel_units") -> DataFrame:
    """The additive part of A2: one aggregation (partial + final) of the KPI
    sums by `dims`. Money stays decimal, so sums of these sums are exact."""
    s, u, c, r = F.col(sales), F.col(units), F.col(cancels), F.col(returns)
    # net sales per row: sales - returns - cancels * unit price; a row with a
    # null in any of them has none. Its parts are summed apart (money exactly).
    gross, cancelled = s - r, _dbl(c) * (_dbl(s) / S.nz(u))
    has_net = gross.isNotNull() & cancelled.isNotNull()
    return df.groupBy(*dims).agg(
        F.sum(s).alias("_ty"), F.sum(sales_ly).alias("_ly"), F.sum(u).alias("_u"),
        F.sum(units_ly).alias("_uly"), F.sum(F.abs(r)).alias("_ret"),
        F.sum(F.abs(c)).alias("_can"), F.sum(F.when(has_net, gross)).alias("_gross"),
        F.sum(F.when(has_net, cancelled)).alias("_cv"))


def kpi_rollup(sums: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Re-aggregate KPI sums to coarser dimensions."""
    return sums.groupBy(*dims).agg(*[F.sum(c).alias(c) for c in SUM_COLS])


def kpi_finish(sums: DataFrame, dims: Sequence[str], positive_only: bool = True,
               sort: bool = True) -> DataFrame:
    """Derived KPI columns from the sums (zero denominators become 1)."""
    z = F.lit(0)
    g = sums.select(
        *dims,
        _dbl(F.coalesce(F.col("_ty"), z)).alias("ty_sales"),
        _dbl(F.coalesce(F.col("_ly"), z)).alias("ly_sales"),
        F.coalesce(F.col("_u"), z).cast("bigint").alias("ty_units"),
        F.coalesce(F.col("_uly"), z).cast("bigint").alias("ly_units"),
        _dbl(F.coalesce(F.col("_ret"), z)).alias("returns"),
        F.coalesce(F.col("_can"), z).cast("bigint").alias("cancels"),
        (_dbl(F.coalesce(F.col("_gross"), z)) - F.coalesce(F.col("_cv"), F.lit(0.0))).alias("net_sales"))
    g = g.withColumns({
        "sales_diff": F.col("ty_sales") - F.col("ly_sales"),
        "sales_growth_pct": (F.col("ty_sales") / S.nz(F.col("ly_sales")) - 1) * 100,
        "return_rate": F.col("returns") / S.nz(F.col("ty_sales")) * 100,
        "cancel_rate": F.col("cancels") / S.nz(F.col("ty_units")) * 100,
    })
    if positive_only:
        g = g.filter(F.col("ty_sales") > 0)
    return g.orderBy(F.col("sales_diff").desc_nulls_first(), *dims) if sort else g


def sales_kpis(df: DataFrame, dims: Sequence[str], positive_only: bool = True,
               sort: bool = True, **cols) -> DataFrame:
    """A2: KPI roll-up by any dimension list: ty/ly sales and units, returns,
    cancels, net sales, diff, growth %, return and cancel rates; rows with
    positive sales only; sorted by sales_diff desc."""
    return kpi_finish(kpi_sums(df, dims, **cols), dims, positive_only, sort)


def share_of_total(df: DataFrame, dim: str, measure: str = "sales",
                   measure_ly: str = "sales_ly", period: str | None = None) -> DataFrame:
    """A3: x / sum(x) * 100 by one dimension. The total is summed from the
    grouped rows (exact decimal sums) and broadcast back as one row, so the
    fact is read once and no global window is used. With `period`, only the
    latest week counts."""
    keys = [period, dim] if period else [dim]
    g = df.groupBy(*keys).agg(F.sum(measure).alias("_ty"), F.sum(measure_ly).alias("_ly"))
    if period:
        g = latest_period(g, period).drop(period, "week_num", "year")
    tot = g.agg(_dbl(F.sum("_ty")).alias("_total"))
    return (g.crossJoin(F.broadcast(tot))
            .select(dim, _dbl(F.col("_ty")).alias("ty_sales"), _dbl(F.col("_ly")).alias("ly_sales"),
                    (_dbl(F.col("_ty")) / S.nz(F.col("_total")) * 100).alias("sales_share")))


def standouts(agg: DataFrame, metric: str = "sales_diff", top_n: int = 5, bottom_n: int = 5,
              tie_break: Sequence[str] = ()) -> DataFrame:
    """Top-N and bottom-N rows by a metric, labelled and ranked. Each side
    is a TakeOrderedAndProject (bounded per partition); the limit is the feature."""
    tb = [F.col(c).asc_nulls_last() for c in tie_break]
    top = (agg.orderBy(F.col(metric).desc_nulls_last(), *tb).limit(top_n)
           .withColumn("standout", F.lit("top")))
    bottom = (agg.orderBy(F.col(metric).asc_nulls_last(), *tb).limit(bottom_n)
              .withColumn("standout", F.lit("bottom")))
    return top.unionByName(bottom)


def flag_high_rates(agg: DataFrame, threshold: float = 20.0) -> DataFrame:
    """W6 flags: groups whose return or cancel rate exceeds the threshold."""
    hr = agg.filter(F.col("return_rate") > threshold).withColumn("flag", F.lit("high_return"))
    hc = agg.filter(F.col("cancel_rate") > threshold).withColumn("flag", F.lit("high_cancel"))
    return hr.unionByName(hc)


def weekly_trend(df: DataFrame, weeks_back: int, dims: Sequence[str] = (),
                 week: str = "week", sales: str = "sales", sales_ly: str = "sales_ly") -> DataFrame:
    """Trend over the last N weeks of the latest year (the week filter applies
    with and without dimensions, fixing K6). One aggregation by (week, dims);
    the latest week is read from it. As in `latest_period`, the max carries
    every column and the join conditions are written so that no one-sided
    isnotnull filter is inferred: both branches then share one shuffle."""
    g = with_week_parts(df.groupBy(week, *dims).agg(
        _dbl(F.coalesce(F.sum(sales), F.lit(0))).alias("ty_sales"),
        _dbl(F.coalesce(F.sum(sales_ly), F.lit(0))).alias("ly_sales")), week)
    rest = [c for c in g.columns if c not in ("year", "week_num")]
    lw = (g.agg(F.max(F.struct("year", "week_num", *rest)).alias("_m"))
          .select(F.col("_m.year").alias("_ly"), F.col("_m.week_num").alias("_lw")))
    lo = F.col("_lw") - weeks_back + 1 if weeks_back > 0 else F.lit(1)
    cond = g.year.eqNullSafe(lw._ly) & F.coalesce(g.week_num >= lo, F.lit(False))
    x = g.join(F.broadcast(lw), cond).drop("_ly", "_lw")
    return x.select(week, "week_num", "year", *dims, "ty_sales", "ly_sales").orderBy("year", "week_num", *dims)


def conversion_rate(web: DataFrame, visits: str = "pip_visits", visits_ly: str = "pip_visits_ly",
                    orders: str = "orders_ty", orders_ly: str = "orders_ly",
                    period: str | None = None) -> DataFrame:
    """Orders / visits * 100 over the given rows (or the latest week of
    `period`), visits 0 -> 1."""
    sums = [F.coalesce(F.sum(orders), F.lit(0.0)).alias("o"), F.coalesce(F.sum(orders_ly), F.lit(0.0)).alias("ol"),
            F.coalesce(F.sum(visits), F.lit(0.0)).alias("v"), F.coalesce(F.sum(visits_ly), F.lit(0.0)).alias("vl")]
    if period:
        t = latest_period(web.groupBy(period).agg(*sums), period)
    else:
        t = web.agg(*sums)
    return t.select((F.col("o") / S.nz(F.col("v")) * 100).alias("conv_ty"),
                    (F.col("ol") / S.nz(F.col("vl")) * 100).alias("conv_ly"))


def sales_growth(df: DataFrame, sales: str = "sales", sales_ly: str = "sales_ly",
                 period: str | None = None) -> DataFrame:
    """(sum TY / sum LY (0 -> 1) - 1) * 100, plus both totals (of the
    latest week of `period` when given)."""
    sums = [_dbl(F.coalesce(F.sum(sales), F.lit(0))).alias("total_ty"),
            _dbl(F.coalesce(F.sum(sales_ly), F.lit(0))).alias("total_ly")]
    if period:
        t = latest_period(df.groupBy(period).agg(*sums), period).select("total_ty", "total_ly")
    else:
        t = df.agg(*sums)
    return t.withColumn("sales_growth",
                        (F.col("total_ty") / S.nz(F.col("total_ly")) - 1) * 100)


def top_labels(df: DataFrame, label: str, order: Sequence, n: int = 3, sep: str = ", ",
              none: str = "None") -> DataFrame:
    """First n labels by an order, joined as text (one row). The limit (a
    TakeOrderedAndProject) bounds what reaches the final aggregate."""
    picked = df.orderBy(*order).limit(n)
    ranked = picked.select(F.col(label).alias("_l"),
                           F.row_number().over(Window.orderBy(*order)).alias("_r"))
    q = sep.replace("'", "''")
    return ranked.agg(F.coalesce(F.expr(f"listagg(_l, '{q}') WITHIN GROUP (ORDER BY _r)"),
                                 F.lit(none)).alias("labels"))
