"""Weekly report queries (C4 and its parts: A1, A2, A3, A19, A20, O1, O2,
O5, W1-W3, W6, F1, J1, J2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions import scalars as S
from shelfwise.operators import enrich as E
from shelfwise.operators import jobs as JB
from shelfwise.operators import kpis as K
from shelfwise.plans import bindings as B
from shelfwise.plans import sql_parts as Q
from shelfwise.plans.registry import query
from shelfwise.session import cut_lineage

DIMS = ["dept", "class", "subclass"]


def report_window(s):
    """The report's weeks; the day range reaches the file scan, the label's
    pattern stays as the rule."""
    first, after = (F.lit(x).cast("timestamp_ntz") for x in Q.REPORT_DAYS)
    return s.filter((F.col("day") >= first) & (F.col("day") < after) & F.col("week").rlike(Q.REPORT_WEEKS))


def report_base(spark, d):
    """W1 + W2 + W3, J1 (catalogue, left) and J2 (stores, inner)."""
    c = E.classification_clean(B.classification_feed(spark, d)).select(
        "item", *DIMS, "classification", "ship_from")
    st = B.stores(spark, d).select("store", "market", "region")
    return JB.report_base(B.sales(spark, d), c, st, Q.REPORT_WEEKS, Q.REPORT_DAYS)


def class_agg(spark, d):
    """KPIs per class of the latest week; net sales (a sum of doubles, whose
    last digits depend on the order of adding) to cents for the comparison."""
    return K.latest_kpis(report_base(spark, d), DIMS).withColumn("net_sales", F.round("net_sales", 2))


KPI_COLS = ("ty_sales, ly_sales, ty_units, ly_units, returns, cancels, net_sales, sales_diff, "
            "sales_growth_pct, return_rate, cancel_rate")


@query("weekly_totals", sql=f"""WITH s AS ({B.sales_sql()})
SELECT week, CAST(sum(sales) AS DOUBLE) AS total_sales, CAST(sum(units) AS BIGINT) AS total_units,
  count(*) AS row_count, {Q.week_num('week')} AS week_num, {Q.week_year('week')} AS year
FROM s GROUP BY week""")
def weekly_totals(spark, d):
    return K.weekly_totals(B.sales(spark, d))


_WEEK_VARIANT_SQL = """CASE WHEN line = 7 THEN NULL WHEN line = 6 THEN 'Week ' || channel ELSE week END"""


@query("parse_fiscal_week", sql=f"""WITH s AS ({B.sales_sql()}),
v AS (SELECT DISTINCT {_WEEK_VARIANT_SQL} AS week FROM s)
SELECT week, {Q.week_num('week')} AS week_num, {Q.week_year('week')} AS year FROM v""")
def parse_fiscal_week(spark, d):
    s = B.sales(spark, d)
    v = s.select(F.when(F.col("line") == 7, F.lit(None).cast("string"))
                 .when(F.col("line") == 6, F.concat(F.lit("Week "), F.col("channel")))
                 .otherwise(F.col("week")).alias("week")).distinct()
    return v.select("week", S.week_num("week").alias("week_num"), S.week_year("week").alias("year"))


@query("weeks_sorted", sql=f"""WITH w AS ({B.website_sql()}), s AS ({B.sales_sql()}),
v AS (SELECT DISTINCT week FROM w UNION SELECT DISTINCT {_WEEK_VARIANT_SQL} FROM s)
SELECT week, {Q.week_num('week')} AS week_num, {Q.week_year('week')} AS year FROM v""")
def weeks_sorted(spark, d):
    """O2: distinct weeks of the tables, sorted by (year, week) desc, malformed last."""
    s = B.sales(spark, d).select(
        F.when(F.col("line") == 7, F.lit(None).cast("string"))
        .when(F.col("line") == 6, F.concat(F.lit("Week "), F.col("channel")))
        .otherwise(F.col("week")).alias("week"))
    v = B.website(spark, d).select("week").unionByName(s).distinct()
    v = K.with_week_parts(v)
    return v.orderBy(F.col("year").desc_nulls_last(), F.col("week_num").desc_nulls_last(),
                     F.col("week").desc_nulls_last())


@query("latest_week", sql=f"""WITH s AS ({B.sales_sql()})
SELECT week, {Q.week_num('week')} AS week_num, {Q.week_year('week')} AS year FROM s
WHERE week IS NOT NULL
ORDER BY year DESC NULLS LAST, week_num DESC NULLS LAST, week DESC LIMIT 1""")
def latest_week(spark, d):
    return K.latest_week(B.sales(spark, d))


@query("filter_week_regex", sql=f"""WITH s AS ({B.sales_sql()})
SELECT item, store, day, week, CAST(sales AS DOUBLE) AS sales FROM s
WHERE regexp_matches(week, '{Q.REPORT_WEEKS}')""")
def filter_week_regex(spark, d):
    return report_window(B.sales(spark, d)).select(
        "item", "store", "day", "week", F.col("sales").cast("double").alias("sales"))


@query("weekly_trend", sql=f"""WITH {Q.REPORT_CTES}
SELECT week, week_num, year, CAST(coalesce(sum(sales), 0) AS DOUBLE) AS ty_sales,
  CAST(coalesce(sum(sales_ly), 0) AS DOUBLE) AS ly_sales
FROM wk JOIN lw ON wk.year = lw.l_year AND wk.week_num >= lw.l_num - 8 + 1
GROUP BY week, week_num, year""")
def weekly_trend(spark, d):
    return K.weekly_trend(report_base(spark, d), 8)


@query("sales_kpis", sql=f"""WITH {Q.REPORT_CTES}, {Q.CLASS_AGG}
SELECT * FROM class_agg""")
def sales_kpis(spark, d):
    return class_agg(spark, d)


@query("share_of_total", sql=f"""WITH {Q.REPORT_CTES},
tot AS (SELECT CAST(sum(sales) AS DOUBLE) AS total FROM recent)
SELECT 'classification' AS dimension, classification AS value,
  CAST(sum(sales) AS DOUBLE) AS ty_sales, CAST(sum(sales_ly) AS DOUBLE) AS ly_sales,
  CAST(sum(sales) AS DOUBLE) / (SELECT total FROM tot) * 100 AS sales_share
FROM recent GROUP BY classification
UNION ALL
SELECT 'ship_from', ship_from, CAST(sum(sales) AS DOUBLE), CAST(sum(sales_ly) AS DOUBLE),
  CAST(sum(sales) AS DOUBLE) / (SELECT total FROM tot) * 100
FROM recent GROUP BY ship_from""")
def share_of_total(spark, d):
    """A3 for the latest week by classification and by ship-from. Both shares
    re-aggregate one (week, classification, ship-from) aggregate of the fact,
    checkpointed once (it is small), so the fact is read once."""
    fine = K.latest_period(K.kpi_sums(report_base(spark, d), ["week", "classification", "ship_from"]), "week")
    fine = cut_lineage(fine.select("classification", "ship_from", "_ty", "_ly"))   # small; read once
    out = None
    for dim in ("classification", "ship_from"):
        part = K.share_of_total(fine, dim, "_ty", "_ly").select(
            F.lit(dim).alias("dimension"), F.col(dim).alias("value"), "ty_sales", "ly_sales", "sales_share")
        out = part if out is None else out.unionByName(part)
    return out


@query("standouts", sql=f"""WITH {Q.REPORT_CTES}, {Q.CLASS_AGG}
(SELECT *, 'top' AS standout FROM class_agg
 ORDER BY sales_diff DESC NULLS LAST, dept NULLS LAST, class NULLS LAST, subclass NULLS LAST LIMIT 5)
UNION ALL
(SELECT *, 'bottom' AS standout FROM class_agg
 ORDER BY sales_diff ASC NULLS LAST, dept NULLS LAST, class NULLS LAST, subclass NULLS LAST LIMIT 5)""")
def standouts(spark, d):
    return K.standouts(class_agg(spark, d), "sales_diff", 5, 5, tie_break=DIMS)


@query("flag_high_rates", sql=f"""WITH {Q.REPORT_CTES}, {Q.CLASS_AGG}
SELECT *, 'high_return' AS flag FROM class_agg WHERE return_rate > 20
UNION ALL
SELECT *, 'high_cancel' AS flag FROM class_agg WHERE cancel_rate > 20""")
def flag_high_rates(spark, d):
    return K.flag_high_rates(class_agg(spark, d), 20.0)


@query("sales_growth", sql=f"""WITH {Q.REPORT_CTES}
SELECT total_ty, total_ly, (total_ty / {Q.nz('total_ly')} - 1) * 100 AS sales_growth
FROM (SELECT CAST(coalesce(sum(sales), 0) AS DOUBLE) AS total_ty,
             CAST(coalesce(sum(sales_ly), 0) AS DOUBLE) AS total_ly FROM recent)""")
def sales_growth(spark, d):
    return K.sales_growth(report_base(spark, d), period="week")


_CONV_SQL = f"""w AS ({B.website_sql()}),
ww AS (SELECT *, {Q.week_num('week')} AS week_num, {Q.week_year('week')} AS year FROM w),
wl AS (SELECT year AS l_year, week_num AS l_num FROM ww
  ORDER BY year DESC NULLS LAST, week_num DESC NULLS LAST, week DESC LIMIT 1),
wr AS (SELECT ww.* FROM ww JOIN wl ON ww.year = wl.l_year AND ww.week_num = wl.l_num),
conv AS (SELECT o / {Q.nz('v')} * 100 AS conv_ty, ol / {Q.nz('vl')} * 100 AS conv_ly
  FROM (SELECT coalesce(sum(orders_ty), 0.0) AS o, coalesce(sum(orders_ly), 0.0) AS ol,
               coalesce(sum(pip_visits), 0.0) AS v, coalesce(sum(pip_visits_ly), 0.0) AS vl FROM wr))"""


@query("conversion_rate", sql=f"WITH {_CONV_SQL} SELECT * FROM conv")
def conversion_rate(spark, d):
    """A19 on the latest week of the website feed."""
    return K.conversion_rate(B.website(spark, d), period="week")


@query("insights_row", sql=f"""WITH {Q.REPORT_CTES}, {Q.CLASS_AGG}, {_CONV_SQL},
g AS (SELECT CAST(coalesce(sum(sales), 0) AS DOUBLE) AS total_ty,
             CAST(coalesce(sum(sales_ly), 0) AS DOUBLE) AS total_ly FROM recent),
tot AS (SELECT CAST(sum(sales) AS DOUBLE) AS total FROM recent),
oo AS (SELECT coalesce(sum(share), 0.0) AS online_only_share FROM (
  SELECT CAST(sum(sales) AS DOUBLE) / (SELECT total FROM tot) * 100 AS share FROM recent
  WHERE classification = 'Online only' GROUP BY classification)),
yow AS (SELECT coalesce(sum(share), 0.0) AS yow_share FROM (
  SELECT CAST(sum(sales) AS DOUBLE) / (SELECT total FROM tot) * 100 AS share FROM recent
  WHERE ship_from = 'YOW' GROUP BY ship_from)),
hr AS (SELECT coalesce(string_agg(subclass, ', ' ORDER BY sales_diff DESC, dept, class, subclass), 'None') AS high_return_subclasses
  FROM (SELECT * FROM class_agg WHERE return_rate > 20
        ORDER BY sales_diff DESC, dept, class, subclass LIMIT 3)),
hc AS (SELECT coalesce(string_agg(subclass, ', ' ORDER BY sales_diff DESC, dept, class, subclass), 'None') AS high_cancel_subclasses
  FROM (SELECT * FROM class_agg WHERE cancel_rate > 20
        ORDER BY sales_diff DESC, dept, class, subclass LIMIT 3))
SELECT (SELECT week FROM recent LIMIT 1) AS week, g.total_ty, g.total_ly,
  (g.total_ty / {Q.nz('g.total_ly')} - 1) * 100 AS sales_growth,
  conv.conv_ty, conv.conv_ly, oo.online_only_share, yow.yow_share,
  hr.high_return_subclasses, hc.high_cancel_subclasses
FROM g, conv, oo, yow, hr, hc""")
def insights_row(spark, d):
    """C4 insights: one row with the recent week's totals, growth, conversion,
    online-only and YOW shares and up to three flagged subclasses each.

    The fact is read once: KPI sums by the finest grain the report needs
    (week, dims, classification, ship-from) are aggregated, cut to the latest
    week and checkpointed to the shared checkpoint folder; every part of the
    row is a re-aggregation of that small table."""
    fine = K.kpi_sums(report_base(spark, d), ["week", *DIMS, "classification", "ship_from"])
    fine = cut_lineage(K.latest_period(fine, "week"))
    agg = K.kpi_finish(K.kpi_rollup(fine, DIMS), DIMS)
    # week, totals, growth and both shares come from one aggregate of `fine`
    tot = F.col("_tot").cast("double")
    head = fine.agg(
        F.max("week").alias("week"), F.sum("_ty").alias("_tot"),
        F.coalesce(F.sum("_ty"), F.lit(0)).cast("double").alias("total_ty"),
        F.coalesce(F.sum("_ly"), F.lit(0)).cast("double").alias("total_ly"),
        F.sum(F.when(F.col("classification") == "Online only", F.col("_ty"))).alias("_oo"),
        F.sum(F.when(F.col("ship_from") == "YOW", F.col("_ty"))).alias("_yow"),
    ).select(
        "week", "total_ty", "total_ly",
        ((F.col("total_ty") / S.nz(F.col("total_ly")) - 1) * 100).alias("sales_growth"),
        F.coalesce(F.col("_oo").cast("double") / tot * 100, F.lit(0.0)).alias("online_only_share"),
        F.coalesce(F.col("_yow").cast("double") / tot * 100, F.lit(0.0)).alias("yow_share"))
    conv = K.conversion_rate(B.website(spark, d), period="week")
    order = [F.col("sales_diff").desc(), *DIMS]
    hr = K.top_labels(agg.filter(F.col("return_rate") > 20), "subclass", order, 3) \
        .withColumnRenamed("labels", "high_return_subclasses")
    hc = K.top_labels(agg.filter(F.col("cancel_rate") > 20), "subclass", order, 3) \
        .withColumnRenamed("labels", "high_cancel_subclasses")
    out = head
    for part in (conv, hr, hc):                 # one-row frames
        out = out.crossJoin(part)
    return out.select("week", "total_ty", "total_ly", "sales_growth", "conv_ty", "conv_ly",
                      "online_only_share", "yow_share", "high_return_subclasses",
                      "high_cancel_subclasses")
