"""Shared DuckDB SQL fragments for the oracle queries (mirrors of the Spark
bindings and of the scalar functions)."""

from __future__ import annotations

from shelfwise.plans import bindings as B

# Fixed value: the report's week window, a parameter in place of the
# hard-coded "weeks 1-8 of 2025" (K4), aimed at a year present in the data.
REPORT_WEEKS = r"Fiscal Week (?:[1-8]) of 1998"
# the same window as days, which the file scan can use: weeks are 7-day blocks from January 1
REPORT_DAYS = ("1998-01-01", "1998-02-26")
AS_OF = "2024-03-01 00:00:00"


def week_num(c: str) -> str:
    return rf"TRY_CAST(NULLIF(regexp_extract({c}, 'Fiscal Week (\d+) of (\d+)', 1), '') AS INTEGER)"


def week_year(c: str) -> str:
    return rf"TRY_CAST(NULLIF(regexp_extract({c}, 'Fiscal Week (\d+) of (\d+)', 2), '') AS INTEGER)"


def nz(c: str) -> str:
    return f"(CASE WHEN {c} = 0 THEN 1 ELSE {c} END)"


def strip_point_zero(c: str) -> str:
    return rf"regexp_replace(coalesce(CAST({c} AS VARCHAR), ''), '\.0$', '')"


CLASSIFICATION_CLEAN = f"""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY file_no, row_no) AS rn
  FROM ({B.CLASSIFICATION_FEED_SQL}) WHERE length(upc) = 12) WHERE rn = 1"""

# report base: positive sales of the week window with a known store, with
# catalogue columns (left) and store columns (inner)
REPORT_CTES = f"""s AS ({B.sales_sql()}),
c AS ({CLASSIFICATION_CLEAN}),
st AS ({B.STORES_SQL}),
base AS (SELECT s.*, c.dept, c.class, c.subclass, c.classification, c.ship_from, st.market, st.region
  FROM s LEFT JOIN c ON s.item = c.item JOIN st ON s.store = st.store
  WHERE s.sales > 0 AND regexp_matches(s.week, '{REPORT_WEEKS}') AND s.store IS NOT NULL),
wk AS (SELECT *, {week_num('week')} AS week_num, {week_year('week')} AS year FROM base),
lw AS (SELECT year AS l_year, week_num AS l_num FROM wk WHERE week IS NOT NULL
  ORDER BY year DESC NULLS LAST, week_num DESC NULLS LAST, week DESC LIMIT 1),
recent AS (SELECT wk.* FROM wk JOIN lw ON wk.year = lw.l_year AND wk.week_num = lw.l_num)"""

KPI_SELECT = f"""ty_sales, ly_sales, ty_units, ly_units, returns, cancels,
  round(net, 2) AS net_sales,
  ty_sales - ly_sales AS sales_diff,
  (ty_sales / {nz('ly_sales')} - 1) * 100 AS sales_growth_pct,
  returns / {nz('ty_sales')} * 100 AS return_rate,
  cancels / {nz('ty_units')} * 100 AS cancel_rate"""

KPI_AGGS = f"""CAST(coalesce(sum(sales), 0) AS DOUBLE) AS ty_sales,
  CAST(coalesce(sum(sales_ly), 0) AS DOUBLE) AS ly_sales,
  CAST(coalesce(sum(units), 0) AS BIGINT) AS ty_units,
  CAST(coalesce(sum(units_ly), 0) AS BIGINT) AS ly_units,
  CAST(coalesce(sum(abs(return_amt)), 0) AS DOUBLE) AS returns,
  CAST(coalesce(sum(abs(cancel_units)), 0) AS BIGINT) AS cancels,
  coalesce(sum(CAST(sales AS DOUBLE) - CAST(return_amt AS DOUBLE)
    - CAST(cancel_units AS DOUBLE) * (CAST(sales AS DOUBLE) / {nz('units')})), 0.0) AS net"""

CLASS_AGG = f"""class_agg AS (SELECT dept, class, subclass, {KPI_SELECT}
  FROM (SELECT dept, class, subclass, {KPI_AGGS} FROM recent GROUP BY dept, class, subclass)
  WHERE ty_sales > 0)"""
