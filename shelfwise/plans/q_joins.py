"""Join and set-operation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import diff as DF
from shelfwise.operators import enrich as E
from shelfwise.operators import upsert as U
from shelfwise.plans import bindings as B
from shelfwise.plans import sql_parts as Q
from shelfwise.plans.registry import query


LEFT_CATALOG_SQL = f"""SELECT s.item, s.store, s.day, CAST(s.sales AS DOUBLE) AS sales,
  c.dept, c.class, c.subclass
FROM ({B.sales_sql()}) s LEFT JOIN ({Q.CLASSIFICATION_CLEAN}) c ON s.item = c.item"""


@query("join_left_catalog", sql=LEFT_CATALOG_SQL)
def join_left_catalog(spark, d):
    """Fact -> catalogue on item id (left)."""
    c = E.classification_clean(B.classification_feed(spark, d)).select("item", "dept", "class", "subclass")
    s = B.sales(spark, d).select("item", "store", "day", F.col("sales").cast("double").alias("sales"))
    return s.join(c, "item", "left")


@query("join_inner_store", sql=f"""SELECT s.item, s.store, s.day, CAST(s.sales AS DOUBLE) AS sales,
  st.market, st.region
FROM ({B.sales_sql()}) s JOIN (SELECT CASE WHEN store % 5 = 0 THEN -store ELSE store END AS store, market, region
  FROM ({B.STORES_SQL})) st ON s.store = st.store""")
def join_inner_store(spark, d):
    """Sales -> stores (inner); sales of stores outside the store list drop
    out (here: every fifth store is listed under another number)."""
    st = B.stores(spark, d).select(F.when(F.col("store") % 5 == 0, -F.col("store")).otherwise(F.col("store")).alias("store"),
                                   "market", "region")
    s = B.sales(spark, d).select("item", "store", "day", F.col("sales").cast("double").alias("sales"))
    return s.join(st, "store", "inner")


_FG_CLEAN_SQL = f"""SELECT *, basic || '-' || dash AS basic_dash FROM (
  SELECT *, row_number() OVER (PARTITION BY upc ORDER BY file_no, row_no) AS rn FROM ({B.FG_FEED_SQL}))
WHERE rn = 1"""


@query("join_prefix_key", sql=f"""SELECT c.item, c.upc, f.upc AS fg_upc, f.mpg, f.ipg
FROM ({Q.CLASSIFICATION_CLEAN}) c LEFT JOIN ({_FG_CLEAN_SQL}) f ON substring(c.upc, 1, 11) = f.upc""")
def join_prefix_key(spark, d):
    """The 11-char prefix of the 12-char catalogue code joins the FG UPC."""
    c = E.classification_clean(B.classification_feed(spark, d)).select("item", "upc")
    fg = E.fg_status_clean(B.fg_feed(spark, d)).select(F.col("upc").alias("fg_upc"), "mpg", "ipg")
    j = c.withColumn("_pk", F.substring("upc", 1, 11))
    return j.join(fg, j["_pk"] == fg["fg_upc"], "left").drop("_pk")


_QUOTES_NULL_STORE = "CASE WHEN order_no % 10 = 0 THEN NULL ELSE store END"


@query("join_lookup_nullsafe", sql=f"""SELECT q.order_no, q.store, t.owner, q.quote_total_text
FROM (SELECT order_no, {_QUOTES_NULL_STORE} AS store, quote_total_text FROM ({B.QUOTES_SQL})) q
LEFT JOIN (SELECT CASE WHEN n_nationkey = 24 THEN NULL ELSE n_nationkey END AS store_no,
                  'DSR-' || CAST(n_regionkey AS VARCHAR) AS owner FROM nation) t
  ON q.store IS NOT DISTINCT FROM t.store_no""")
def join_lookup_nullsafe(spark, d):
    """Lookup of the owner by store where a null store matches the null
    store entry (pandas merge semantics); the lookup key is dropped."""
    q = B.quotes(spark, d).selectExpr("order_no", f"{_QUOTES_NULL_STORE} AS store", "quote_total_text")
    n = B.table(spark, d, "nation")
    t = n.select(F.when(F.col("n_nationkey") == 24, F.lit(None)).otherwise(F.col("n_nationkey")).alias("store_no"),
                 F.concat(F.lit("DSR-"), F.col("n_regionkey").cast("string")).alias("owner"))
    return E.join_null_safe(q, t, "store", "store_no", ["owner"]).select(
        "order_no", "store", "owner", "quote_total_text")


def _snap_keys(df):
    return df.groupBy("omsid", "dc").agg(F.count("*").alias("rows"), F.sum("oh_qty").alias("oh"))


_NORM = "SELECT * REPLACE (coalesce(substring(dc, 1, 4), 'nan') AS dc) FROM ({src}) WHERE omsid <> 0"


def _norm_sql(year):
    return _NORM.format(src=B.snapshot_sql(year))


@query("join_outer_indicator", sql=f"""WITH lo AS (SELECT omsid, dc, count(*) AS rows, sum(oh_qty) AS oh
    FROM ({_norm_sql(1997)}) GROUP BY omsid, dc),
  hi AS (SELECT omsid, dc, count(*) AS rows, sum(oh_qty) AS oh FROM ({_norm_sql(1998)}) GROUP BY omsid, dc)
SELECT coalesce(lo.omsid, hi.omsid) AS omsid, coalesce(lo.dc, hi.dc) AS dc,
  lo.rows AS rows_low, lo.oh AS oh_low, hi.rows AS rows_high, hi.oh AS oh_high,
  CASE WHEN lo.omsid IS NOT NULL AND hi.omsid IS NOT NULL THEN 'both'
       WHEN lo.omsid IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS merge_side
FROM lo FULL OUTER JOIN hi ON lo.omsid = hi.omsid AND lo.dc = hi.dc""")
def join_outer_indicator(spark, d):
    """J6 on per-key aggregates of the two snapshots (one row per key and
    side, so the outer join never pairs duplicate rows)."""
    lo = _snap_keys(DF.normalise_snapshot(B.snapshot(spark, d, 1997)))
    hi = _snap_keys(DF.normalise_snapshot(B.snapshot(spark, d, 1998)))
    return E.outer_with_indicator(lo, hi, ["omsid", "dc"])


@query("join_anti_missing", sql=f"""SELECT DISTINCT omsid FROM ({_norm_sql(1997)})
WHERE omsid NOT IN (SELECT omsid FROM ({_norm_sql(1998)}))""")
def join_anti_missing(spark, d):
    """Ids in last week's snapshot with no row this week."""
    lo = DF.normalise_snapshot(B.snapshot(spark, d, 1997))
    hi = DF.normalise_snapshot(B.snapshot(spark, d, 1998))
    return E.missing_ids(lo, hi, "omsid")


@query("join_semi", sql=f"""SELECT item, store, day, CAST(sales AS DOUBLE) AS sales FROM ({B.sales_sql()})
WHERE item IN (SELECT p_partkey FROM part WHERE p_size > 45)""")
def join_semi(spark, d):
    """Sales rows whose item is in another set (no collected id list)."""
    big = B.table(spark, d, "part").filter(F.col("p_size") > 45).select(F.col("p_partkey").alias("item"))
    s = B.sales(spark, d).select("item", "store", "day", F.col("sales").cast("double").alias("sales"))
    return s.join(big, "item", "left_semi")


# stored table / batch for the upsert family; the select lists
# are SQL text both engines accept.
STORED_COLS = ["l_orderkey AS order_key", "l_linenumber AS line",
               "CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE l_shipdate END AS day",
               "CASE WHEN l_orderkey % 89 = 0 THEN NULL ELSE l_partkey END AS item",
               "l_quantity AS qty", "CAST(l_extendedprice AS FLOAT) AS sales"]
BATCH_COLS = ["l_orderkey AS order_key", "l_linenumber AS line", "l_shipdate AS day", "l_partkey AS item",
              "CAST(l_quantity AS INTEGER) AS qty", "CAST(l_extendedprice AS FLOAT) AS sales"]
# The batch is a delivery of two months' seventh lines, the stored table all other rows.
_IN_BATCH = "l_linenumber = 7 AND l_shipdate >= {t} '1998-01-01' AND l_shipdate < {t} '1998-03-01'"
_STORED_SQL = f"SELECT {', '.join(STORED_COLS)} FROM lineitem WHERE NOT coalesce({_IN_BATCH.format(t='TIMESTAMP')}, false)"
_BATCH_SQL = f"SELECT {', '.join(BATCH_COLS)} FROM lineitem WHERE {_IN_BATCH.format(t='TIMESTAMP')}"


def stored_table(spark, d):
    return B.table(spark, d, "lineitem").filter(
        f"NOT coalesce({_IN_BATCH.format(t='TIMESTAMP_NTZ')}, false)").selectExpr(*STORED_COLS)


def batch_table(spark, d):
    return B.table(spark, d, "lineitem").filter(
        _IN_BATCH.format(t="TIMESTAMP_NTZ")).selectExpr(*BATCH_COLS)


_KEEP_SQL = f"""WITH stored AS ({_STORED_SQL}), batch AS ({_BATCH_SQL})
SELECT * FROM stored
WHERE NOT (day IN (SELECT day FROM batch WHERE day IS NOT NULL)
           AND item IN (SELECT item FROM batch WHERE item IS NOT NULL))"""


@query("delete_by_two_sets", sql=_KEEP_SQL)
def delete_by_two_sets(spark, d):
    """Drop stored rows whose day is in the batch's days AND whose item is
    in the batch's items (independent sets, K1; SQL three-valued logic)."""
    return U.delete_matching(stored_table(spark, d), batch_table(spark, d), ["day", "item"], "cross")


def web_totals(spark, d):
    """K2: the website feed pre-aggregated to (week, item) as total_* columns."""
    w = B.website(spark, d)
    return w.groupBy("week", "item").agg(*[F.sum(F.col(m).cast("decimal(18,2)")).cast("double").alias(f"total_{m}")
                                           for m in B.WEB_METRICS])


TOTALS = [f"total_{m}" for m in B.WEB_METRICS]
_WEB_TOTALS_SQL = f"""SELECT week, item, {', '.join(f'CAST(sum(CAST({m} AS DECIMAL(18,2))) AS DOUBLE) AS total_{m}' for m in B.WEB_METRICS)}
FROM ({B.website_sql()}) GROUP BY week, item"""


@query("key_spine", sql=f"""SELECT week, item FROM ({B.sales_sql()})
UNION SELECT week, item FROM ({B.website_sql()})""")
def key_spine(spark, d):
    """Distinct (week, item) pairs seen in sales or website."""
    return E.key_spine(B.sales(spark, d), B.website(spark, d), ["week", "item"])


DIST_SQL = f"""WITH sp AS (SELECT week, item FROM ({B.sales_sql()}) UNION SELECT week, item FROM ({B.website_sql()})),
f AS (SELECT sp.week, sp.item, s.store, s.day, s.order_key, s.line, CAST(s.sales AS DOUBLE) AS sales
      FROM sp LEFT JOIN ({B.sales_sql()}) s ON sp.week = s.week AND sp.item = s.item),
n AS (SELECT week, item, count(*) AS n FROM f GROUP BY week, item),
w AS ({_WEB_TOTALS_SQL})
SELECT f.*, {', '.join(f'CASE WHEN n.n > 0 THEN w.{t} / n.n ELSE w.{t} END AS {t}' for t in TOTALS)}
FROM f LEFT JOIN n ON f.week = n.week AND f.item = n.item
LEFT JOIN w ON f.week = w.week AND f.item = w.item"""


def distribution_sales(spark, d):
    return B.sales(spark, d).select("week", "item", "store", "day", "order_key", "line",
                                        F.col("sales").cast("double").alias("sales"))


def distributed(spark, d):
    return E.distribute_evenly(distribution_sales(spark, d), web_totals(spark, d), ["week", "item"], TOTALS)


@query("distribute_evenly", sql=DIST_SQL)
def distribute_evenly(spark, d):
    """Web totals spread evenly over the sales rows of each (week, item)."""
    return distributed(spark, d)
