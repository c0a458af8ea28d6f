"""Bind the driver's TPC-H-like tables to the retail feed shapes the
operators work on (SURVEY 7.3). Each binding exists twice: as a Spark
DataFrame builder and as a DuckDB SQL fragment with the same expressions, so
the oracle compares like with like.

Money columns are bound as DECIMAL so sums are exact in both engines; they
are cast to DOUBLE only on output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions import scalars as S

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _week_sql(day: str) -> str:
    return (f"('Fiscal Week ' || CAST((dayofyear({day}) - 1) // 7 + 1 AS VARCHAR) || ' of ' "
            f"|| CAST(year({day}) AS VARCHAR))")


# ---------------------------------------------------------------- sales fact
def sales(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem")
    units = F.col("l_quantity").cast("int")
    sales_amt = F.col("l_extendedprice").cast("decimal(18,2)")
    return li.select(
        F.col("l_partkey").alias("item"),
        F.col("l_suppkey").alias("store"),
        F.col("l_shipdate").alias("day"),
        S.fiscal_week_label(F.col("l_shipdate")).alias("week"),
        F.col("l_linestatus").alias("channel"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line"),
        units.alias("units"),
        F.when(F.col("l_linenumber") == 1, F.lit(0)).otherwise(units).alias("units_ly"),
        sales_amt.alias("sales"),
        (sales_amt * (F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)")))
        .alias("sales_ly"),
        F.when((F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 3), F.lit(None).cast("decimal(18,2)"))
         .when(F.col("l_returnflag") == "R", sales_amt)
         .otherwise(F.lit(0).cast("decimal(18,2)")).alias("return_amt"),
        F.when((F.col("l_linestatus") == "O") & (F.col("l_linenumber") == 2), F.lit(None).cast("int"))
         .when((F.col("l_linestatus") == "F") & (F.col("l_linenumber") % 4 == 0), units)
         .otherwise(F.lit(0)).alias("cancel_units"),
    )


def sales_sql() -> str:
    return f"""SELECT l_partkey AS item, l_suppkey AS store, l_shipdate AS day,
  {_week_sql('l_shipdate')} AS week, l_linestatus AS channel, l_orderkey AS order_key,
  l_linenumber AS line, CAST(l_quantity AS INTEGER) AS units,
  CASE WHEN l_linenumber = 1 THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS units_ly,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS sales,
  CAST(l_extendedprice AS DECIMAL(18,2)) * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))) AS sales_ly,
  CASE WHEN l_returnflag = 'A' AND l_linenumber = 3 THEN NULL WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END AS return_amt,
  CASE WHEN l_linestatus = 'O' AND l_linenumber = 2 THEN NULL WHEN l_linestatus = 'F' AND l_linenumber % 4 = 0 THEN CAST(l_quantity AS INTEGER) ELSE 0 END AS cancel_units
FROM lineitem"""


# ------------------------------------------------------------ website feed
# One row per (day, item): counts and sums of events stand in for web metrics,
# as SQL text that both engines accept. The first 17 are those that the wide
# fact distributes; a user stands for an item, so items grow with the data.
def _count(cond: str) -> str:
    return f"count_if({cond})"


def _sum(cond: str) -> str:
    return f"coalesce(sum(CASE WHEN {cond} THEN value END), 0)"


WEBSITE = {
    "product_interaction_conversion": _sum("event_type = 'purchase'"),
    "product_interaction_conversion_ly": _sum("event_type = 'signup'"),
    "pip_conversion_rate": _sum("event_type = 'purchase' AND value >= 50"),
    "pip_conversion_rate_ly": _sum("event_type = 'signup' AND value >= 50"),
    "display_avg_rating": _count("event_type = 'error'"),
    **{f"display_{k}_star_reviews": _count(f"event_type = 'purchase' AND event_id % 5 = {k - 1}") for k in range(1, 6)},
    "non_buyable_views": _count("event_type = 'view' AND value < 20"),
    "non_buyable_views_ly": _count("event_type = 'click' AND value < 20"),
    "current_cost": "sum(value)",
    "pip_visits": _count("event_type = 'view'"),
    "pip_visits_ly": _count("event_type = 'click'"),
    "product_interaction_visits": _count("event_type = 'view' AND value >= 20"),
    "product_interaction_visits_ly": _count("event_type = 'click' AND value >= 20"),
    "orders_ty": _count("event_type = 'purchase'"),
    "orders_ly": _count("event_type = 'signup'"),
}
WEB_METRICS = list(WEBSITE)[:17]


def website(spark, d) -> DataFrame:
    ev = table(spark, d, "events")
    # wall-clock day of a timestamp_ntz (a date round trip; date_trunc would
    # return a session-time-zone timestamp)
    day = (F.col("ts") - F.expr("INTERVAL 26 YEARS")).cast("date").cast("timestamp_ntz")
    g = (ev.select(day.alias("day"), F.col("user_id").alias("item"), "event_id",
                   "event_type", F.col("value").cast("decimal(18,2)").alias("value"))
         .groupBy("day", "item")
         .agg(*[F.expr(e).alias(m) for m, e in WEBSITE.items()]))
    return g.select("day", S.fiscal_week_label(F.col("day")).alias("week"), "item",
                    *[F.col(m).cast("double").alias(m) for m in WEBSITE])


def website_sql() -> str:
    return f"""SELECT day, {_week_sql('day')} AS week, item,
  {', '.join(f'CAST({m} AS DOUBLE) AS {m}' for m in WEBSITE)}
FROM (SELECT day, item, {', '.join(f'{e} AS {m}' for m, e in WEBSITE.items())}
      FROM (SELECT date_trunc('day', ts - INTERVAL 26 YEARS) AS day, user_id AS item, event_id, event_type,
              CAST(value AS DECIMAL(18,2)) AS value FROM events)
      GROUP BY 1, 2)"""


# ------------------------------------------------------ classification feed
# Two deliveries of the catalogue (file 1 = all parts, file 2 = a re-send of
# every 4th part with another subclass) so "first per item" has work to do.
# Some codes are 11 chars long and must be filtered by the 12-char rule.
def classification_feed(spark, d) -> DataFrame:
    p = table(spark, d, "part")
    upc = F.when(F.col("p_partkey") % 9 == 0,
                 F.concat(F.lpad(F.col("p_partkey").cast("string"), 10, "0"),
                          (F.col("p_size") % 10).cast("string"))) \
        .otherwise(F.concat(F.lpad(F.col("p_partkey").cast("string"), 11, "0"),
                            (F.col("p_size") % 10).cast("string")))
    base = p.select(
        F.col("p_partkey").alias("item"), F.col("p_type").alias("dept"),
        F.col("p_brand").alias("class"), F.col("p_name").alias("subclass"),
        F.when(F.col("p_size") % 3 == 0, F.lit("Online only")).otherwise(F.lit("Shared"))
         .alias("classification"),
        F.when(F.col("p_size") % 4 == 0, F.lit("YOW")).otherwise(F.lit("Vendor")).alias("ship_from"),
        upc.alias("upc"), F.lit(1).alias("file_no"), F.col("p_partkey").alias("row_no"))
    resend = (p.filter(F.col("p_partkey") % 4 == 0)
              .select(F.col("p_partkey").alias("item"), F.col("p_type").alias("dept"),
                      F.col("p_brand").alias("class"),
                      F.concat(F.col("p_name"), F.lit(" v2")).alias("subclass"),
                      F.lit("Shared").alias("classification"), F.lit("Vendor").alias("ship_from"),
                      F.concat(F.lpad(F.col("p_partkey").cast("string"), 11, "0"), F.lit("9")).alias("upc"),
                      F.lit(2).alias("file_no"), F.col("p_partkey").alias("row_no")))
    return base.unionByName(resend)


CLASSIFICATION_FEED_SQL = """SELECT p_partkey AS item, p_type AS dept, p_brand AS class, p_name AS subclass,
  CASE WHEN p_size % 3 = 0 THEN 'Online only' ELSE 'Shared' END AS classification,
  CASE WHEN p_size % 4 = 0 THEN 'YOW' ELSE 'Vendor' END AS ship_from,
  CASE WHEN p_partkey % 9 = 0 THEN lpad(CAST(p_partkey AS VARCHAR), 10, '0') || CAST(p_size % 10 AS VARCHAR)
       ELSE lpad(CAST(p_partkey AS VARCHAR), 11, '0') || CAST(p_size % 10 AS VARCHAR) END AS upc,
  1 AS file_no, p_partkey AS row_no
FROM part
UNION ALL
SELECT p_partkey, p_type, p_brand, p_name || ' v2', 'Shared', 'Vendor',
  lpad(CAST(p_partkey AS VARCHAR), 11, '0') || '9', 2, p_partkey
FROM part WHERE p_partkey % 4 = 0"""


# ------------------------------------------------------------ FG status feed
# Finished-goods status: UPC = the 11-char code (of parts up to size 10 one
# that no catalogue code starts with, so those items find no status), and
# for every 5th part a second UPC with the same 11 chars plus 'X' (prefix
# fan-out case, K13).
def fg_feed(spark, d) -> DataFrame:
    p = table(spark, d, "part")
    key11 = F.lpad(F.col("p_partkey").cast("string"), 11, F.when(F.col("p_size") > 10, "0").otherwise("9"))
    one = p.select(key11.alias("upc"),
                   F.col("p_brand").alias("mpg"), F.col("p_type").alias("ipg"),
                   F.concat(F.lit("BU"), (F.col("p_partkey") % 7).cast("string")).alias("bu"),
                   F.col("p_partkey").cast("string").alias("basic"),
                   (F.col("p_size") % 10).cast("string").alias("dash"),
                   F.lit(1).alias("file_no"), F.col("p_partkey").alias("row_no"))
    two = (p.filter(F.col("p_partkey") % 5 == 0)
           .select(F.concat(key11, F.lit("X")).alias("upc"),
                   F.col("p_brand").alias("mpg"), F.lit("").alias("ipg"),
                   F.lit("").alias("bu"), F.col("p_partkey").cast("string").alias("basic"),
                   F.lit("X").alias("dash"), F.lit(2).alias("file_no"),
                   F.col("p_partkey").alias("row_no")))
    return one.unionByName(two)


_KEY11 = "lpad(CAST(p_partkey AS VARCHAR), 11, CASE WHEN p_size > 10 THEN '0' ELSE '9' END)"
FG_FEED_SQL = f"""SELECT {_KEY11} AS upc,
  p_brand AS mpg, p_type AS ipg, 'BU' || CAST(p_partkey % 7 AS VARCHAR) AS bu,
  CAST(p_partkey AS VARCHAR) AS basic, CAST(p_size % 10 AS VARCHAR) AS dash, 1 AS file_no, p_partkey AS row_no
FROM part
UNION ALL
SELECT {_KEY11} || 'X', p_brand, '', '', CAST(p_partkey AS VARCHAR), 'X', 2, p_partkey
FROM part WHERE p_partkey % 5 = 0"""


# ------------------------------------------------------------------- stores
def stores(spark, d) -> DataFrame:
    s, n, r = table(spark, d, "supplier"), table(spark, d, "nation"), table(spark, d, "region")
    return (s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select(F.col("s_suppkey").alias("store"), F.col("s_name").alias("store_name"),
                    F.col("n_name").alias("market"), F.col("r_name").alias("region")))


STORES_SQL = """SELECT s_suppkey AS store, s_name AS store_name, n_name AS market, r_name AS region
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


# --------------------------------------------------- weekly inventory snapshots
def snapshot(spark, d, year: int) -> DataFrame:
    first, after = (F.lit(f"{y}-01-01").cast("timestamp_ntz") for y in (year, year + 1))
    li = table(spark, d, "lineitem").filter((F.col("l_shipdate") >= first) & (F.col("l_shipdate") < after))
    off = F.col("l_partkey") % 7 == 0
    dc = F.when(F.col("l_suppkey") % 13 == 0, F.lit(None).cast("string")) \
        .otherwise(F.concat(F.lit("DC"), (F.col("l_suppkey") % 4).cast("string"), F.lit("-EAST")))
    oh = F.col("l_quantity")
    if year == 1998:
        oh = F.when(F.col("l_partkey") % 14 == 0, F.lit(0.0)).otherwise(oh)
    return li.select(
        F.col("l_partkey").alias("omsid"), dc.alias("dc"),
        F.when(off, F.lit("OFF")).when(F.col("l_returnflag") == "N", F.lit("ON"))
         .otherwise(F.lit("OFF")).alias("ntwk_replen"),
        F.when(off, F.lit("OFF")).when(F.col("l_linestatus") == "O", F.lit("ON"))
         .otherwise(F.lit("OFF")).alias("dc_replen"),
        oh.alias("oh_qty"),
        F.when(F.col("l_linenumber") == 3, F.lit(None).cast("double"))
         .otherwise(F.col("l_tax") * 100).alias("oo_qty"),
        F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line"))


def snapshot_sql(year: int) -> str:
    oh = "CASE WHEN l_partkey % 14 = 0 THEN 0.0 ELSE l_quantity END" if year == 1998 else "l_quantity"
    return f"""SELECT l_partkey AS omsid,
  CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE 'DC' || CAST(l_suppkey % 4 AS VARCHAR) || '-EAST' END AS dc,
  CASE WHEN l_partkey % 7 = 0 THEN 'OFF' WHEN l_returnflag = 'N' THEN 'ON' ELSE 'OFF' END AS ntwk_replen,
  CASE WHEN l_partkey % 7 = 0 THEN 'OFF' WHEN l_linestatus = 'O' THEN 'ON' ELSE 'OFF' END AS dc_replen,
  {oh} AS oh_qty,
  CASE WHEN l_linenumber = 3 THEN NULL ELSE l_tax * 100 END AS oo_qty,
  l_orderkey AS order_key, l_linenumber AS line
FROM lineitem WHERE year(l_shipdate) = {year}"""


# ------------------------------------------------------------------ reviews
def reviews(spark, d) -> DataFrame:
    doc = table(spark, d, "documents")
    k = F.col("doc_id")
    return doc.select(
        F.nullif(F.col("lang"), F.lit("es")).alias("network"),
        k.cast("string").alias("product_id"),
        F.concat(F.lpad(((k * 7) % 2000).cast("string"), 11, "0"), (k % 10).cast("string")).alias("upc"),
        F.when(k % 17 == 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'") + F.make_interval(days=(k % 60).cast("int")))
         .alias("review_date"),
        F.when(k % 23 == 0, F.lit(None).cast("int")).otherwise((k % 5 + 1).cast("int")).alias("rating"),
        F.col("source").alias("src"),
        F.col("n_chars").alias("n_chars"))


REVIEWS_SQL = """SELECT NULLIF(lang, 'es') AS network, CAST(doc_id AS VARCHAR) AS product_id,
  lpad(CAST((doc_id * 7) % 2000 AS VARCHAR), 11, '0') || CAST(doc_id % 10 AS VARCHAR) AS upc,
  CASE WHEN doc_id % 17 = 0 THEN NULL ELSE TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(doc_id % 60 AS INTEGER)) END AS review_date,
  CASE WHEN doc_id % 23 = 0 THEN NULL ELSE CAST(doc_id % 5 + 1 AS INTEGER) END AS rating,
  source AS src, n_chars
FROM documents"""


# ---------------------------------------------------------------- questions
def questions(spark, d) -> DataFrame:
    cv = table(spark, d, "conversations").filter(F.col("role") == "user")
    k = F.col("conv_id") * 10 + F.col("turn")
    return cv.select(
        F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("product_id"),
        F.concat(F.lpad(((F.col("conv_id") * 13) % 2000).cast("string"), 11, "0"),
                 (F.col("turn") % 10).cast("string")).alias("upc"),
        F.when(k % 17 == 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'") + F.make_interval(days=(k % 60).cast("int")))
         .alias("question_date"),
        F.length("text").alias("text_len"))


QUESTIONS_SQL = """SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS product_id,
  lpad(CAST((conv_id * 13) % 2000 AS VARCHAR), 11, '0') || CAST(turn % 10 AS VARCHAR) AS upc,
  CASE WHEN (conv_id * 10 + turn) % 17 = 0 THEN NULL
       ELSE TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST((conv_id * 10 + turn) % 60 AS INTEGER)) END AS question_date,
  length(text) AS text_len
FROM conversations WHERE role = 'user'"""


# ------------------------------------------------------------------- quotes
def quotes(spark, d) -> DataFrame:
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    return (o.join(c, o.o_custkey == c.c_custkey)
            .select(F.col("c_nationkey").alias("store"),
                    F.when(F.col("o_orderkey") % 13 == 0, F.lit("n/a"))
                     .otherwise(F.concat(F.col("o_totalprice").cast("string"), F.lit("7"))).alias("quote_total_text"),   # three decimals
                    F.col("o_orderdate").alias("quote_date"),
                    F.col("c_mktsegment").alias("state"),
                    F.col("o_orderkey").alias("order_no"),
                    F.col("o_orderpriority").alias("priority")))


QUOTES_SQL = """SELECT c_nationkey AS store,
  CASE WHEN o_orderkey % 13 = 0 THEN 'n/a' ELSE CAST(o_totalprice AS VARCHAR) || '7' END AS quote_total_text,
  o_orderdate AS quote_date, c_mktsegment AS state, o_orderkey AS order_no, o_orderpriority AS priority
FROM orders JOIN customer ON o_custkey = c_custkey"""


def territory(spark, d) -> DataFrame:
    """Store -> owner (DSR) list. Store 24 is listed under another number, so
    its quotes get no owner."""
    n = table(spark, d, "nation")
    return n.select(F.when(F.col("n_nationkey") == 24, -24).otherwise(F.col("n_nationkey")).cast("bigint").alias("store_no"),
                    F.concat(F.lit("DSR-"), (F.col("n_regionkey")).cast("string")).alias("owner"))


TERRITORY_SQL = """SELECT CASE WHEN n_nationkey = 24 THEN -24 ELSE n_nationkey END AS store_no, 'DSR-' || CAST(n_regionkey AS VARCHAR) AS owner
FROM nation"""


def scorecard(spark, d) -> DataFrame:
    p = table(spark, d, "part")
    return p.select(F.col("p_partkey").alias("item"), (F.col("p_retailprice") / 10).alias("total_score"),
                    F.col("p_brand").alias("class_band"),
                    F.concat(F.lit("V"), (F.col("p_partkey") % 17).cast("string")).alias("vendor_name"))


SCORECARD_SQL = """SELECT p_partkey AS item, p_retailprice / 10 AS total_score, p_brand AS class_band,
  'V' || CAST(p_partkey % 17 AS VARCHAR) AS vendor_name FROM part"""


# ------------------------------------------------------------ item statuses
def item_status(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.select(
        F.concat(F.lpad(F.col("l_orderkey").cast("string"), 11, "0"),
                 F.col("l_linenumber").cast("string")).alias("upc"),
        F.col("l_returnflag").alias("status"),
        F.col("l_partkey").cast("string").alias("item_number"),
        F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"),
        F.col("l_quantity").alias("qty"), F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("disc"), F.col("l_tax").alias("tax"),
        F.col("l_linestatus").alias("lstatus"), F.col("l_shipdate").alias("ship"))


# a total order inside one code (all remaining lineitem columns)
ITEM_ORDER = ["part", "supp", "qty", "price", "disc", "tax", "status", "lstatus", "ship"]

ITEM_STATUS_SQL = """SELECT lpad(CAST(l_orderkey AS VARCHAR), 11, '0') || CAST(l_linenumber AS VARCHAR) AS upc,
  l_returnflag AS status, CAST(l_partkey AS VARCHAR) AS item_number,
  l_orderkey AS order_key, l_linenumber AS line, l_partkey AS part, l_suppkey AS supp,
  l_quantity AS qty, l_extendedprice AS price, l_discount AS disc, l_tax AS tax,
  l_linestatus AS lstatus, l_shipdate AS ship
FROM lineitem"""
