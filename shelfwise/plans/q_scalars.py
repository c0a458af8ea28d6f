"""Scalar-function and filter queries.

Inputs are derived from the driver's tables with SQL expressions that both
Spark and DuckDB accept (so the raw values are identical); the function
under test is the Spark one from ``shelfwise.functions``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions import scalars as S
from shelfwise.operators import backlog as BL
from shelfwise.operators import schema as P
from shelfwise.plans import bindings as B
from shelfwise.plans import sql_parts as Q
from shelfwise.plans.registry import query


def _lz(d: str) -> str:
    """DuckDB form of 'strip leading zeros but keep one digit' (RE2 has no lookahead)."""
    return f"(CASE WHEN {d} = '' THEN '' WHEN ltrim({d}, '0') = '' THEN '0' ELSE ltrim({d}, '0') END)"


CLEAN_RAW = """CASE p_partkey % 4 WHEN 0 THEN ' ="' || p_name || '" ' WHEN 1 THEN '="' || p_brand || '"'
  WHEN 2 THEN NULL ELSE ' ''' || p_type || '''  ' END"""


@query("clean_text", sql=rf"""SELECT p_partkey, raw,
  regexp_replace(trim(raw), '^[\s="'']*|[\s"'']*$', '', 'g') AS cleaned
FROM (SELECT p_partkey, {CLEAN_RAW} AS raw FROM part)""")
def clean_text(spark, d):
    p = B.table(spark, d, "part").selectExpr("p_partkey", f"{CLEAN_RAW} AS raw")
    return p.select("p_partkey", "raw", S.clean_text("raw").alias("cleaned"))


UPC_RAW = """CASE p_partkey % 5 WHEN 0 THEN '="' || lpad(CAST(p_partkey AS STRING), 6, '0') || '"'
  WHEN 1 THEN NULL WHEN 2 THEN 'abc' WHEN 3 THEN '000'
  ELSE CASE WHEN p_size > 40 THEN '  ' ELSE ' ' || CAST(p_partkey AS STRING) END END"""
PLUS_RAW = "CASE WHEN p_size % 3 = 0 THEN NULL ELSE CAST(p_size AS STRING) END"


@query("full_upc", sql=rf"""SELECT p_partkey, upc_raw, plus_raw,
  CASE WHEN upc_raw IS NULL OR trim(upc_raw) = '' THEN NULL
       ELSE '0' || {_lz(r"regexp_replace(upc_raw, '\D', '', 'g')")}
                || coalesce({_lz(r"regexp_replace(plus_raw, '\D', '', 'g')")}, '') END AS full_upc
FROM (SELECT p_partkey, {UPC_RAW} AS upc_raw, {PLUS_RAW} AS plus_raw FROM part)""")
def full_upc(spark, d):
    p = B.table(spark, d, "part").selectExpr("p_partkey", f"{UPC_RAW} AS upc_raw", f"{PLUS_RAW} AS plus_raw")
    return p.select("p_partkey", "upc_raw", "plus_raw", S.full_upc("upc_raw", "plus_raw").alias("full_upc"))


UPCKEY_RAW = """CASE line % 3 WHEN 0 THEN '  00 ' || upc WHEN 1 THEN upc
  ELSE ' ' || substr(upc, 1, 5) || ' ' || substr(upc, 6) END"""


@query("clean_upc_key", sql=rf"""SELECT order_key, line, raw,
  regexp_replace(regexp_replace(raw, '^\s*0+', ''), '\s+', '', 'g') AS upc_key
FROM (SELECT order_key, line, {UPCKEY_RAW} AS raw FROM ({B.ITEM_STATUS_SQL}))""")
def clean_upc_key(spark, d):
    x = B.item_status(spark, d).selectExpr("order_key", "line", f"{UPCKEY_RAW} AS raw")
    return x.select("order_key", "line", "raw", S.clean_upc_key("raw").alias("upc_key"))


PZ_RAW = ["CASE WHEN l_linenumber = 2 THEN NULL ELSE CAST(l_quantity AS STRING) END AS qty_text",
          "CAST(l_discount AS STRING) AS disc_text"]


@query("strip_trailing_point_zero", sql=f"""SELECT l_orderkey, l_linenumber, qty_text, disc_text,
  {Q.strip_point_zero('qty_text')} AS qty_clean, {Q.strip_point_zero('disc_text')} AS disc_clean
FROM (SELECT l_orderkey, l_linenumber, {', '.join(PZ_RAW)} FROM lineitem)""")
def strip_trailing_point_zero(spark, d):
    x = B.table(spark, d, "lineitem").selectExpr("l_orderkey", "l_linenumber", *PZ_RAW)
    return x.select("l_orderkey", "l_linenumber", "qty_text", "disc_text",
                    S.strip_point_zero("qty_text").alias("qty_clean"),
                    S.strip_point_zero("disc_text").alias("disc_clean"))


CODE_RAW = ["CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE CAST(p_partkey AS STRING) END AS basic",
            "CAST(p_size AS STRING) AS dash",
            "CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_brand END AS mpg",
            "CASE WHEN p_partkey % 8 = 0 THEN '' ELSE p_type END AS ipg"]


@query("concat_codes", sql=f"""SELECT p_partkey, basic || '-' || dash AS basic_dash,
  CASE WHEN mpg || '-' || ipg IN ('-', '') THEN 'Unknown' ELSE mpg || '-' || ipg END AS mpg_ipg
FROM (SELECT p_partkey, {', '.join(CODE_RAW)} FROM part)""")
def concat_codes(spark, d):
    """F7 (null-propagating) and F8 (default 'Unknown')."""
    x = B.table(spark, d, "part").selectExpr("p_partkey", *CODE_RAW)
    return x.select("p_partkey", S.concat_code("basic", "dash").alias("basic_dash"),
                    S.concat_code_default("mpg", "ipg").alias("mpg_ipg"))


LABEL_RAW = """CASE doc_id % 5 WHEN 0 THEN source || '/a[b]:c' WHEN 1 THEN '   ' WHEN 2 THEN NULL
  WHEN 3 THEN repeat(source || '*', 8) ELSE ' ' || lang || '?' END"""


@query("safe_label", sql=rf"""SELECT doc_id, raw,
  CASE WHEN trim(v) = '' THEN 'No_BU' ELSE v END AS label
FROM (SELECT doc_id, raw,
        substring(trim(regexp_replace(coalesce(raw, ''), '[\\*?:/\[\]]', '_', 'g')), 1, 31) AS v
      FROM (SELECT doc_id, {LABEL_RAW} AS raw FROM documents))""")
def safe_label(spark, d):
    x = B.table(spark, d, "documents").selectExpr("doc_id", f"{LABEL_RAW} AS raw")
    return x.select("doc_id", "raw", S.safe_label("raw").alias("label"))


@query("filter_not_equal_keep_null", sql=f"""SELECT product_id, network FROM ({B.REVIEWS_SQL})
WHERE network IS DISTINCT FROM 'de'""")
def filter_not_equal_keep_null(spark, d):
    """Exclude one network value but keep rows whose network is null."""
    return BL.keep_unless_equal(B.reviews(spark, d), "network", "de").select("product_id", "network")


BOTH_RAW = ["CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_name END AS a",
            "CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_brand END AS b"]


@query("drop_both_null", sql=f"""SELECT p_partkey, a, b FROM (SELECT p_partkey, {', '.join(BOTH_RAW)} FROM part)
WHERE a IS NOT NULL OR b IS NOT NULL""")
def drop_both_null(spark, d):
    x = B.table(spark, d, "part").selectExpr("p_partkey", *BOTH_RAW)
    return P.drop_all_null(x, ["a", "b"])


def website_rates(spark, d):
    """The website feed as delivered: visits and conversion rates (float)."""
    w = B.website(spark, d)
    return w.select("day", "week", "item", "pip_visits", "pip_visits_ly",
                    (F.col("orders_ty") / S.nz(F.col("pip_visits"))).cast("float").alias("pip_conversion_rate"),
                    (F.col("orders_ly") / S.nz(F.col("pip_visits_ly"))).cast("float").alias("pip_conversion_rate_ly"))


WEBSITE_RATES_SQL = f"""SELECT day, week, item, pip_visits, pip_visits_ly,
  CAST(orders_ty / {Q.nz('pip_visits')} AS FLOAT) AS pip_conversion_rate,
  CAST(orders_ly / {Q.nz('pip_visits_ly')} AS FLOAT) AS pip_conversion_rate_ly
FROM ({B.website_sql()})"""

ORDER_COUNTS_SQL = f"""SELECT day, week, item, pip_visits, pip_visits_ly, pip_conversion_rate, pip_conversion_rate_ly,
  CAST(pip_visits * pip_conversion_rate AS FLOAT) AS order_count_ty,
  CAST(pip_visits_ly * pip_conversion_rate_ly AS FLOAT) AS order_count_ly
FROM ({WEBSITE_RATES_SQL})"""


@query("derived_order_counts", sql=ORDER_COUNTS_SQL)
def derived_order_counts(spark, d):
    """Order count TY/LY = visits * conversion rate, as float."""
    return P.derive_order_counts(website_rates(spark, d), {
        "order_count_ty": ("pip_visits", "pip_conversion_rate"),
        "order_count_ly": ("pip_visits_ly", "pip_conversion_rate_ly")})


@query("backfill_columns", sql=ORDER_COUNTS_SQL)
def backfill_columns(spark, d):
    """Derived columns are added only when absent; pip_visits exists and
    is left as it is."""
    return P.backfill(website_rates(spark, d), {
        "pip_visits": F.lit(-1.0),
        "order_count_ty": P.order_counts("pip_visits", "pip_conversion_rate"),
        "order_count_ly": P.order_counts("pip_visits_ly", "pip_conversion_rate_ly")})
