"""De-duplication, counting and roll-up queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import dedupe as D
from shelfwise.operators import dq as DQ
from shelfwise.plans import bindings as B
from shelfwise.plans.registry import query

LI_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus", "l_shipdate"]
_LI_ORDER_SQL = ", ".join(LI_ORDER)


@query("first_per_key", sql=f"""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LI_ORDER_SQL}) AS rn
  FROM lineitem) WHERE rn = 1""")
def first_per_key(spark, d):
    """A4: whole first row per (order, line) key, first by all other columns."""
    return D.first_per_key(B.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], LI_ORDER)


NN_RAW = ["NULLIF(l_returnflag, 'A') AS flag",
          "CASE WHEN l_quantity > 25 THEN l_shipdate END AS ship",
          "CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE l_partkey END AS part"]


@query("first_nonnull_per_key", sql=f"""SELECT l_orderkey, l_linenumber,
  first(flag ORDER BY {_LI_ORDER_SQL}) FILTER (WHERE flag IS NOT NULL) AS flag,
  first(ship ORDER BY {_LI_ORDER_SQL}) FILTER (WHERE ship IS NOT NULL) AS ship,
  first(part ORDER BY {_LI_ORDER_SQL}) FILTER (WHERE part IS NOT NULL) AS part
FROM (SELECT *, {', '.join(NN_RAW)} FROM lineitem) GROUP BY l_orderkey, l_linenumber""")
def first_nonnull_per_key(spark, d):
    """A5: per column the first non-null value per key (pandas groupby.first)."""
    x = B.table(spark, d, "lineitem").selectExpr("*", *NN_RAW)
    return D.first_nonnull_per_key(x, ["l_orderkey", "l_linenumber"], LI_ORDER, ["flag", "ship", "part"])


@query("duplicate_keys", sql=f"""SELECT upc, count(*) AS count FROM ({B.ITEM_STATUS_SQL})
GROUP BY upc HAVING count(*) > 1""")
def duplicate_keys(spark, d):
    return D.duplicate_keys(B.item_status(spark, d), ["upc"])


@query("distinct_tuple_count", sql="""SELECT count(*) AS distinct_count FROM (
  SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey, year(l_shipdate) FROM lineitem)""")
def distinct_tuple_count(spark, d):
    """Distinct (flag, status, supplier, year) tuples."""
    x = B.table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_suppkey",
                                             F.year("l_shipdate").alias("y"))
    return D.distinct_tuple_count(x, ["l_returnflag", "l_linestatus", "l_suppkey", "y"])


# One name that is not delivered, to show the "missing" report row.
ROW_COUNT_TABLES = [*B.TABLES, "calendar"]


@query("table_row_counts", sql=" UNION ALL ".join(
    [f"SELECT '{t}' AS table_name, count(*) AS row_count, 'ok' AS status FROM {t}" for t in B.TABLES]
    + ["SELECT 'calendar', CAST(NULL AS BIGINT), 'missing'"]))
def table_row_counts(spark, d):
    """Rows per table; a missing table is reported, not raised."""
    return DQ.table_row_counts(spark, {t: f"{d}/{t}.parquet" for t in ROW_COUNT_TABLES})


ROLL_RAW = ["CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_size = 50 THEN 'ALLNULL' ELSE p_type END AS grp",
            "CASE WHEN p_size % 7 = 0 OR p_size = 50 THEN NULL ELSE p_brand END AS brand"]
_ROLL_SRC = f"(SELECT * FROM (SELECT p_partkey, {', '.join(ROLL_RAW)} FROM part) WHERE grp IS NOT NULL)"


def _roll_src(spark, d):
    x = B.table(spark, d, "part").selectExpr("p_partkey", *ROLL_RAW)
    return x.dropna(subset=["grp"])     # pandas groupby drops null keys


@query("string_rollup", sql=f"""SELECT grp, coalesce(string_agg(brand, ', ' ORDER BY p_partkey), '') AS brand
FROM {_ROLL_SRC} GROUP BY grp""")
def string_rollup(spark, d):
    """A13: ', '-joined roll-up keeping duplicates, nulls dropped, empty -> ''."""
    return D.rollup_text(_roll_src(spark, d), ["grp"], {"brand": (", ", False)}, ["p_partkey"])


@query("string_rollup_unique", sql=f"""SELECT grp, coalesce(string_agg(brand, ', ' ORDER BY fo), '') AS brand
FROM (SELECT grp, brand, min(p_partkey) AS fo FROM {_ROLL_SRC} GROUP BY grp, brand) GROUP BY grp""")
def string_rollup_unique(spark, d):
    """Unique values in first-appearance order."""
    return D.rollup_text(_roll_src(spark, d), ["grp"], {"brand": (", ", True)}, ["p_partkey"])


_ORD = ", ".join(B.ITEM_ORDER)


@query("prefer_active_rollup", sql=rf"""WITH x AS (
  SELECT *, coalesce(regexp_replace(regexp_replace(upc, '^\s*0+', ''), '\s+', '', 'g'), 'nan') AS upc_key,
         coalesce(status IN ('R'), false) AS obs
  FROM ({B.ITEM_STATUS_SQL})),
a AS (SELECT upc_key, bool_and(obs) AS all_obs FROM x GROUP BY upc_key),
k AS (SELECT x.* FROM x JOIN a USING (upc_key) WHERE NOT obs OR all_obs)
SELECT upc_key AS upc,
  coalesce(string_agg(coalesce(status, 'nan'), ',' ORDER BY {_ORD}), '') AS status,
  coalesce(string_agg(coalesce(item_number, 'nan'), ',' ORDER BY {_ORD}), '') AS item_number
FROM k GROUP BY upc_key""")
def prefer_active_rollup(spark, d):
    """C9 with return flag 'R' as the obsolete status."""
    return D.prefer_active_rollup(B.item_status(spark, d), "upc", "status", "item_number",
                                  B.ITEM_ORDER, obsolete=["R"])
