"""Queries over stored layouts and kept results: facts by week (W2, A20),
bucketed joins (J1), ordered outputs (S15, O3), maintained sums (A2, C4) and
mergeable sketches (A6, A21). Each writes what it needs from the driver's tables
to the shared checkpoint folder and reads that."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from shelfwise.operators import enrich as E
from shelfwise.operators import maintained as M
from shelfwise.plans import bindings as B
from shelfwise.plans import sql_parts as Q
from shelfwise.plans.q_composite import _FILES_SQL, ORACLE_INGESTED
from shelfwise.plans.q_joins import LEFT_CATALOG_SQL
from shelfwise.plans.registry import query
from shelfwise.session import ensure_checkpoint_dir
from shelfwise.sources import layout as L
from shelfwise.sources import sinks as SK


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("latest_weeks_pruned", sql=f"""WITH s AS ({B.sales_sql()}),
w AS (SELECT DISTINCT {Q.week_year('week')} AS y, {Q.week_num('week')} AS n FROM s ORDER BY y DESC, n DESC LIMIT 4)
SELECT week, item % 10 AS shelf, CAST(sum(sales) AS DOUBLE) AS sales, CAST(sum(units) AS BIGINT) AS units, count(*) AS rows
FROM s JOIN w ON {Q.week_year('week')} = y AND {Q.week_num('week')} = n GROUP BY ALL""")
def latest_weeks_pruned(spark, d):
    """The last four weeks of a fact stored by week; which weeks those
    are is found at run time and prunes the fact's files."""
    path = _folder(spark, "weekly")
    L.write_weekly(B.sales(spark, d).select("week", "item", "sales", "units"), path)
    x = L.latest_weeks(spark, path, weeks=4)
    return x.groupBy("week", (F.col("item") % 10).alias("shelf")).agg(
        F.sum("sales").cast("double").alias("sales"), F.sum("units").cast("bigint").alias("units"), F.count("*").alias("rows"))


@query("join_bucketed", sql=LEFT_CATALOG_SQL)
def join_bucketed(spark, d):
    """J1 on tables bucketed by item: neither side is shuffled for the join."""
    tag, buckets = uuid.uuid4().hex, int(spark.conf.get("spark.sql.shuffle.partitions"))
    c = E.classification_clean(B.classification_feed(spark, d)).select("item", "dept", "class", "subclass")
    s = B.sales(spark, d).select("item", "store", "day", F.col("sales").cast("double").alias("sales"))
    c = L.write_bucketed(c, f"catalog_{tag}", _folder(spark, "catalog"), ["item"], buckets)
    s = L.write_bucketed(s, f"sales_{tag}", _folder(spark, "sales"), ["item"], buckets)
    return s.join(c, "item", "left")


@query("output_order", sql="""SELECT coalesce(nullif(trim(l_returnflag), ''), 'No_BU') AS label, count(*) AS rows,
  CAST(0 AS BIGINT) AS rows_out_of_order, CAST(0 AS BIGINT) AS files_out_of_order FROM lineitem GROUP BY 1""")
def output_order(spark, d):
    """A report written by label, rows sorted over all files of a label;
    the query counts what stands out of order."""
    path = _folder(spark, "report")
    SK.write_partitioned(B.table(spark, d, "lineitem").select("l_orderkey", "l_returnflag", "l_shipdate", "l_extendedprice"), path,
                         "l_returnflag", ["l_shipdate"])
    return SK.order_report(spark, path, "l_returnflag_label", "l_shipdate").drop("files")


@query("maintained_sums", sql=f"""WITH r AS ({_FILES_SQL}), {ORACLE_INGESTED}
SELECT year(day) AS year, month(day) AS month, CAST(coalesce(sum(CAST(qty AS DECIMAL(18,2))), 0) AS DOUBLE) AS qty,
  CAST(sum(line) AS DOUBLE) AS lines, count(*) AS row_count FROM ingested GROUP BY ALL""")
def maintained_sums(spark, d):
    """A2/C4: sums per month kept through four deliveries with overlaps, from
    the rows that each delivery removed and added."""
    r = B.table(spark, d, "lineitem").selectExpr(
        "l_orderkey AS order_key", "l_linenumber AS line", "cast(greatest(l_linenumber - 3, 0) AS int) AS n",
        "CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE l_shipdate END AS day",
        "CASE WHEN l_orderkey % 89 = 0 THEN NULL ELSE l_partkey END AS item", "l_quantity AS qty")
    table, sums = _folder(spark, "kept"), _folder(spark, "sums")
    group = {"year": F.year("day"), "month": F.month("day")}
    measures = {"qty": F.col("qty").cast("decimal(18,2)"), "lines": F.col("line").cast("long")}
    out = None
    for n in range(5):
        out = M.maintain(spark, table, sums, r.where(F.col("n") == n).drop("n"), ["day", "item"], group, measures)
    return out.select("year", "month", F.col("qty").cast("double").alias("qty"), F.col("lines").cast("double").alias("lines"), "row_count")


@query("sketched_distincts", sql="""SELECT 'l_orderkey' AS "column", count(*) AS rows, count(*) - count(l_orderkey) AS nulls, true AS within_bound FROM lineitem
UNION ALL SELECT 'l_partkey', count(*), count(*) - count(l_partkey), true FROM lineitem
UNION ALL SELECT 'l_shipdate', count(*), count(*) - count(l_shipdate), true FROM lineitem
UNION ALL SELECT 'l_returnflag', count(*), count(*) - count(l_returnflag), true FROM lineitem""")
def sketched_distincts(spark, d):
    """Distinct values from stored sketches of a table that grows by a
    delivery, within five standard errors of the exact number."""
    path, sketches = _folder(spark, "grown"), _folder(spark, "sketches")
    columns = ["l_orderkey", "l_partkey", "l_shipdate", "l_returnflag"]
    li = B.table(spark, d, "lineitem").select(*columns, "l_linenumber")
    li.where("l_linenumber <= 3").drop("l_linenumber").write.parquet(path)
    M.sketched_profile(spark, path, sketches)
    li.where("l_linenumber > 3").drop("l_linenumber").write.mode("append").parquet(path)
    got = M.sketched_profile(spark, path, sketches)
    exact = li.agg(*[F.count_distinct(c).alias(c) for c in columns])
    exact = exact.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("exact")) for c in columns])).alias("x")).select("x.*")
    off = F.abs(F.col("distinct_values") - F.col("exact")) <= 1 + 5 * 1.04 / 2 ** (M.LG_K / 2) * F.col("exact")
    return got.join(F.broadcast(exact), "column").select("column", "rows", "nulls", off.alias("within_bound"))
