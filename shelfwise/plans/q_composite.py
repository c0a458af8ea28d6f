"""Composite jobs: catalogue merge (C2), FG grouping (C7), review and
question backlogs (C5, C6), quotes (C11), upsert (C1, A22), wide fact (C3),
snapshot diff (C8), data-quality report (C13) and profile (C12)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from shelfwise.functions import scalars as S
from shelfwise.operators import backlog as BL
from shelfwise.operators import diff as DF
from shelfwise.operators import dq as DQ
from shelfwise.operators import enrich as E
from shelfwise.operators import jobs as JB
from shelfwise.operators import quotes as QT
from shelfwise.operators import upsert as U
from shelfwise.plans import bindings as B
from shelfwise.plans import q_joins as J
from shelfwise.plans import sql_parts as Q
from shelfwise.plans.registry import query

# ------------------------------------------------------------------ C2 / C7
_FG_CLEAN_SQL = f"""SELECT * EXCLUDE (rn), basic || '-' || dash AS basic_dash FROM (
  SELECT *, row_number() OVER (PARTITION BY upc ORDER BY file_no, row_no) AS rn FROM ({B.FG_FEED_SQL}))
WHERE rn = 1"""


@query("classification_clean", sql=f"SELECT * FROM ({Q.CLASSIFICATION_CLEAN})")
def classification_clean(spark, d):
    """C2 step 1: 12-char codes only, first row per item."""
    return E.classification_clean(B.classification_feed(spark, d))


@query("merged_classification", sql=f"""SELECT * EXCLUDE (rn) FROM (
  SELECT c.*, f.upc AS fg_upc, f.mpg, f.ipg, f.bu, f.basic_dash,
         row_number() OVER (PARTITION BY c.item ORDER BY c.file_no, c.row_no, f.upc) AS rn
  FROM ({Q.CLASSIFICATION_CLEAN}) c LEFT JOIN ({_FG_CLEAN_SQL}) f ON substring(c.upc, 1, 11) = f.upc)
WHERE rn = 1""")
def merged_classification(spark, d):
    """Catalogue + FG status columns, one row per item."""
    c = E.classification_clean(B.classification_feed(spark, d))
    fg = E.fg_status_clean(B.fg_feed(spark, d))
    return E.merged_classification(c, fg)


def _f4(c):
    return Q.strip_point_zero(c)


FG_GROUPED_SQL = f"""SELECT upc, mpg, ipg, bu, basic, dash,
  CASE WHEN mpg || '-' || ipg IN ('-', '') THEN 'Unknown' ELSE mpg || '-' || ipg END AS mpg_ipg,
  basic || '-' || dash AS basic_dash
FROM (SELECT upc, {', '.join(f"first({c} ORDER BY file_no, row_no) AS {c}" for c in ['mpg', 'ipg', 'bu', 'basic', 'dash'])}
      FROM (SELECT {_f4('upc')} AS upc, {', '.join(f"{_f4(c)} AS {c}" for c in ['mpg', 'ipg', 'bu', 'basic', 'dash'])},
                   file_no, row_no FROM ({B.FG_FEED_SQL}))
      GROUP BY upc)"""


@query("fg_grouped", sql=FG_GROUPED_SQL)
def fg_grouped(spark, d):
    """FG status grouped to one row per UPC with MPG_IPG and Basic_Dash."""
    return E.fg_grouped(B.fg_feed(spark, d))


# ------------------------------------------------------------------ C5 / C6
def reviews_enriched_df(spark, d):
    return JB.reviews(B.reviews(spark, d), E.fg_grouped(B.fg_feed(spark, d)), ("network", "de")).select(
        "network", "product_id", "upc", "review_date", "rating", "mpg", "ipg", "bu", "mpg_ipg", "basic_dash")


_ENRICH_COLS = ["mpg", "ipg", "bu", "mpg_ipg", "basic_dash"]
REVIEWS_ENRICHED_SQL = f"""SELECT r.network, r.product_id, r.upc, r.review_date, r.rating,
  {', '.join(f"{_f4('f.' + c)} AS {c}" for c in _ENRICH_COLS)}
FROM (SELECT {_f4('network')} AS network, {_f4('product_id')} AS product_id, {_f4('upc')} AS upc,
             review_date, rating FROM ({B.REVIEWS_SQL}) WHERE network IS DISTINCT FROM 'de') r
LEFT JOIN ({FG_GROUPED_SQL}) f ON substring(r.upc, 1, 11) = substring(f.upc, 1, 11)"""


@query("reviews_enriched", sql=REVIEWS_ENRICHED_SQL)
def reviews_enriched(spark, d):
    """Reviews without the excluded network (nulls kept), joined to FG on
    the 11-char UPC prefix (can fan out, K13)."""
    return reviews_enriched_df(spark, d)


_AS_OF_SQL = f"TIMESTAMP '{Q.AS_OF}'"


def _backlog_sql(src: str, date: str, rating: bool, keep_blank: bool, fmt: str) -> str:
    low = ", count(*) FILTER (WHERE rating IN (1, 2, 3)) AS low_rating_count" if rating else ""
    label = "CASE WHEN trim(bu) = '' THEN 'No BU' ELSE bu END" if keep_blank else "bu"
    where = "" if keep_blank else "WHERE trim(bu) <> ''"
    return f"""SELECT {label} AS bu, count, oldest_date, old_count, row_count{', low_rating_count' if rating else ''},
  coalesce(strftime(oldest_date, '{fmt}'), 'No Date') AS oldest_date_str
FROM (SELECT coalesce(CAST(bu AS VARCHAR), '') AS bu, count({date}) AS count, min({date}) AS oldest_date,
        count(*) FILTER (WHERE {date} < {_AS_OF_SQL} - INTERVAL 14 DAY) AS old_count,
        count(*) AS row_count{low}
      FROM ({src}) GROUP BY 1) {where}"""


@query("review_backlog", sql=_backlog_sql(REVIEWS_ENRICHED_SQL, "review_date", True, False, "%Y-%m-%d"))
def review_backlog(spark, d):
    """A11 for reviews: per BU dated count, oldest, older than 14 days, ratings 1-3."""
    return BL.backlog(reviews_enriched_df(spark, d), "bu", "review_date", Q.AS_OF, rating="rating")


@query("low_rating_count", sql=f"""SELECT count(*) FILTER (WHERE rating IN (1, 2, 3)) AS low_rating_count
FROM ({REVIEWS_ENRICHED_SQL})""")
def low_rating_count(spark, d):
    return BL.low_rating_count(reviews_enriched_df(spark, d))


def questions_enriched_df(spark, d):
    return JB.questions(B.questions(spark, d), E.fg_grouped(B.fg_feed(spark, d))).select(
        "product_id", "upc", "question_date", "mpg", "ipg", "bu", "mpg_ipg", "basic_dash")


QUESTIONS_ENRICHED_SQL = f"""SELECT q.product_id, q.upc, q.question_date,
  {', '.join(f"{_f4('f.' + c)} AS {c}" for c in _ENRICH_COLS)}
FROM (SELECT {_f4('product_id')} AS product_id, {_f4('upc')} AS upc, question_date FROM ({B.QUESTIONS_SQL})) q
LEFT JOIN ({FG_GROUPED_SQL}) f ON substring(q.upc, 1, 11) = substring(f.upc, 1, 11)"""


@query("questions_enriched", sql=QUESTIONS_ENRICHED_SQL)
def questions_enriched(spark, d):
    """Questions joined to FG on the 11-char UPC prefix."""
    return questions_enriched_df(spark, d)


@query("question_backlog", sql=_backlog_sql(QUESTIONS_ENRICHED_SQL, "question_date", False, True,
                                             "%Y-%m-%d %H:%M:%S"))
def question_backlog(spark, d):
    """A11 for questions, in the variant form: blank BUs kept as 'No BU' and
    the oldest date printed with its time."""
    return BL.backlog(questions_enriched_df(spark, d), "bu", "question_date", Q.AS_OF,
                      keep_blank_bu=True, date_format="yyyy-MM-dd HH:mm:ss")


# ---------------------------------------------------------------------- C11
def quotes_above_df(spark, d):
    return QT.quotes_above(B.quotes(spark, d), B.territory(spark, d), QT.QUOTE_THRESHOLD)


QUOTES_ABOVE_SQL = f"""SELECT q.*, t.owner, TRY_CAST(q.quote_total_text AS DOUBLE) AS quote_total
FROM ({B.QUOTES_SQL}) q LEFT JOIN ({B.TERRITORY_SQL}) t ON q.store IS NOT DISTINCT FROM t.store_no
WHERE TRY_CAST(q.quote_total_text AS DOUBLE) > 15000"""


@query("quotes_above", sql=QUOTES_ABOVE_SQL)
def quotes_above(spark, d):
    return quotes_above_df(spark, d)


_PIVOT_KEYS = ["owner", "quote_date", "store", "state", "order_no"]


@query("quote_pivot_mean", sql=f"""SELECT {', '.join(_PIVOT_KEYS)},
  round(avg(quote_total), 6) AS quote_total
FROM ({QUOTES_ABOVE_SQL}) WHERE {' AND '.join(f'{k} IS NOT NULL' for k in _PIVOT_KEYS)}
GROUP BY {', '.join(_PIVOT_KEYS)}""")
def quote_pivot_mean(spark, d):
    # rounded for the comparison only: the oracle adds doubles
    return QT.pivot_mean(quotes_above_df(spark, d), _PIVOT_KEYS).withColumn("quote_total", F.round("quote_total", 6))


@query("owner_summary", sql=f"""SELECT owner, count(DISTINCT order_no) AS unique_orders,
  round(avg(quote_total), 6) AS avg_quote_total
FROM ({QUOTES_ABOVE_SQL}) WHERE owner IS NOT NULL GROUP BY owner""")
def owner_summary(spark, d):
    return QT.owner_summary(quotes_above_df(spark, d)).withColumn("avg_quote_total", F.round("avg_quote_total", 6))


# ----------------------------------------------------------------------- C1
_STORED, _BATCH = J._STORED_SQL, J._BATCH_SQL

# Files that arrive one after another: the stored table is file 0, the line
# numbers above 3 are files 1 to 4.
_FILES_SQL = """SELECT l_orderkey AS order_key, l_linenumber AS line, greatest(l_linenumber - 3, 0) AS n,
  CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE l_shipdate END AS day,
  CASE WHEN l_orderkey % 89 = 0 THEN NULL ELSE l_partkey END AS item, l_quantity AS qty FROM lineitem"""


ORACLE_INGESTED = """d AS (SELECT DISTINCT n, day FROM r WHERE n > 0 AND day IS NOT NULL),
i AS (SELECT DISTINCT n, item FROM r WHERE n > 0 AND item IS NOT NULL),
ingested AS (SELECT * FROM r WHERE NOT EXISTS (
  SELECT 1 FROM (SELECT DISTINCT n FROM r WHERE n > 0) f WHERE f.n > r.n
    AND (r.day IS NULL OR EXISTS (SELECT 1 FROM d WHERE d.n = f.n AND d.day = r.day))
    AND (r.item IS NULL OR EXISTS (SELECT 1 FROM i WHERE i.n = f.n AND i.item = r.item))))"""


@query("ingest_multi_file", sql=f"WITH r AS ({_FILES_SQL}), {ORACLE_INGESTED} SELECT * FROM ingested")
def ingest_multi_file(spark, d):
    """Several delivered files applied one after another; a row goes
    when a later file holds its day and its item (a null key counts as held)."""
    r = B.table(spark, d, "lineitem").selectExpr(
        "l_orderkey AS order_key", "l_linenumber AS line", "cast(greatest(l_linenumber - 3, 0) AS int) AS n",
        "CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE l_shipdate END AS day",
        "CASE WHEN l_orderkey % 89 = 0 THEN NULL ELSE l_partkey END AS item", "l_quantity AS qty")
    stored, files = r.where("n = 0").drop("n"), r.where("n > 0")
    return U.merge_numbered(stored, files, ["day", "item"], "n").where("_gone IS NULL").drop("_gone")
_KEEP_ROWS = f"""SELECT * FROM ({_STORED}) s
WHERE NOT (day IN (SELECT day FROM ({_BATCH}) WHERE day IS NOT NULL)
           AND item IN (SELECT item FROM ({_BATCH}) WHERE item IS NOT NULL))"""
_CONFORMED_BATCH = f"""SELECT order_key, line, day, item, CAST(qty AS DOUBLE) AS qty, sales FROM ({_BATCH})"""


@query("upsert_merge", sql=f"{_KEEP_ROWS} UNION ALL {_CONFORMED_BATCH}")
def upsert_merge(spark, d):
    """Stored rows minus the two-set delete, plus the batch cast to the
    stored schema."""
    merged, _ = U.upsert(J.stored_table(spark, d), J.batch_table(spark, d), ["day", "item"])
    return merged


# Explicit delete conditions (the CLI form): parameters, not data.
COND_DAYS = [dt.datetime(1998, 1, 2) + dt.timedelta(days=i) for i in range(14)]
COND_ITEMS = list(range(0, 1000))


@query("upsert_conditions", sql=f"""SELECT * FROM ({_STORED})
WHERE NOT (day IN ({', '.join(f"TIMESTAMP '{x:%Y-%m-%d %H:%M:%S}'" for x in COND_DAYS)})
           AND item IN ({', '.join(map(str, COND_ITEMS))}))
UNION ALL {_CONFORMED_BATCH}""")
def upsert_conditions(spark, d):
    """C1 with explicit conditions on the allowed key columns."""
    merged, _ = U.upsert(J.stored_table(spark, d), J.batch_table(spark, d), ["day", "item"],
                         conditions={"day": COND_DAYS, "item": COND_ITEMS})
    return merged


@query("upsert_stats", sql=f"""SELECT b.rows_before, b.rows_before - k.kept AS rows_removed, a.rows_added,
  k.kept + a.rows_added AS final_row_count
FROM (SELECT count(*) AS rows_before FROM ({_STORED})) b,
     (SELECT count(*) AS kept FROM ({_KEEP_ROWS})) k,
     (SELECT count(*) AS rows_added FROM ({_BATCH})) a""")
def upsert_stats(spark, d):
    """Rows before, removed, added, final."""
    _, stats = U.upsert(J.stored_table(spark, d), J.batch_table(spark, d), ["day", "item"])
    return stats


# ----------------------------------------------------------------------- C3
@query("combined_wide", sql=f"""SELECT x.*, c.dept, c.class, c.subclass, c.classification, c.ship_from,
  sc.total_score, sc.class_band, sc.vendor_name, st.store_name, st.market, st.region
FROM ({J.DIST_SQL}) x
LEFT JOIN ({Q.CLASSIFICATION_CLEAN}) c ON x.item = c.item
LEFT JOIN ({B.SCORECARD_SQL}) sc ON x.item = sc.item
LEFT JOIN ({B.STORES_SQL}) st ON x.store = st.store""")
def combined_wide(spark, d):
    """Key spine, sales, evenly distributed web totals, catalogue,
    scorecard and store columns in one wide fact."""
    c = E.classification_clean(B.classification_feed(spark, d)).select(
        "item", "dept", "class", "subclass", "classification", "ship_from")
    return JB.combine(J.distribution_sales(spark, d), J.web_totals(spark, d), c, B.scorecard(spark, d),
                      B.stores(spark, d), J.TOTALS)


# ----------------------------------------------------------------------- C8
def _norm(year):
    return J._norm_sql(year)


SNAP_DIFF_SQL = f"""WITH lo AS ({_norm(1997)}), hi AS ({_norm(1998)}),
missing AS (SELECT DISTINCT omsid FROM lo WHERE omsid NOT IN (SELECT omsid FROM hi)),
lk AS (SELECT omsid, dc, coalesce(bool_or(ntwk_replen = 'ON'), false) AS l_n,
              coalesce(bool_or(dc_replen = 'ON'), false) AS l_d FROM lo GROUP BY omsid, dc),
hk AS (SELECT omsid, dc, coalesce(bool_or(ntwk_replen = 'OFF'), false) AS h_n,
              coalesce(bool_or(dc_replen = 'OFF'), false) AS h_d FROM hi GROUP BY omsid, dc),
chg AS (SELECT omsid, dc FROM lk JOIN hk USING (omsid, dc) WHERE (l_n AND h_n) OR (l_d AND h_d)),
ls AS (SELECT omsid, bool_and(coalesce(ntwk_replen = 'OFF', false) AND coalesce(dc_replen = 'OFF', false)) AS off,
              sum(0.0 + coalesce(oh_qty, 0.0) + coalesce(oo_qty, 0.0)) AS inv FROM lo GROUP BY omsid),
hs AS (SELECT omsid, bool_and(coalesce(ntwk_replen = 'OFF', false) AND coalesce(dc_replen = 'OFF', false)) AS off,
              sum(0.0 + coalesce(oh_qty, 0.0) + coalesce(oo_qty, 0.0)) AS inv FROM hi GROUP BY omsid),
z AS (SELECT omsid FROM ls JOIN hs USING (omsid) WHERE ls.off AND hs.off AND ls.inv > 0 AND hs.inv = 0),
diff AS (
  SELECT lo.*, '{DF.MISSING_ID}' AS change_type FROM lo WHERE omsid IN (SELECT omsid FROM missing)
  UNION ALL
  SELECT hi.*, '{DF.NEW_COMBO}' FROM hi
    WHERE NOT EXISTS (SELECT 1 FROM lk WHERE lk.omsid = hi.omsid AND lk.dc = hi.dc)
  UNION ALL
  SELECT hi.*, '{DF.REPLEN_CHANGE}' FROM hi
    WHERE EXISTS (SELECT 1 FROM chg WHERE chg.omsid = hi.omsid AND chg.dc = hi.dc)
  UNION ALL
  SELECT hi.*, '{DF.ZERO_INVENTORY}' FROM hi WHERE omsid IN (SELECT omsid FROM z))"""


def snapshot_diff_df(spark, d):
    return DF.snapshot_diff(B.snapshot(spark, d, 1997), B.snapshot(spark, d, 1998))


@query("snapshot_diff", sql=f"{SNAP_DIFF_SQL} SELECT * FROM diff")
def snapshot_diff(spark, d):
    """The four change labels between the 1997 and 1998 snapshots."""
    return snapshot_diff_df(spark, d)


_LABELS_SQL = " UNION ALL ".join(f"SELECT {i} AS label_order, '{l}' AS change_type"
                                 for i, l in enumerate(DF.CHANGE_LABELS))


@query("snapshot_change_counts", sql=f"""{SNAP_DIFF_SQL}
SELECT l.label_order, l.change_type, coalesce(c.n, 0) AS count
FROM ({_LABELS_SQL}) l LEFT JOIN (SELECT change_type, count(*) AS n FROM diff GROUP BY change_type) c
  ON l.change_type = c.change_type""")
def snapshot_change_counts(spark, d):
    """Rows per change label, zero-filled, from the key table's counts."""
    return DF.count_changes(B.snapshot(spark, d, 1997), B.snapshot(spark, d, 1998))


@query("zero_inventory_items", sql=f"""{SNAP_DIFF_SQL}
SELECT DISTINCT omsid FROM diff WHERE change_type = '{DF.ZERO_INVENTORY}'""")
def zero_inventory_items(spark, d):
    return DF.zero_inventory(B.snapshot(spark, d, 1997), B.snapshot(spark, d, 1998))


# ---------------------------------------------------------------------- C13
@query("dq_report", sql=f"""SELECT 'fg_grouped' AS table_name, 'required_columns' AS rule, '' AS detail,
  CAST(0 AS BIGINT) AS observed, true AS passed
UNION ALL SELECT 'fg_grouped', 'unique_key', 'upc', (SELECT count(*) FROM (
  SELECT upc FROM ({FG_GROUPED_SQL}) GROUP BY upc HAVING count(*) > 1)),
  (SELECT count(*) FROM (SELECT upc FROM ({FG_GROUPED_SQL}) GROUP BY upc HAVING count(*) > 1)) = 0
UNION ALL SELECT 'fg_grouped', 'row_count_range', '15000-20000', n, n BETWEEN 15000 AND 20000
  FROM (SELECT count(*) AS n FROM ({FG_GROUPED_SQL}))
UNION ALL SELECT 'fg_grouped', 'allowed_keys', '', CAST(0 AS BIGINT), true
UNION ALL SELECT 'reviews_enriched', 'row_conservation', 'before=' || CAST(b AS VARCHAR), n, n = b
  FROM (SELECT count(*) AS n FROM ({REVIEWS_ENRICHED_SQL})),
       (SELECT count(*) AS b FROM ({B.REVIEWS_SQL}) WHERE network IS DISTINCT FROM 'de')
UNION ALL SELECT 'reviews_enriched', 'non_empty', '', n, n > 0
  FROM (SELECT count(*) AS n FROM ({REVIEWS_ENRICHED_SQL}))""")
def dq_report(spark, d):
    """The reference's in-line checks as one report: required columns,
    unique UPC, expected row range (15,000-20,000), allowed upsert keys, row
    conservation through the prefix join, non-empty."""
    fg = E.fg_grouped(B.fg_feed(spark, d))
    a = DQ.dq_report(fg, [
        {"rule": "required_columns", "columns": ["upc", "mpg", "ipg", "bu", "basic", "dash"]},
        {"rule": "unique_key", "keys": ["upc"]},
        {"rule": "row_count_range", "min": 15000, "max": 20000},
        {"rule": "allowed_keys", "keys": ["day", "item"], "allowed": ["day", "item"]},
    ]).select(F.lit("fg_grouped").alias("table_name"), "*")
    before = BL.keep_unless_equal(B.reviews(spark, d), "network", "de")
    b = DQ.dq_report(reviews_enriched_df(spark, d), [
        {"rule": "row_conservation", "before": before},
        {"rule": "non_empty"},
    ]).select(F.lit("reviews_enriched").alias("table_name"), "*")
    return a.unionByName(b)


# ---------------------------------------------------------------------- C12
_PART_COLS = [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"),
              ("p_type", "string"), ("p_size", "int"), ("p_retailprice", "double")]


def _profile_sql(table: str, cols) -> str:
    """Rows are numbered in the order of the file."""
    parts = []
    for i, (c, t) in enumerate(cols):
        if t == "string":
            stat = f"(SELECT coalesce(string_agg({c}, ', ' ORDER BY n), '') FROM (SELECT {c}, n FROM t WHERE {c} IS NOT NULL ORDER BY n LIMIT 3))"
        else:
            stat = (f"'Min: ' || coalesce(CAST(min({c}) AS VARCHAR), 'null') || ', Max: ' || "
                    f"coalesce(CAST(max({c}) AS VARCHAR), 'null')")
        parts.append(f"""SELECT count(*) AS row_count, '{c}' AS column_name, '{t}' AS data_type,
  (SELECT string_agg(coalesce(CAST({c} AS VARCHAR), 'null'), ', ' ORDER BY n) FROM t WHERE n <= 2) AS sample_values,
  count(*) FILTER (WHERE {c} IS NULL) AS null_count,
  CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS unique_count,
  {stat} AS stat FROM t""")
    return f"WITH t AS (SELECT *, row_number() OVER () AS n FROM {table})\n" + "\nUNION ALL\n".join(parts)


@query("profile_columns", sql=_profile_sql("part", _PART_COLS))
def profile_columns(spark, d):
    """Profile of the part table, with its row count, first two rows and first values."""
    return DQ.profile(B.table(spark, d, "part"))


_DOC_COLS = [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint")]


@query("profile_documents", sql=_profile_sql("documents", _DOC_COLS))
def profile_documents(spark, d):
    """C12 / A21 over a table of whole texts."""
    return DQ.profile(B.table(spark, d, "documents"))


@query("first_rows", sql="SELECT * FROM lineitem LIMIT 25")
def first_rows(spark, d):
    """The first rows of a table, in the order of its files (a top-k report)."""
    return DQ.first_rows(B.table(spark, d, "lineitem"), 25)
