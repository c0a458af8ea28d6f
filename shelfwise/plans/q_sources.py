"""Source queries.

The reference reads files (CSV exports, Excel, HTML price lists). Here the
file contents are derived from the driver's tables by Spark, and the source
operator's parsing / selection logic runs over all of it; the file-level
entry points (read_feed, discover, read_preamble_csv) are exercised on real
files in the tests.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions import scalars as S
from shelfwise.functions.dates import date_report, with_dates
from shelfwise.operators import jobs as JB
from shelfwise.operators import schema as P
from shelfwise.plans import bindings as B
from shelfwise.plans.q_scalars import _lz
from shelfwise.plans.registry import query
from shelfwise.sources import files as FS

# ------------------------------------------------------------------ S2
TEXT_COLS = ["CAST(l_orderkey AS STRING) AS order_key",
             "CASE WHEN l_orderkey % 50 = 0 THEN 'n/a' ELSE CAST(l_quantity AS STRING) END AS quantity",
             "CASE WHEN l_linenumber = 5 THEN 'bad date' ELSE CAST(l_shipdate AS STRING) END AS ship",
             "l_returnflag AS flag", "CAST(l_linenumber AS STRING) AS line_no"]
FEED_SPEC = {"order_key": "bigint", "quantity": "double", "flag": "string"}


@query("typed_ingest", sql=f"""SELECT TRY_CAST(order_key AS BIGINT) AS order_key,
  TRY_CAST(quantity AS DOUBLE) AS quantity, TRY_CAST(ship AS TIMESTAMP) AS ship, flag, line_no
FROM (SELECT {', '.join(TEXT_COLS)} FROM lineitem)""")
def typed_ingest(spark, d):
    """Text feed typed by column name; bad cells become null, the row and
    the undeclared column (line_no) are kept."""
    text = B.table(spark, d, "lineitem").selectExpr(*TEXT_COLS)
    return FS.apply_spec(text, FEED_SPEC, dates=["ship"])


# ------------------------------------------------------------------ S3 / F10
# One day, written in many ways: a column of mixed forms, a column of a day-first
# export, a column of a month-first one with a 12-hour clock. The day itself is the oracle.
_FORMS = ["M/d/yyyy", "d MMMM yyyy", "MM-dd-yyyy", "yyyyMMdd", "MMM d yyyy", "yyyy-MM-dd", "d-MMM-yy", "EEE, MMM d, yyyy",
          "yyyy/M/d", "M/d/yy"]
_MIXED = "CASE " + " ".join(f"WHEN l_orderkey % {len(_FORMS)} = {i} THEN date_format(l_shipdate, '{f}')"
                            for i, f in enumerate(_FORMS)) + " END"
_CLOCK = "make_timestamp_ntz(year(l_shipdate), month(l_shipdate), day(l_shipdate), CAST(l_orderkey % 24 AS INT), CAST(l_linenumber * 7 AS INT), 0)"
DATE_TEXTS = ["l_orderkey AS order_key", "l_linenumber AS line_no", f"{_MIXED} AS mixed",
              "CASE WHEN l_linenumber = 5 THEN 'soon' WHEN l_linenumber = 6 THEN '31/02/1996' "
              "ELSE date_format(l_shipdate, 'dd/MM/yyyy') END AS day_first",
              f"date_format({_CLOCK}, 'M/d/yyyy h:mm a') AS clock"]
DATE_COLUMNS = ["mixed", "day_first", "clock"]


@query("date_forms", sql="""SELECT l_orderkey AS order_key, l_linenumber AS line_no, CAST(l_shipdate AS TIMESTAMP) AS mixed,
  CASE WHEN l_linenumber NOT IN (5, 6) THEN CAST(l_shipdate AS TIMESTAMP) END AS day_first,
  CAST(l_shipdate AS TIMESTAMP) + to_hours(CAST(l_orderkey % 24 AS INTEGER)) + to_minutes(CAST(l_linenumber * 7 AS INTEGER)) AS clock
FROM lineitem""")
def date_forms(spark, d):
    """Dates in the forms of exports, each column in the order that
    reads more of its cells."""
    return with_dates(B.table(spark, d, "lineitem").selectExpr(*DATE_TEXTS), DATE_COLUMNS)


@query("date_report", sql=f"""WITH c AS (SELECT l_orderkey % {len(_FORMS)} AS f, l_linenumber AS n FROM lineitem)
SELECT 'mixed' AS "column", count(*) AS cells, CAST(0 AS BIGINT) AS blank, 'month first' AS day_order,
  count(*) FILTER (f = 5) AS iso, count(*) FILTER (f IN (0, 2, 9)) AS numbers, count(*) FILTER (f = 3) AS compact,
  count(*) FILTER (f = 8) AS slashed, count(*) FILTER (f IN (1, 4, 6, 7)) AS named, CAST(0 AS BIGINT) AS lost FROM c
UNION ALL SELECT 'day_first', count(*), 0, 'day first', 0, count(*) FILTER (n <> 5), 0, 0, 0, count(*) FILTER (n IN (5, 6)) FROM c
UNION ALL SELECT 'clock', count(*), 0, 'month first', 0, count(*), 0, 0, 0, 0 FROM c""")
def date_report_query(spark, d):
    """per column its cells by form, its order of day and month, and the cells lost."""
    return date_report(B.table(spark, d, "lineitem").selectExpr(*DATE_TEXTS), DATE_COLUMNS)


# ------------------------------------------------------------------ S9
HEADER_ROW = 2


@query("preamble_skip", sql=f"""WITH l AS (
  SELECT doc_id, unnest(s) AS line, CAST(generate_subscripts(s, 1) AS BIGINT) AS row_no
  FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents)),
h AS (SELECT doc_id, line AS header FROM l WHERE row_no = {HEADER_ROW})
SELECT l.doc_id, l.row_no, h.header, l.line,
  CAST(least(len(string_split(l.line, ',')), len(string_split(h.header, ','))) AS BIGINT) AS n_fields
FROM l JOIN h ON l.doc_id = h.doc_id WHERE l.row_no > {HEADER_ROW}""")
def preamble_skip(spark, d):
    """S9 over whole document texts: line 2 is the header, the lines after it
    are rows cut to the header width."""
    r = FS.preamble_rows(B.table(spark, d, "documents"), "doc_id", "text", HEADER_ROW)
    return r.select("doc_id", F.col("row_no").cast("bigint").alias("row_no"), "header", "line",
                    F.col("n_fields").cast("bigint").alias("n_fields"))


# ------------------------------------------------------------------ S8 / U4
@query("union_by_name", sql="""SELECT l_orderkey AS key, l_linenumber AS line, l_quantity AS qty,
  l_extendedprice AS price, CAST(NULL AS DOUBLE) AS tax, CAST(NULL AS VARCHAR) AS status, 'a.csv' AS source_file
FROM lineitem WHERE l_linenumber % 2 = 1
UNION ALL SELECT l_orderkey, l_linenumber, l_quantity, NULL, l_tax, NULL, 'b.csv' FROM lineitem WHERE l_linenumber % 2 = 0
UNION ALL SELECT o_orderkey, NULL, NULL, NULL, NULL, o_orderstatus, 'c.csv' FROM orders""")
def union_by_name(spark, d):
    """Three deliveries with different columns, unioned by name."""
    li = B.table(spark, d, "lineitem")
    a = li.filter("l_linenumber % 2 = 1").selectExpr("l_orderkey AS key", "l_linenumber AS line",
                                                       "l_quantity AS qty", "l_extendedprice AS price")
    b = li.filter("l_linenumber % 2 = 0").selectExpr("l_orderkey AS key", "l_linenumber AS line",
                                                       "l_quantity AS qty", "l_tax AS tax")
    c = B.table(spark, d, "orders").selectExpr("o_orderkey AS key", "o_orderstatus AS status")
    return FS.union_feed([a, b, c], ["a.csv", "b.csv", "c.csv"])


# ------------------------------------------------------------------ S16
_FEED_FILE = "'pythononlinesales_' || CAST(year(l_shipdate) AS STRING) || '.csv'"


@query("snapshot_last_file", sql=f"""WITH x AS (SELECT l_orderkey AS order_key, l_linenumber AS line,
    l_shipdate AS day, {_FEED_FILE} AS file_name FROM lineitem)
SELECT * FROM x WHERE file_name = (SELECT max(file_name) FROM x)""")
def snapshot_last_file(spark, d):
    """Un-keyed feed delivered as one file per year; only the last
    file by name counts."""
    x = B.table(spark, d, "lineitem").selectExpr("l_orderkey AS order_key", "l_linenumber AS line",
                                                 "l_shipdate AS day", f"{_FEED_FILE} AS file_name")
    return FS.last_file_rows(x, "file_name")


# ------------------------------------------------------------------ S6
_STORE_LIST_NAME = """CASE WHEN o_orderkey % 7 = 0 THEN 'Team Territory Store List draft.xlsx'
  ELSE 'Team Territory Store List ' || CAST(month(o_orderdate) AS STRING) || '.'
       || CAST(day(o_orderdate) AS STRING) || '.' || CAST(year(o_orderdate) AS STRING) || '.xlsx' END"""


@query("latest_dated_file", sql=rf"""WITH n AS (SELECT DISTINCT {_STORE_LIST_NAME} AS file_name FROM orders),
d AS (SELECT file_name, make_date(
    CAST(regexp_extract(file_name, 'Team Territory Store List (\d{{1,2}})\.(\d{{1,2}})\.(\d{{4}})\.xlsx', 3) AS INTEGER),
    CAST(regexp_extract(file_name, 'Team Territory Store List (\d{{1,2}})\.(\d{{1,2}})\.(\d{{4}})\.xlsx', 1) AS INTEGER),
    CAST(regexp_extract(file_name, 'Team Territory Store List (\d{{1,2}})\.(\d{{1,2}})\.(\d{{4}})\.xlsx', 2) AS INTEGER))
    AS file_date
  FROM n WHERE regexp_matches(file_name, 'Team Territory Store List (\d{{1,2}})\.(\d{{1,2}})\.(\d{{4}})\.xlsx'))
SELECT file_name, file_date FROM d ORDER BY file_date DESC, file_name DESC LIMIT 1""")
def latest_dated_file(spark, d):
    """The newest store list by the date in its name (one name per order
    date; undated drafts are rejected)."""
    names = B.table(spark, d, "orders").selectExpr(f"{_STORE_LIST_NAME} AS file_name")
    return FS.latest_by_name_date(names, "file_name")


# ------------------------------------------------------------------ S10 / S11 / C10
PAGE_SIZE = 50
CELL_COLS = ["CASE WHEN p_partkey % 13 = 0 THEN '' WHEN p_partkey % 2 = 0 "
             "THEN '=\"' || lpad(CAST(p_partkey AS STRING), 11, '0') || '\"' "
             "ELSE lpad(CAST(p_partkey AS STRING), 11, '0') END AS c_upc",
             "CAST(p_size % 10 AS STRING) AS c_plus",
             "CASE WHEN p_partkey % 26 = 0 THEN '' ELSE p_name END AS c_item",
             "p_type || ' ' || p_brand AS c_desc"]
_TR = "'<tr><td>' || c_upc || '</td><td>' || c_plus || '</td><td>' || c_item || '</td><td>' || c_desc || '</td></tr>'"
_HEAD = "'<table><tr><th>UPC</th><th>UPC +</th><th>Item</th><th>Description</th></tr>'"
_DECOY = "'<table><tr><th>Note</th></tr><tr><td>UPC and Item below</td></tr></table>'"


def price_pages(spark, d):
    """HTML price-list pages built from part rows (50 parts per page, some
    pages with a decoy table first). Each page is bounded in size."""
    p = B.table(spark, d, "part").selectExpr(f"p_partkey DIV {PAGE_SIZE} AS page_no", "p_partkey", *CELL_COLS)
    rows = p.selectExpr("page_no", "p_partkey", f"{_TR} AS tr")
    pages = rows.groupBy("page_no").agg(
        F.expr("listagg(tr, '') WITHIN GROUP (ORDER BY p_partkey)").alias("body"))
    html = F.concat(F.lit("<html><body><p>Description : <b>Price list "), F.col("page_no").cast("string"),
                    F.lit("</b></p>\n"),
                    F.when(F.col("page_no") % 3 == 0, F.expr(_DECOY)).otherwise(F.lit("")),
                    F.expr(_HEAD), F.col("body"), F.lit("</table></body></html>"))
    return pages.select("page_no", html.alias("html"))


PAGES_SQL = f"""SELECT page_no, '<html><body><p>Description : <b>Price list ' || CAST(page_no AS VARCHAR)
  || '</b></p>' || chr(10) || CASE WHEN page_no % 3 = 0 THEN {_DECOY} ELSE '' END || {_HEAD}
  || string_agg({_TR}, '' ORDER BY p_partkey) || '</table></body></html>' AS html
FROM (SELECT p_partkey // {PAGE_SIZE} AS page_no, p_partkey, {', '.join(CELL_COLS)} FROM part)
GROUP BY page_no"""

_TABLE_COLS = [("UPC", "upc"), ("UPC +", "upc_plus"), ("Item", "item"), ("Description", "description")]


def _cell(name: str) -> str:
    pos = f"coalesce(list_position(hh.header, '{name}'), 0)"
    return f"NULLIF(CASE WHEN {pos} > 0 THEN c.cells[{pos}] END, '')"


HTML_ROWS_SQL = f"""WITH pg AS ({PAGES_SQL}),
t AS (SELECT page_no, unnest(tl) AS tbl, generate_subscripts(tl, 1) AS table_no
      FROM (SELECT page_no, regexp_extract_all(html, '(?s)(<table.*?</table>)', 1) AS tl FROM pg)),
r AS (SELECT page_no, table_no, unnest(rl) AS tr, generate_subscripts(rl, 1) - 1 AS row_no
      FROM (SELECT page_no, table_no, regexp_extract_all(tbl, '(?s)<tr>(.*?)</tr>', 1) AS rl FROM t)),
c AS (SELECT page_no, table_no, row_no,
        list_transform(regexp_extract_all(tr, '(?s)<t[dh]>(.*?)</t[dh]>', 1),
                       lambda x: trim(regexp_replace(x, '<[^>]+>', '', 'g'))) AS cells FROM r),
h AS (SELECT page_no, min(table_no) AS table_no FROM c
      WHERE row_no = 0 AND list_contains(cells, 'UPC') AND list_contains(cells, 'Item') GROUP BY page_no),
hh AS (SELECT c.page_no, c.table_no, c.cells AS header FROM c JOIN h USING (page_no, table_no) WHERE c.row_no = 0),
rows AS (SELECT c.page_no, CAST(c.row_no AS BIGINT) AS row_no,
  {', '.join(f'{_cell(n)} AS {a}' for n, a in _TABLE_COLS)}
  FROM c JOIN hh ON c.page_no = hh.page_no AND c.table_no = hh.table_no WHERE c.row_no > 0)"""


def html_rows_df(spark, d):
    r = FS.html_rows(price_pages(spark, d), "page_no", "html", [n for n, _ in _TABLE_COLS])
    return r.select("page_no", F.col("row_no").cast("bigint").alias("row_no"),
                    *[F.col(f"`{n}`").alias(a) for n, a in _TABLE_COLS])


@query("html_table_rows", sql=f"{HTML_ROWS_SQL} SELECT * FROM rows")
def html_table_rows(spark, d):
    """Rows of the first table whose header has both UPC and Item."""
    return html_rows_df(spark, d)


# Pages whose tables span cells: a brand's cell covers all its rows of the page, some
# names cover the columns of name and size, the price is a table of its own.
_SPAN_HEAD = "<table><tr><th>Brand</th><th>Item</th><th colspan=2>Pack</th><th>Price</th></tr>"


def spanned_pages(spark, d):
    p = B.table(spark, d, "part").selectExpr(f"p_partkey DIV {PAGE_SIZE} AS page_no", "p_partkey", "p_brand", "p_name", "p_size", "p_retailprice")
    brands = p.groupBy("page_no", "p_brand").agg(F.min("p_partkey").alias("first"), F.count("*").alias("n"))
    p = p.join(brands, ["page_no", "p_brand"])
    brand = F.when(F.col("p_partkey") == F.col("first"), F.concat(F.lit("<td rowspan='"), F.col("n").cast("string"), F.lit("'>"), F.col("p_brand"), F.lit("</td>")))
    pack = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit('<td colspan="2">'), "p_name")).otherwise(
        F.concat(F.lit("<td>"), "p_name", F.lit("<td>"), F.col("p_size").cast("string"), F.lit("</td>")))
    tr = F.concat(F.lit("<tr>"), F.coalesce(brand, F.lit("")), F.lit("<td>"), F.col("p_partkey").cast("string"), F.lit("</td>"), pack,
                  F.lit("<td><table><tr><td>"), F.col("p_retailprice").cast("string"), F.lit("</td></tr></table></td></tr>"))
    pages = (p.select("page_no", "p_brand", "p_partkey", tr.alias("tr")).groupBy("page_no")
             .agg(F.array_sort(F.collect_list(F.struct("p_brand", "p_partkey", "tr"))).alias("x")))
    body = F.array_join(F.transform("x", lambda r: r["tr"]), "")
    return pages.select("page_no", F.concat(F.lit("<p>UPC, Item</p><table><tr><td>Item"), F.lit("</table>"), F.lit(_SPAN_HEAD), body,
                                            F.lit("</table>")).alias("html"))


@query("html_spanned_cells", sql=f"""SELECT p_partkey // {PAGE_SIZE} AS page_no,
  row_number() OVER (PARTITION BY p_partkey // {PAGE_SIZE} ORDER BY p_brand, p_partkey) AS row_no,
  p_brand AS brand, CAST(p_partkey AS VARCHAR) AS item, p_name AS pack,
  CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE CAST(p_size AS VARCHAR) END AS pack_1, CAST(p_retailprice AS VARCHAR) AS price FROM part""")
def html_spanned_cells(spark, d):
    """Tables with row spans, column spans in header and cells, and nested tables."""
    r = FS.html_rows(spanned_pages(spark, d), "page_no", "html", ["Brand", "Item", "Pack", "Pack.1", "Price"], must_have=("Brand", "Item"))
    return r.select("page_no", F.col("row_no").cast("bigint").alias("row_no"), F.col("Brand").alias("brand"), F.col("Item").alias("item"),
                    F.col("Pack").alias("pack"), F.col("`Pack.1`").alias("pack_1"), F.col("Price").alias("price"))


_TITLE = r"<title>(.*?)</title>"
_H1 = r"<h1>(.*?)</h1>"


def _field_sql(pattern: str, default: str) -> str:
    return (f"coalesce(NULLIF(trim(regexp_replace(trim(regexp_extract(html, '{pattern}', 1)), '<[^>]+>', '', 'g')), ''), "
            f"{default})")


@query("html_field_extract", sql=f"""SELECT page_id, {_field_sql(_TITLE, 'url')} AS title,
  {_field_sql(_H1, 'url')} AS heading FROM pages""")
def html_field_extract(spark, d):
    """S11 on raw web pages: title and first heading, tags stripped, the URL
    when absent or blank."""
    p = B.table(spark, d, "pages")
    return p.select("page_id", FS.html_field(F.col("html"), _TITLE, F.col("url")).alias("title"),
                    FS.html_field(F.col("html"), _H1, F.col("url")).alias("heading"))


def _clean_sql(c: str) -> str:
    return rf"""regexp_replace(trim({c}), '^[\s="'']*|[\s"'']*$', '', 'g')"""


def _full_upc_sql(u: str, p: str) -> str:
    return (f"CASE WHEN {u} IS NULL OR trim({u}) = '' THEN NULL ELSE '0' || "
            + _lz(rf"regexp_replace({u}, '\D', '', 'g')") + " || coalesce("
            + _lz(rf"regexp_replace({p}, '\D', '', 'g')") + ", '') END")


_DESC_FIELD = rf"""coalesce(NULLIF(trim(regexp_replace(trim(regexp_extract(pg.html, 'Description\s*:\s*(.+)', 1)), '<[^>]+>', '', 'g')), ''),
  'page_' || CAST(pg.page_no AS VARCHAR))"""


@query("price_list_merge", sql=f"""{HTML_ROWS_SQL},
cl AS (SELECT rows.page_no, rows.row_no, {', '.join(f'{_clean_sql(a)} AS {a}' for _, a in _TABLE_COLS)}
       FROM rows)
SELECT {_DESC_FIELD} AS price_file, {_full_upc_sql('cl.upc', 'cl.upc_plus')} AS full_upc,
  cl.upc, cl.upc_plus, cl.item, cl.description, cl.page_no, cl.row_no
FROM cl JOIN pg ON cl.page_no = pg.page_no
WHERE cl.upc IS NOT NULL OR cl.item IS NOT NULL""")
def price_list_merge(spark, d):
    """Table rows of every price page, included columns cleaned (F2),
    the page's Description as Price File (S11, page stem as fallback), Full
    UPC (F3), rows without UPC and Item dropped (W8), all pages unioned."""
    out = JB.price_list(price_pages(spark, d), "page_no", "html", dict(_TABLE_COLS))
    out = out.withColumn("row_no", F.col("row_no").cast("bigint"))
    return out.select("price_file", "full_upc", "upc", "upc_plus", "item", "description", "page_no", "row_no")


# Whole price lists: every column of the export, per column its header, the name of the
# result and the cell's text (read alike by Spark and DuckDB).
_PART11 = "lpad(CAST(p_partkey AS STRING), 11, '0')"
PRICE_CELLS = [
    ("UPC", "upc", f"CASE WHEN p_partkey % 13 = 0 THEN '' WHEN p_partkey % 2 = 0 THEN '=\"' || {_PART11} || '\"' ELSE {_PART11} END"),
    ("UPC +", "upc_plus", "CASE WHEN p_partkey % 5 = 0 THEN '' ELSE CAST(p_size % 10 AS STRING) END"),
    ("UPC Inner Pack I25", "upc_inner_pack", f"'1' || {_PART11}"),
    ("UPC Standard Pack I25", "upc_standard_pack", f"'=\"5' || {_PART11} || '\"'"),
    ("Item", "item", "CASE WHEN p_partkey % 26 = 0 THEN '' ELSE p_name END"),
    ("Life Cycle", "life_cycle", "CASE p_size % 3 WHEN 0 THEN 'Active' WHEN 1 THEN 'Phase Out' ELSE 'New' END"),
    ("Description", "description", "p_type || ' <i>' || p_brand || '</i>'"),
    ("Customer Item", "customer_item", "CASE WHEN p_partkey % 4 = 0 THEN '' ELSE 'C' || CAST(p_partkey AS STRING) END"),
    ("PPC / ICC", "ppc_icc", "'ICC ' || CAST(p_partkey % 31 AS STRING)"),
    ("UOM", "uom", "CASE WHEN p_size % 2 = 0 THEN 'EA' ELSE 'PK' END"),
    ("Net Price", "net_price", "CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS STRING)"),
    ("List Price", "list_price", "CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 2 AS STRING)"),
    ("End Date", "end_date", "'12/31/' || CAST(2024 + p_size % 3 AS STRING)"),
    ("Std Pk (SPW)", "std_pk", "CAST(p_size AS STRING)"),
    ("Inner Pk (IPW)", "inner_pk", "CAST(p_size % 7 AS STRING)"),
    ("Ctns per Tier", "ctns_per_tier", "CAST(p_partkey % 12 AS STRING)"),
    ("Tiers per Pallet", "tiers_per_pallet", "CAST(p_partkey % 9 AS STRING)"),
    ("Length", "length", "CAST(p_partkey % 17 AS STRING) || '.5'"),
    ("Height", "height", "CAST(p_partkey % 19 AS STRING) || '.25'"),
    ("Depth", "depth", "CAST(p_partkey % 23 AS STRING) || '.75'"),
    ("Cube", "cube", "CAST((p_partkey % 17) * (p_partkey % 19) * (p_partkey % 23) AS STRING)"),
    ("Weight", "weight", "CASE WHEN p_partkey % 11 = 0 THEN ' ' ELSE CAST(p_size * 3 AS STRING) END"),
    ("Pack Validation", "pack_validation", "CASE WHEN p_partkey % 8 = 0 THEN 'N' ELSE 'Y' END"),
    ("Nafta", "nafta", "CASE WHEN p_partkey % 3 = 0 THEN 'N' ELSE 'Y' END"),
    ("COO", "coo", "CASE p_partkey % 3 WHEN 0 THEN 'CN' WHEN 1 THEN 'MX' ELSE 'US' END"),
]
_OLD_LACK = ("nafta", "coo")      # not in the lists of odd pages


def price_lists(spark, d):
    """Price-list pages of ``part`` with all columns. Odd pages are an older form: the
    columns from right to left, two missing, two that no result takes; every fifth
    page has no description."""
    p = B.table(spark, d, "part").selectExpr("p_partkey", f"p_partkey DIV {PAGE_SIZE} AS page_no",
                                             *[f"{cell} AS {name}" for _, name, cell in PRICE_CELLS])

    def layout(cells, mark):
        return F.concat(F.lit("<tr>"), *[F.concat(F.lit(f"<{mark}>"), c, F.lit(f"</{mark}>")) for c in cells], F.lit("</tr>"))
    old = [(h, n) for h, n, _ in reversed(PRICE_CELLS) if n not in _OLD_LACK]
    new_row, old_row = layout([F.col(n) for _, n, _ in PRICE_CELLS], "td"), layout([F.lit("t"), *[F.col(n) for _, n in old], F.lit("c")], "td")
    new_head = layout([F.lit(h) for h, _, _ in PRICE_CELLS], "th")
    old_head = layout([F.lit("Trade1"), *[F.lit(h) for h, _ in old], F.lit("Comm Code")], "th")
    is_old = F.col("page_no") % 2 == 1
    rows = p.select("page_no", "p_partkey", F.when(is_old, old_row).otherwise(new_row).alias("tr"))
    pages = rows.groupBy("page_no").agg(F.expr("listagg(tr, '') WITHIN GROUP (ORDER BY p_partkey)").alias("body"))
    told = F.when(F.col("page_no") % 5 == 0, F.lit("")).otherwise(
        F.concat(F.lit("<p>Description : <b>Price list "), F.col("page_no").cast("string"), F.lit("</b></p>\n")))
    return pages.select("page_no", F.concat(told, F.lit("<table>"), F.when(is_old, old_head).otherwise(new_head), F.col("body"),
                                            F.lit("</table>")).alias("html"))


def _price_cell_sql(name: str, cell: str) -> str:
    text = _clean_sql(f"NULLIF(trim(regexp_replace({cell}, '<[^>]+>', '', 'g')), '')")
    return f"CASE WHEN page_no % 2 = 1 THEN NULL ELSE {text} END AS {name}" if name in _OLD_LACK else f"{text} AS {name}"


@query("price_lists_whole", sql=f"""WITH p AS (
  SELECT *, p_partkey // {PAGE_SIZE} AS page_no,
    row_number() OVER (PARTITION BY p_partkey // {PAGE_SIZE} ORDER BY p_partkey) AS row_no FROM part),
cl AS (SELECT page_no, row_no, {', '.join(_price_cell_sql(n, c) for _, n, c in PRICE_CELLS)} FROM p)
SELECT CASE WHEN page_no % 5 = 0 THEN 'page_' || CAST(page_no AS VARCHAR) ELSE 'Price list ' || CAST(page_no AS VARCHAR) END AS price_file,
  {_full_upc_sql('upc', 'upc_plus')} AS full_upc, {', '.join(n for _, n, _ in PRICE_CELLS)}, page_no, row_no
FROM cl WHERE upc IS NOT NULL OR item IS NOT NULL""")
def price_lists_whole(spark, d):
    """C10 with all 25 columns of the price export, from lists of two forms: columns
    found by header, missing ones null, other ones left out."""
    out = JB.price_list(price_lists(spark, d), "page_no", "html", {h: n for h, n, _ in PRICE_CELLS})
    return out.select("price_file", "full_upc", *[n for _, n, _ in PRICE_CELLS], "page_no", F.col("row_no").cast("bigint").alias("row_no"))
