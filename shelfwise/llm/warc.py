"""Derivative WARC records of web responses.

Every response gives two linked records (WARC 1.1):

* ``metadata`` (application/warc-fields): title, language, number of links,
  the source's HTTP headers line by line, and the response's payload digest.
* ``conversion`` (text/plain): the plain text of the payload.

Both carry WARC-Refers-To (the response's record id), the target URI, the
source's headers and date unchanged, the digest of their own block and the
response's payload digest. Record ids are name-based (hash of the response's
id and the record type), so a rerun or a retried task writes the same ids.

Text extraction: comments, scripts, styles and templates go; block-level tags
break lines; other tags go; entities are decoded once (HTML's named list,
decimal and hexadecimal numbers); runs of blanks and blank lines shrink.

Defined results: a null payload is an empty block with its digest; a null URI
or header stays null (its header line is left out of the serialised record); a
null date stays null (the serialised record, which must have one, takes the
writer's); repeated responses give repeated records with equal ids; input
columns beyond those named are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from html import unescape
from html.entities import html5

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import bounded_batches

#: Extraction rules in order: (pattern, replacement); the same text is used in SQL.
RULES = [
    (r"(?s)<!--.*?-->", ""),
    (r"(?is)<script\b.*?</script\s*>", ""),
    (r"(?is)<style\b.*?</style\s*>", ""),
    (r"(?is)<noscript\b.*?</noscript\s*>", ""),
    (r"(?is)<template\b.*?</template\s*>", ""),
    (r"(?i)</?(p|div|br|hr|li|ul|ol|dl|dt|dd|h[1-6]|tr|td|th|table|article|section|header|footer|nav|main|aside|title"
     r"|body|html|head|blockquote|pre|form)\b[^>]*>", "\n"),
    (r"</?[a-zA-Z!?][^>]*>", ""),
]
#: A character reference, as HTML reads it (the SQL form finds the same spans).
REFERENCE = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
SPACING = [("[ \\t\\r\\f\\x0B ]+", " "), (r" ?\n ?", "\n"), (r"\n\n+", "\n"), (r"^\s+|\s+$", "")]


def _unescaped(texts: pa.Array) -> pa.Array:
    return pa.array([x if x is None or "&" not in x else unescape(x) for x in texts.to_pylist()], pa.string())


def plain_text(html: Column) -> Column:
    text = F.coalesce(html, F.lit(""))
    for pattern, put in RULES:
        text = F.regexp_replace(text, pattern, put)
    text = F.arrow_udf(_unescaped, "string")(text)
    for pattern, put in SPACING:
        text = F.regexp_replace(text, pattern, put)
    return text


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block.cast("binary"), 256))


def name_uuid(name: Column) -> Column:
    """urn:uuid of the MD5 of a name."""
    h = F.md5(name)
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def responses(pages: DataFrame) -> DataFrame:
    """Response records of fetched pages (page_id, url, html, and date if there is one)."""
    date = F.col("date") if "date" in pages.columns else F.lit(None).cast("string")
    html = F.coalesce("html", F.lit(""))
    headers = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                       F.octet_length(html).cast("string"))
    name = F.concat_ws("|", F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
                       F.coalesce("url", F.lit("")), F.md5(html))
    return pages.select("page_id", name_uuid(name).alias("record_id"), F.col("url").alias("target_uri"),
                        headers.alias("http_headers"), F.col("html").alias("payload"), digest(html).alias("payload_digest"),
                        date.alias("date"))


def derivatives(resp: DataFrame) -> DataFrame:
    """Metadata and conversion records of response records; two rows per response."""
    bounded_batches(resp.sparkSession)
    html = F.coalesce("payload", F.lit(""))
    title = F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title", 1)
    lang = F.regexp_extract(html, r"(?i)<html[^>]*\blang=[\"']?([a-z-]+)", 1)
    links = F.regexp_count(html, F.lit(r"(?i)<a\s[^>]*href="))
    meta = F.concat(F.lit("title: "), plain_text(title), F.lit("\r\nlanguage: "), lang, F.lit("\r\nlinks: "),
                    links.cast("string"), F.lit("\r\nsource-payload-digest: "), F.coalesce("payload_digest", F.lit("")),
                    F.lit("\r\nsource-headers:\r\n"), F.coalesce("http_headers", F.lit("")), F.lit("\r\n"))
    kinds = F.array(
        F.struct(F.lit("metadata").alias("record_type"), F.lit("application/warc-fields").alias("content_type"), meta.alias("block")),
        F.struct(F.lit("conversion").alias("record_type"), F.lit("text/plain; charset=utf-8").alias("content_type"),
                 plain_text(F.col("payload")).alias("block")))
    own = F.concat_ws("|", "record_type", F.coalesce("refers_to", F.lit("")))
    return (resp.select("page_id", F.col("record_id").alias("refers_to"), "target_uri", "http_headers", "payload_digest", "date",
                        F.explode(kinds).alias("k"))
            .select("page_id", "refers_to", "target_uri", "http_headers", "payload_digest", "date", "k.*")
            .select("page_id", "record_type", name_uuid(own).alias("record_id"), "refers_to", "target_uri", "content_type",
                    F.octet_length("block").cast("long").alias("content_length"), digest(F.col("block")).alias("block_digest"),
                    "payload_digest", "http_headers", "block", "date"))


def serialised(records: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Adds ``warc``, the record in WARC 1.1 text form; ``date`` is for records without one."""
    kind = records.schema["date"].dataType.typeName()
    own = (F.date_format(F.to_utc_timestamp("date", F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'") if kind == "timestamp"
           else F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss'Z'") if kind in ("date", "timestamp_ntz") else F.col("date").cast("string"))
    line = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise("")
    head = F.concat(F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", F.col("record_id")),
                    line("WARC-Refers-To", F.col("refers_to")), line("WARC-Target-URI", F.col("target_uri")),
                    line("WARC-Date", F.coalesce(own, F.lit(date))), line("WARC-Block-Digest", F.col("block_digest")),
                    line("WARC-Payload-Digest", F.col("payload_digest")), line("Content-Type", F.col("content_type")),
                    line("Content-Length", F.col("content_length").cast("string")))
    return records.withColumn("warc", F.concat(head, F.lit("\r\n"), F.col("block"), F.lit("\r\n\r\n")))


def write(records: DataFrame, path: str) -> None:
    """WARC files, records end to end (the writer's line end is the last byte of each record)."""
    rows = serialised(records).select(F.expr("substring(warc, 1, char_length(warc) - 1)").alias("warc"))
    rows.write.option("lineSep", "\n").option("compression", "gzip").text(path)


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _reference_table() -> str:
    """(name, put) rows of HTML's named references and of the numbers that do not
    stand for their own character."""
    rows = list(html5.items()) + [(f"#{n}", unescape(f"&#{n};")) for n in range(160) if unescape(f"&#{n};") != chr(n)]
    return ", ".join(f"({_quoted(name)}, {_quoted(put)})" for name, put in rows)


def _sql_text(column: str) -> str:
    """Query of (src, plain) for the distinct values of ``column`` in ``r``: tags go by the
    rules, the text is cut at its references, each is looked up (a number by its
    value, a name whole or else by its longest known beginning) and put back."""
    cut = "src"
    for pattern, put in RULES:
        cut = f"regexp_replace({cut}, {_quoted(pattern)}, {_quoted(put)}, 'g')"
    joined = "string_agg(before || coalesce(put, ''), '' ORDER BY i)"
    for pattern, put in SPACING:
        joined = f"regexp_replace({joined}, {_quoted(pattern)}, {_quoted(put)}, 'g')"
    pattern = _quoted(REFERENCE)
    return f"""
  SELECT src, {joined} AS plain FROM (
    SELECT s.src, s.i, s.before, CASE
      WHEN s.ref IS NULL THEN ''
      WHEN s.ref LIKE '#%' THEN coalesce(named.put, CASE
        WHEN s.num IS NULL OR s.num > 1114111 OR s.num BETWEEN 55296 AND 57343 THEN chr(65533)
        WHEN s.num BETWEEN 1 AND 31 AND s.num NOT IN (9, 10, 12, 13) OR s.num BETWEEN 127 AND 159
          OR s.num BETWEEN 64976 AND 65007 OR s.num % 65536 >= 65534 THEN ''
        ELSE chr(s.num::INTEGER) END)
      WHEN named.put IS NOT NULL THEN named.put
      ELSE coalesce((SELECT max_by(n.put || substr(s.ref, length(n.name) + 1), length(n.name)) FROM named n
                     WHERE n.name NOT LIKE '#%' AND starts_with(s.ref, n.name)), '&' || s.ref) END AS put
    FROM (SELECT src, i, before, ref, num, CASE WHEN ref LIKE '#%' THEN '#' || num ELSE ref END AS key FROM (
      SELECT src, i, before, ref, CASE
        WHEN regexp_matches(ref, '^#[xX]') THEN TRY_CAST('0x' || regexp_replace(regexp_replace(ref, ';$', ''), '^#[xX]0*', '0') AS BIGINT)
        WHEN ref LIKE '#%' THEN TRY_CAST(regexp_replace(substr(ref, 2), ';$', '') AS BIGINT) END AS num
      FROM (SELECT src, unnest(range(1, len(pieces) + 1)) AS i, unnest(pieces) AS before,
                   unnest(list_concat(refs, [NULL])) AS ref
            FROM (SELECT src, regexp_split_to_array(cut, {pattern}) AS pieces, regexp_extract_all(cut, {pattern}, 1) AS refs
                  FROM (SELECT src, {cut} AS cut FROM (SELECT DISTINCT {column} AS src FROM r)))))) s
    LEFT JOIN named ON named.name = s.key) GROUP BY src"""


def oracle() -> str:
    """The derivatives of ``pages`` in DuckDB SQL."""
    uuid = lambda n: (f"'<urn:uuid:' || substr(md5({n}),1,8) || '-' || substr(md5({n}),9,4) || '-' || substr(md5({n}),13,4)"  # noqa: E731
                      f" || '-' || substr(md5({n}),17,4) || '-' || substr(md5({n}),21,12) || '>'")
    return f"""
WITH named(name, put) AS (VALUES {_reference_table()}),
p AS (SELECT page_id, url, coalesce(html, '') AS h FROM pages),
r AS (
  SELECT page_id, url AS target_uri, h, {uuid("'response|' || coalesce(page_id::VARCHAR, '') || '|' || coalesce(url, '') || '|' || md5(h)")} AS refers_to,
         'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10)
           || 'Content-Length: ' || strlen(h)::VARCHAR AS http_headers, 'sha256:' || sha256(h) AS payload_digest,
         regexp_extract(h, '(?is)<title[^>]*>(.*?)</title', 1) AS title FROM p),
titles AS ({_sql_text("title")}),
bodies AS ({_sql_text("h")}),
k AS (
  SELECT r.*, 'metadata' AS record_type, 'application/warc-fields' AS content_type,
         'title: ' || plain || chr(13) || chr(10)
         || 'language: ' || regexp_extract(h, '(?i)<html[^>]*\\blang=["'']?([a-z-]+)', 1) || chr(13) || chr(10)
         || 'links: ' || len(regexp_extract_all(h, '(?i)<a\\s[^>]*href='))::VARCHAR || chr(13) || chr(10)
         || 'source-payload-digest: ' || payload_digest || chr(13) || chr(10) || 'source-headers:' || chr(13) || chr(10)
         || http_headers || chr(13) || chr(10) AS block FROM r JOIN titles ON title = src
  UNION ALL
  SELECT r.*, 'conversion', 'text/plain; charset=utf-8', plain FROM r JOIN bodies ON h = src)
SELECT page_id, record_type, {uuid("record_type || '|' || refers_to")} AS record_id, refers_to, target_uri, content_type,
       strlen(block)::BIGINT AS content_length, 'sha256:' || sha256(block) AS block_digest, payload_digest, http_headers, block
FROM k
"""
