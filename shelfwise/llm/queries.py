"""Registered queries of the operators, each over its whole table, and their
DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from shelfwise.llm.common import table

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@query("op1_sharding")
def op1_sharding(spark, sf_dir):
    """Every document's shard and slot after the two-pass shuffle (law ``rows``).
    Texts travel with their rows; size and checksum are taken from the shards."""
    from shelfwise.llm.sharding import shuffle_into_shards
    out = shuffle_into_shards(table(spark, sf_dir, "documents").select("doc_id", "text"), shards=8)
    text = F.coalesce(F.col("text"), F.lit(""))
    return out.select("doc_id", (F.octet_length(text).cast("long") + 1).alias("size"),
                      F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"),
                      "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


_MIX_SQL = """
WITH d AS (
  SELECT doc_id, source, text,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''))::BIGINT AS size
  FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (
  SELECT *, (row_number() OVER (ORDER BY (source IS NULL), encode(source)) - 1) AS k, 2 * source_size::DOUBLE AS most FROM s0),
s2 AS (SELECT *, CASE k % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w FROM s1),
s3 AS (
  SELECT *, row_number() OVER f AS place,
         coalesce(sum(most) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS "full",
         sum(w) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS "open",
         1.5::DOUBLE * (SELECT sum(source_size) FROM s0)::DOUBLE AS budget
  FROM s2 WINDOW f AS (ORDER BY most / w, k)),
s4 AS (SELECT *, (budget - "full") / "open" AS lev FROM s3),
lv AS (SELECT arg_min(lev, place) AS level FROM s4 WHERE lev * w < most),
s5 AS (SELECT source, source_size,
              CASE WHEN level IS NULL THEN most ELSE least(most, level * w) END AS target FROM s4, lv),
s6 AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM s5),
u AS (
  SELECT d.doc_id, d.size, s6.source_size, s6.target, s6.rate,
         ('0x' || substr(md5('mix-1|' || coalesce(d.doc_id::VARCHAR, '') || '|' || md5(coalesce(d.text, ''))), 1, 8))::BIGINT::DOUBLE
           / 4294967296.0::DOUBLE AS u
  FROM d JOIN s6 ON d.source IS NOT DISTINCT FROM s6.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM u
"""


@query("op3_mixing", _MIX_SQL)
def op3_mixing(spark, sf_dir):
    """Words that the mix takes of every document."""
    from shelfwise.llm.mixing import with_copies
    out = with_copies(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select(F.col("rec.doc_id").alias("doc_id"), "size", "source_size", "target",
                      (F.col("size") * F.col("copies")).alias("taken"))


_EXACT_SQL = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g') AS norm FROM documents),
h AS (SELECT doc_id, points, sha256(norm) AS text_sha256 FROM d),
g AS (
  SELECT doc_id, text_sha256,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size FROM h)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM g
"""


@query("op7_exact_dedup", _EXACT_SQL)
def op7_exact_dedup(spark, sf_dir):
    """Owner, group size and digest of every document."""
    from shelfwise.llm.exact_dedup import owners
    return owners(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op9_near_dedup")
def op9_near_dedup(spark, sf_dir):
    """Near-duplicate component of every document: 3-word shingles, similarity 0.85."""
    from shelfwise.llm.near_dedup import near_components
    out = near_components(table(spark, sf_dir, "documents").select("doc_id", "text"), width=3, percent=85)
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


@query("op4_toxicity")
def op4_toxicity(spark, sf_dir):
    """Toxicity score of every document; rows of the held-out fifth never train."""
    from shelfwise.llm.toxicity import fit, held_out, score
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    return score(docs, fit(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op8_bpe")
def op8_bpe(spark, sf_dir):
    """Token count and digests of the ids and of the decoded text of every document."""
    from shelfwise.llm.bpe import encode
    out = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary_path(), decode=True)
    return out.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query("op6_quality")
def op6_quality(spark, sf_dir):
    """Base counts, distances and verdict of every document."""
    from shelfwise.llm.quality import judge
    return judge(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).drop("chars")


@query("op10_pii")
def op10_pii(spark, sf_dir):
    """Base and discovered spans of personal data of every document."""
    from shelfwise.llm.pii import BASE_KINDS, find, joined
    out = find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.size(F.array_remove(F.transform("base", lambda x: F.when(x["kind"] == F.lit(k), 1).otherwise(0)), 0))
              .cast("long").alias(f"n_{name}") for k, name in enumerate(BASE_KINDS)]
    return out.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                      joined(F.array_sort(F.concat("base", "added"))).alias("spans"))


def _warc_sql() -> str:
    from shelfwise.llm.warc import oracle
    return oracle()


@query("op2_warc", _warc_sql())
def op2_warc(spark, sf_dir):
    """Metadata and conversion records of every page."""
    from shelfwise.llm.warc import derivatives, responses
    return derivatives(responses(table(spark, sf_dir, "pages").select("page_id", "url", "html"))).drop("date")


@query("op5_licences")
def op5_licences(spark, sf_dir):
    """Licence families of every document's paragraphs."""
    from shelfwise.llm.licenses import fit_and_scan
    return fit_and_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


_RESAMPLING_SQL = r"""
WITH t8 AS (
  SELECT list(list_reduce(list_prepend(b::UINTEGER, range(8)::UINTEGER[]),
    lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UINTEGER) ELSE c >> 1 END) ORDER BY b) AS tab
  FROM range(256) r(b)),
d AS (
  SELECT doc_id, 0 AS side, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
dw AS (SELECT w, count(*) AS n FROM (SELECT unnest(ws) AS w FROM d) GROUP BY w),
bw AS (SELECT w, count(*) AS n FROM (SELECT unnest(ws) AS w FROM b) GROUP BY w),
vocab AS (SELECT w, hex(encode(w)) AS x FROM (SELECT w FROM dw UNION SELECT w FROM bw)),
crc AS (
  SELECT w, (xor(list_reduce(list_prepend(4294967295::UINTEGER,
      list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::UINTEGER)),
      lambda c, y: xor(tab[1 + (xor(c, y) & 255)], c >> 8)), 4294967295::UINTEGER) % 10000)::INTEGER AS bucket
  FROM vocab, t8),
s AS (SELECT bucket, sum(n)::DOUBLE AS s FROM dw JOIN crc USING (w) GROUP BY bucket),
t AS (SELECT bucket, sum(n)::DOUBLE AS t FROM bw JOIN crc USING (w) GROUP BY bucket),
tot AS (SELECT coalesce((SELECT sum(s) FROM s), 0.0)::DOUBLE AS ss, coalesce((SELECT sum(t) FROM t), 0.0)::DOUBLE AS tt),
g AS (
  SELECT bucket, floor(1000.0::DOUBLE * ln((coalesce(t, 0.0)::DOUBLE + 1.0::DOUBLE) * (ss + 10000.0::DOUBLE)
      / ((coalesce(s, 0.0)::DOUBLE + 1.0::DOUBLE) * (tt + 10000.0::DOUBLE))))::BIGINT AS gain
  FROM s FULL JOIN t USING (bucket), tot),
wg AS (SELECT w, gain FROM crc JOIN g USING (bucket)),
u AS (SELECT row_number() OVER () AS uid, doc_id, ws FROM d),
wt AS (SELECT uid, sum(gain)::BIGINT AS weight FROM (SELECT uid, unnest(ws) AS w FROM u) JOIN wg USING (w) GROUP BY uid),
sc AS (
  SELECT u.uid, doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    (coalesce(weight, 0) + floor(-1000.0::DOUBLE * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE
      + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT)::BIGINT AS score
  FROM u LEFT JOIN wt USING (uid)),
rk AS (
  SELECT uid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, uid) AS rank, count(*) OVER () AS n
  FROM sc WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank FROM sc LEFT JOIN rk USING (uid)
"""


@query("op11_resampling", _RESAMPLING_SQL)
def op11_resampling(spark, sf_dir):
    """Weight, score and rank of every document, drawn towards the benchmark's words."""
    from shelfwise.llm.resampling import resample
    return resample(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")).drop("n_words")


def _secret_sql() -> str:
    from shelfwise.llm.secret_scan import oracle
    return oracle()


@query("op13_secrets", _secret_sql())
def op13_secrets(spark, sf_dir):
    """Secrets in every document, through a ledger that starts empty."""
    from shelfwise.llm.common import scratch_folder
    from shelfwise.llm.secret_scan import BASE, joined, scan
    out = scan(table(spark, sf_dir, "documents").select("doc_id", "text"), scratch_folder(spark, "ledger"))
    kinds = [F.size(F.filter("spans", lambda x: x["kind"] == F.lit(r.name))).cast("long").alias(f"n_{r.name}") for r in BASE]
    base = F.filter("spans", lambda x: x["place"] < len(BASE))
    return out.select("doc_id", *kinds, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


@query("op12_whitening")
def op12_whitening(spark, sf_dir):
    """Whitened coordinates of every usable vector, one row per component."""
    from shelfwise.llm.whitening import whiten
    out = whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    both = F.explode(F.arrays_zip(F.sequence(F.lit(1), F.size("explained")).alias("component"), "whitened", "explained"))
    return (out.where(F.size("explained") > 0).select("vec_id", "n", "deviation", "identity_error", both.alias("c"))
            .select("vec_id", F.col("c.component").cast("int").alias("component"), "n",
                    F.expr("try_cast(deviation AS bigint)").alias("deviation"), F.col("c.whitened").alias("whitened"),
                    F.col("c.explained").alias("explained"), "identity_error"))
