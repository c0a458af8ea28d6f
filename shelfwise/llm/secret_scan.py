"""Secret scan with an incremental ledger of content-addressed blobs.

Versions of files (rows with any identifying columns and a text) are scanned the
way a repository's history is: most versions repeat content that is known.

1. Every version's text gets a content address, the SHA-256 of its UTF-8 bytes.
   Rows and addresses, without texts, are written once.
2. The ledger is a Parquet folder of facts (blob, rules, findings): these rules,
   each named with its version, were run over that blob and found that. Facts
   never change, so the folder is only appended to; a run that dies half way
   leaves true facts, and a fact written twice is read as one.
3. Pairs of blob and rule version that the ledger lacks are what is left to do:
   the addresses present are anti-joined with it, and each unseen blob is given
   the list of rules it still needs. After a change of one rule, old blobs get
   that rule alone.
4. One copy of each unseen blob is scanned (copies are reduced before the
   shuffle, so a text that a third of all rows share travels once a task), and
   the facts are appended.
5. The findings of all current rules are joined back to every row by address;
   rows of one blob are dealt over SALTS keys, as a third of all rows may share it.

A rule matches greedy runs from the left, without overlaps; a match that fails
the rule's length or form is dropped and the search goes on behind it. No
pattern can backtrack over more than its own match, so time is linear.

Defined results: null text counts as empty; offsets are code points, ends
exclusive; repeated rows and rows of equal text get equal findings; input
columns named blob or spans are replaced; an empty table gives no rows and
appends no facts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import bounded_batches, quoted, staged

#: Up to so many unseen blobs (some 100 bytes each) are sent to all tasks, so that
#: only their texts are shuffled; beyond, all texts are reduced to one a blob first.
BROADCAST_BLOBS = 200_000
#: Rows of one blob are dealt over so many keys when findings are joined to them.
SALTS = 16


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds maximal runs; ``group`` must have ``least`` characters and
    ``form``, if given, must match the whole run. ``hints``: lower-case strings, one of
    which every match holds. A change of any of them needs a new ``version``."""

    name: str
    version: int
    pattern: str
    least: int = 1
    group: int = 0
    form: str = ""
    hints: tuple[str, ...] = ()

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


def either_case(pattern: str) -> str:
    """``pattern`` with each letter in both cases (ASCII only, unlike a flag)."""
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", pattern)


# The three base rules.
BASE = (
    Rule("assign", 1, "(" + either_case("password|passwd|secret|token|api_?key") + r")[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
         least=12, group=2, hints=("password", "passwd", "secret", "token", "apikey", "api_key")),
    Rule("access", 1, "AKIA[A-Z0-9]+", least=18, hints=("akia",)),
    Rule("hex", 1, "[0-9a-f]{16,}", least=16),       # equal to runs of any length with the short ones dropped
)
#: Public forms of issued credentials, keys and passwords in addresses.
ISSUED = (
    Rule("pem", 1, "-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----", hints=("private key",)),
    Rule("github", 1, "gh[pousr]_[A-Za-z0-9]+", least=40, hints=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("slack", 1, "xox[abprs]-[A-Za-z0-9-]+", least=15, hints=("xox",)),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_.-]+", form=r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", hints=("eyj",)),
    Rule("bearer", 1, either_case("bearer") + r"\x20+([A-Za-z0-9+/_.=-]+)", least=20, group=1, hints=("bearer",)),
    Rule("url", 1, "://[^\\x00-\\x20/@\"'<>]+@", form="://[^:]+:.{3,}@", hints=("://",)),
)
RULES = BASE + ISSUED

_FINDING = pa.struct([("rule", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_FINDINGS = "array<struct<rule:string,start:bigint,end:bigint>>"
_FACT = f"blob binary, rules array<string>, findings {_FINDINGS}"


def spans(text: str, low: str, rule: Rule, run: re.Pattern, form: re.Pattern | None) -> list[tuple[int, int]]:
    """Spans of a rule in a text; ``low`` is the lower-cased text."""
    if rule.hints and not any(h in low for h in rule.hints):
        return []
    return [m.span() for m in run.finditer(text)
            if m.end(rule.group) - m.start(rule.group) >= rule.least and (form is None or form.fullmatch(m[0]))]


def scanner(rules: tuple[Rule, ...]):
    """Function over Arrow batches (blob, text, todo) to facts."""
    def run(batches):
        ready = {r.key: (r, re.compile(r.pattern), re.compile(r.form, re.S) if r.form else None) for r in rules}
        for batch in batches:
            found = []
            todo = batch.column("todo").to_pylist()
            for text, keys in zip(batch.column("text").to_pylist(), todo):
                low = text.lower()
                found.append([{"rule": k, "start": a, "end": b} for k in keys for a, b in spans(text, low, *ready[k])])
            yield pa.RecordBatch.from_arrays([batch.column("blob"), pa.array(todo, pa.list_(pa.string())),
                                              pa.array(found, pa.list_(_FINDING))], names=["blob", "rules", "findings"])
    return run


def blob(text: Column) -> Column:
    """Content address of a text."""
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """All facts; a folder that does not exist yet is made, with none."""
    spark.createDataFrame([], _FACT).write.mode("ignore").parquet(ledger)
    return spark.read.schema(_FACT).parquet(ledger)


def unseen(blobs: DataFrame, facts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, todo): the blobs that lack facts of some rules, and those rules."""
    wanted = F.array(*[F.lit(r.key) for r in rules])
    done = facts.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_set("rules"))).alias("done"))
    todo = F.array_except(wanted, F.coalesce("done", F.array().cast("array<string>")))
    return (blobs.select("blob").distinct().join(done, "blob", "left").select("blob", todo.alias("todo"))
            .where(F.size("todo") > 0))


def scan_unseen(contents: DataFrame, todo: DataFrame, rules: tuple[Rule, ...], ledger: str) -> None:
    """Scan one copy of each blob of ``todo`` and append the facts. ``contents``
    has (blob, text), copies included."""
    bounded_batches(contents.sparkSession)
    if todo.count() <= BROADCAST_BLOBS:
        contents = contents.join(F.broadcast(todo.select("blob")), "blob", "left_semi")
    copies = contents.groupBy("blob").agg(F.first("text").alias("text"))
    copies.join(todo, "blob").select("blob", "text", "todo").mapInArrow(scanner(rules), _FACT).write.mode("append").parquet(ledger)


def known_findings(facts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, spans) of the blobs in which current rules found something, by
    start, then the order of the rules, then end."""
    place = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.key), F.lit(i))])
    name = F.create_map(*[x for r in rules for x in (F.lit(r.key), F.lit(r.name))])
    return (facts.where(F.size("findings") > 0).select("blob", F.explode("findings").alias("f"))
            .where(F.col("f.rule").isin([r.key for r in rules]))
            .groupBy("blob").agg(F.array_sort(F.collect_set(F.struct(
                F.col("f.start").alias("start"), place[F.col("f.rule")].alias("place"), F.col("f.end").alias("end"),
                name[F.col("f.rule")].alias("kind")))).alias("spans")))


def scan(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``versions`` without the text, plus blob (its address) and spans (array of
    start, place, end, kind). ``ledger`` is brought up to date on the way."""
    spark = versions.sparkSession
    rec = F.struct(*[quoted(c) for c in versions.columns if c not in (text, "blob", "spans")])
    rows = staged(versions.select(rec.alias("rec"), blob(quoted(text)).alias("blob"),
                                  (F.monotonically_increasing_id() % SALTS).cast("int").alias("salt")))
    todo = staged(unseen(rows, read_ledger(spark, ledger), rules))
    if not todo.isEmpty():
        body = F.coalesce(quoted(text).cast("string"), F.lit(""))
        scan_unseen(versions.select(blob(quoted(text)).alias("blob"), body.alias("text")), todo, rules, ledger)
    found = known_findings(read_ledger(spark, ledger), rules).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    none = F.array().cast("array<struct<start:bigint,place:int,end:bigint,kind:string>>")
    return rows.join(found, ["blob", "salt"], "left").select("rec.*", "blob", F.coalesce("spans", none).alias("spans"))


def joined(found: Column) -> Column:
    """kind:start:end of an array of spans, comma-joined."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def oracle() -> str:
    """DuckDB SQL of the whole scan over documents: the text between matches and
    the matches themselves give the places."""
    def quote(s):
        return "'" + s.replace("'", "''") + "'"

    parts = []
    for i, r in enumerate(RULES):
        ok = f"length(regexp_extract(m[k], {quote(r.pattern)}, {r.group})) >= {r.least}"
        if r.form:
            ok += f" AND regexp_full_match(m[k], {quote(r.form)}, 's')"
        parts.append(f"""
  SELECT uid, {i} AS place, {quote(r.name)} AS kind, a AS "start", a + length(m[k]) AS "end" FROM (
    SELECT uid, m, k, (list_sum(list_transform(p[1:k], lambda x: length(x)))
                       + coalesce(list_sum(list_transform(m[1:k - 1], lambda x: length(x))), 0))::BIGINT AS a
    FROM (SELECT uid, m, p, unnest(range(1, len(m) + 1)) AS k FROM (
      SELECT uid, regexp_extract_all(text, {quote(r.pattern)}) AS m, string_split_regex(text, {quote(r.pattern)}) AS p FROM d)))
  WHERE {ok}""")
    span = "kind || ':' || \"start\" || ':' || \"end\""
    return f"""
WITH d AS (SELECT row_number() OVER () AS uid, doc_id, coalesce(text, '') AS text FROM documents),
f AS ({" UNION ALL".join(parts)}),
g AS (
  SELECT uid, count(*) FILTER (place = 0) AS a, count(*) FILTER (place = 1) AS b, count(*) FILTER (place = 2) AS c,
         string_agg({span}, ',' ORDER BY "start", place) FILTER (place < 3) AS base,
         string_agg({span}, ',' ORDER BY "start", place) AS spans FROM f GROUP BY uid)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(b, 0)::BIGINT AS n_access, coalesce(c, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (uid)
"""
