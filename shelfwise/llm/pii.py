"""Personal data: base patterns, and identifiers found from their contexts.

Base spans (e-mail, IP address, payment card, phone) come from fixed patterns.
They seed a bootstrap over lexical patterns, in the manner of DIPRE and
Snowball. Long tokens that mix letters and digits (keys, account and device
numbers) are weak seeds of a kind of their own, ``id``: they are evidence, but
are reported only where a pattern confirms them.

1. One pass over the texts takes every base span, every weak seed and every
   other token with a digit or "@", of any length, each with its contexts. Four
   kinds of context are nodes of the graph: the word left of the identifier, the
   two words left, the word right, and the words left and right. Neighbouring
   tokens of digits, brackets and the like on one line are also taken together,
   as one identifier; a span inside a longer added one is left out.
2. Contexts with two or more different known instances may become patterns. A
   pass over the texts counts how often those contexts stand around any word at
   all; contexts that come up in a later round are counted then, so the counted
   ones follow the evidence, not all numbers of the corpus. Contexts travel as a
   bitmap of fixed size; counts are then joined to them exactly.
3. Spark scores the graph of patterns and instances in rounds: a pattern's
   confidence for a kind is the confidence of the instances seen in it over all
   its occurrences, an instance's confidence is that of its best pattern (seeds
   have 1). How many different instances a pattern needs depends on its
   confidence (SUPPORT). The tokens in accepted patterns are new instances; those
   of FIRM characters or more count as evidence in their other contexts, until a
   round changes no value, kind or confidence. Evidence only grows, and
   confidences are rounded down, so that happens.
4. Tokens outside base spans are spans where they stand in an accepted pattern,
   and firm discovered values wherever they stand (a value like "5" says
   something in its context only).

Defined results: offsets are code points, ends exclusive; null text counts as
empty and has no spans; a value found as two kinds takes the more confident,
then the first listed; repeated rows get equal spans; in place of
words before the start or after the end of a text, contexts hold a mark, and
marks alone are no context; an empty table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import LOWER, bounded_batches, chain, sha256_hex, staged, text_bytes, word_hashes, word_spans

#: Fixed order of the kinds in results.
KINDS = ("email", "ip", "card", "phone", "id")
#: Kinds that the base patterns find; the last one is found by contexts alone.
BASE_KINDS, ID = KINDS[:4], 4
#: Least confidence of patterns, and the different instances that they need from which confidence on.
SUPPORT = ((1.0, 2), (0.9, 3), (0.8, 5))
#: Characters from which a discovered value stands for itself, without its context.
FIRM = 6
DIGITS = 6             # decimals of confidences, rounded down, so that rounds come to an end
BITMAP_BITS = 24       # 2 MB, whatever the corpus
#: Context counts that a task holds (16 bytes each).
HELD = 1 << 20
#: Longer values are known by their digest.
LONG_VALUE = 200

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: A word that may be a part of a number of several words, and what ends one.
_RUN = re.compile(r"[(\[]*[0-9][0-9()\[\]./+-]*")
_ENDS = re.compile(r"\n|[,;:!?.](?=[\x20\x09-\x0D])")
#: A weak seed: 16 ASCII letters and digits or more, at least three of either.
_MIXED = re.compile(r"(?=(?:[A-Za-z]*[0-9]){3})(?=(?:[0-9]*[A-Za-z]){3})[A-Za-z0-9]{16,}")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_TRIM = "\"'`([{<)]}>.,;:!?*%$&#|=\\/"


def _emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        done = m.end() if m else at + 1
        if m:
            yield start, m.end()
        at = text.find("@", done)


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        if i % 2:
            v = v * 2 - 9 if v > 4 else v * 2
        total += v
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end), by kind, then start."""
    found = [(0, a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in m[0].split("."))):
            found.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 13 <= len(digits) <= 19 and _luhn(digits):
            found.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            found.append((3, *m.span()))
    return found


#: Stand for words before the start and after the end of a text in contexts.
START, END = np.uint64(0x5EED0FA7E47B0001), np.uint64(0x5EED0FA7E47B0002)
_TAGS = np.arange(1, 5, dtype=np.uint64)        # kinds of context


def _contexts(two: np.ndarray, one: np.ndarray, right: np.ndarray) -> list[np.ndarray]:
    """Hashes of the four contexts of places with these words before and after them."""
    tag = [np.full(len(one), t) for t in _TAGS]
    return [chain(tag[0], one), chain(tag[1], two, one), chain(tag[2], right), chain(tag[3], one, right)]


_MARKS = np.zeros(256, bool)
_MARKS[[*range(48, 58), 64]] = True
_ITEM = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string()),
                   ("ctx", pa.list_(pa.int64()))])


def _items(text: str, raw: np.ndarray) -> list[dict]:
    """Base spans (kind 0 to 3), weak seeds (kind ID) and other identifier-like
    tokens (kind -1) of a text, each with its contexts."""
    spans = base_spans(text)
    low = LOWER[raw]
    starts, ends, _ = word_spans(low, np.array([0, len(raw)]))
    marks = np.concatenate([[0], np.cumsum(_MARKS[raw])])
    point = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])       # code points before each byte
    word_at = point[starts]
    out = []

    def add(kind, a, b, value):
        k, m = (int(np.searchsorted(word_at, x, "right")) - 1 for x in (a, b - 1))
        lo = max(k - 2, 0)
        left = np.concatenate([np.full(2 - (k - lo), START), word_hashes(low, starts[lo:k], ends[lo:k])])
        right = word_hashes(low, starts[m + 1:m + 2], ends[m + 1:m + 2]) if m + 1 < len(starts) else np.array([END])
        # marks alone say nothing
        words_there = (k > 0, k > 0, m + 1 < len(starts), k > 0 or m + 1 < len(starts))
        ctx = [int(h.view(np.int64)[0]) for h, some in zip(_contexts(left[:1], left[1:], right), words_there) if some]
        value = value.lower()
        value = value if len(value) <= LONG_VALUE else sha256_hex(value.encode())
        out.append({"kind": kind, "start": int(a), "end": int(b), "value": value, "ctx": ctx})

    for kind, a, b in spans:
        add(kind, a, b, text[a:b])
    covered = sorted((a, b) for _, a, b in spans)
    reach, i = 0, 0
    run = []               # places of neighbouring words that may be parts of one number

    def close():
        """Add the words of the run as one identifier."""
        if len(run) > 1:
            a, b = int(point[starts[run[0]]]), int(point[ends[run[-1]]])
            whole = text[a:b].rstrip(_TRIM.replace(")", ""))
            a += len(whole) - len(whole.lstrip(_TRIM.replace("(", "")))
            whole = whole.lstrip(_TRIM.replace("(", ""))
            while whole.endswith(")") and whole.count("(") < whole.count(")"):
                whole = whole[:-1]
            if whole.startswith("(") and ")" not in whole:
                a, whole = a + 1, whole[1:]
            if whole:
                add(-1, a, a + len(whole), whole)
        run.clear()

    for k in np.flatnonzero(marks[ends] > marks[starts]):
        a, b = int(point[starts[k]]), int(point[ends[k]])
        while i < len(covered) and covered[i][0] < b:
            reach = max(reach, covered[i][1])
            i += 1
        if a < reach:
            close()
            continue
        if not (run and run[-1] == k - 1 and _RUN.fullmatch(text[a:b].rstrip(_TRIM) or " ") and not _ENDS.search(
                text[int(point[starts[k - 1]]):a])):
            close()
        if run or _RUN.fullmatch(text[a:b]):
            run.append(k)
        token = text[a:b]
        a += len(token) - len(token.lstrip(_TRIM))
        token = token.strip(_TRIM)
        if any(c in "0123456789@" for c in token):
            add(ID if _MIXED.fullmatch(token) else -1, a, a + len(token), token)
    close()
    return out


def _extract(batches):
    for batch in batches:
        raw, offsets = text_bytes(batch.column("text"))
        marks = np.concatenate([[0], np.cumsum(_MARKS[raw])])
        some = marks[offsets[1:]] > marks[offsets[:-1]]      # every identifier holds a digit or "@"
        items = [_items(raw[offsets[i]:offsets[i + 1]].tobytes().decode(), raw[offsets[i]:offsets[i + 1]]) if some[i] else []
                 for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays([batch.column("uid"), batch.column("doc_id"), pa.array(items, pa.list_(_ITEM))],
                                         names=["uid", "doc_id", "items"])


def _bit(ctx: np.ndarray) -> np.ndarray:
    return (ctx.view(np.uint64) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def _count_contexts(bitmap):
    """Counts of the marked contexts over a task's texts, added up in the task;
    from HELD different ones on they are passed on and counting starts afresh."""
    def run(batches):
        bits = np.unpackbits(np.frombuffer(bitmap.value, np.uint8)).astype(bool)
        parts, size = [], 0

        def added():
            ctx, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return ctx, np.bincount(at, np.concatenate([p[1] for p in parts]), len(ctx)).astype(np.int64)

        def rows(ctx, n):
            return pa.RecordBatch.from_arrays([pa.array(ctx, pa.int64()), pa.array(n, pa.int64())], names=["ctx", "n"])
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            low = LOWER[raw]
            starts, ends, first = word_spans(low, offsets)
            w = word_hashes(low, starts, ends)
            if not len(w):
                continue
            # two marks before the first word of every text that has one, one behind its last
            row = np.flatnonzero(np.diff(first))
            n = np.diff(first)[row]
            w = np.insert(w, np.concatenate([np.repeat(first[row], 2), first[row] + n]),
                          np.concatenate([np.full(2 * len(row), START), np.full(len(row), END)]))
            # places of the words themselves
            at = np.arange(n.sum()) + np.repeat(3 * np.arange(len(row)) + 2, n)
            for one in _contexts(w[at - 2], w[at - 1], w[at + 1]):
                one = one.view(np.int64)
                parts.append(np.unique(one[bits[_bit(one)]], return_counts=True))
                size += len(parts[-1][0])
            if size > HELD:
                parts = [added()]
                size = len(parts[0][0])
                if size > HELD // 2:
                    yield rows(*parts[0])
                    parts, size = [], 0
        if parts:
            yield rows(*added())
    return run


def _bitmap(contexts: DataFrame) -> np.ndarray:
    """Mask of the contexts' leading bits: parts of it are put together by Spark,
    so 2 MB reach the driver whatever the number of contexts."""
    bit = F.shiftrightunsigned("ctx", 64 - BITMAP_BITS) + 1
    parts = (contexts.groupBy(F.bitmap_bucket_number(bit).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")))
    out = np.zeros(1 << BITMAP_BITS, bool)
    for r in parts.collect():
        held = np.unpackbits(np.frombuffer(bytes(r["bits"]), np.uint8), bitorder="little").astype(bool)
        out[(r["part"] - 1) * len(held):r["part"] * len(held)] = held
    return out


def extract(docs: DataFrame) -> DataFrame:
    """(uid, doc_id, items): one row per document with its base spans and
    identifier-like tokens; written once to the shared folder."""
    bounded_batches(docs.sparkSession)
    slim = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return staged(slim.mapInArrow(_extract, "uid long, doc_id long, items array<struct<kind:int,start:bigint,end:bigint,"
                                            "value:string,ctx:array<bigint>>>"))


def patterns(docs: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted patterns (kind, ctx, confidence) and discovered instances
    (value, kind, confidence) after the last round."""
    spark = docs.sparkSession
    every = found.select(F.explode("items").alias("i")).select("i.value", "i.kind", F.explode("i.ctx").alias("ctx"))
    # graph edges: how often each value stands in each context
    edges = staged(every.groupBy("ctx", "value", "kind").agg(F.count(F.lit(1)).alias("n")))
    held = staged(edges.groupBy("ctx").agg(F.sum("n").alias("held")))

    def totals(contexts: DataFrame) -> DataFrame:
        """(ctx, total): how often the contexts stand around a word."""
        bitmap = spark.sparkContext.broadcast(np.packbits(_bitmap(contexts)).tobytes())
        n = docs.select("text").mapInArrow(_count_contexts(bitmap), "ctx long, n long").groupBy("ctx").agg(F.sum("n").alias("n"))
        # identifiers of several words, or several in a word, are not among the counted places
        return staged(contexts.join(held, "ctx").join(n, "ctx", "left")
                      .select("ctx", F.greatest("held", F.coalesce("n", F.lit(0))).alias("total")))

    def down(c: Column) -> Column:
        return F.floor(c * 10 ** DIGITS) / 10 ** DIGITS

    enough = F.lit(False)
    for least, values in SUPPORT:
        enough = enough | ((F.col("confidence") >= least) & (F.col("values") >= values))
    found_here = (F.col("kind") < 0) | (F.col("kind") == ID)
    seeds = edges.where("kind >= 0").withColumn("c", F.lit(1.0))
    new = None     # discovered so far, for every kind: (value, kind, confidence)
    total = None   # contexts counted so far
    while True:
        known = seeds
        if new is not None:
            known = known.unionByName(edges.where("kind < 0").drop("kind").join(
                new.where(F.length("value") >= FIRM).withColumnRenamed("confidence", "c"), "value").select(*seeds.columns))
        several = known.groupBy("ctx").agg((F.min("value") < F.max("value")).alias("several")).where("several").select("ctx")
        several = staged(several if total is None else several.join(total, "ctx", "left_anti"))
        if total is None:
            total = totals(several)
        elif not several.isEmpty():
            total = staged(total.unionByName(totals(several)))
        accepted = (known.join(total, "ctx").groupBy("ctx", "kind").agg(
            down(F.sum(F.col("n") * F.col("c")) / F.max("total") + 1e-9).alias("confidence"), F.count_distinct("value").alias("values"))
            .where(enough).select("ctx", "kind", "confidence"))
        accepted = staged(accepted)
        now = staged(edges.where(found_here).select("ctx", "value").join(accepted, "ctx")
                     .groupBy("value", "kind").agg(F.max("confidence").alias("confidence")))
        same = now.isEmpty() if new is None else now.join(new, ["value", "kind", "confidence"], "left_anti").isEmpty()
        new = now
        if same:
            break
    best = F.max_by("kind", F.struct("confidence", -F.col("kind"))).alias("kind")
    return accepted, new.groupBy("value").agg(best, F.max("confidence").alias("confidence"))


def find(docs: DataFrame) -> DataFrame:
    """Per input row: doc_id, base and added spans as arrays of
    (kind number, start, end), each by kind, then start."""
    found = extract(docs)
    accepted, new = patterns(docs, found)
    base = F.array_sort(F.transform(F.filter("items", lambda x: x["kind"].between(0, len(BASE_KINDS) - 1)),
                                    lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))))
    tokens = (found.select("uid", F.explode("items").alias("i")).select("uid", "i.*")
              .where((F.col("kind") < 0) | (F.col("kind") == ID)).drop("kind"))
    place = ["uid", "start", "end"]
    here = tokens.select(*place, F.explode("ctx").alias("ctx")).join(accepted, "ctx").select(*place, "kind", "confidence")
    firm = tokens.join(new.where(F.length("value") >= FIRM), "value").select(*place, "kind", "confidence")
    added = (here.unionByName(firm).groupBy(*place).agg(F.max_by("kind", F.struct("confidence", -F.col("kind"))).alias("kind"))
             .groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end"))).alias("added")))
    # of a run and its parts only the longest discovered one
    inside = lambda x: F.exists("added", lambda y: (y["start"] <= x["start"]) & (y["end"] >= x["end"])
                                & (y["end"] - y["start"] > x["end"] - x["start"]))
    added = added.withColumn("added", F.filter("added", lambda x: ~inside(x)))
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    return (found.select("uid", "doc_id", base.alias("base")).join(added, "uid", "left")
            .select("doc_id", "base", F.coalesce("added", none).alias("added")))


def joined(spans: Column) -> Column:
    """kind:start:end of an array of spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")
