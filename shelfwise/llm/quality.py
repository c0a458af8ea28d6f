"""Quality rules by distribution divergence, with DataFrame functions only.

Each text gets a histogram of character classes and one of common words. Both
are compared with the reference of the text's language by Jensen-Shannon
distance (base 2, so 0 to 1); a text far from its language is rejected. How far
words may stray is taken from each language: a text without any common word is
always beyond it. Every
text is judged; below CLASS_CHARS characters or JUDGED_WORDS words the largest
distance grows by what a histogram of so few draws strays from its reference
(its expected squared distance is proportional to 1 / length).

The references are the corpus's own: the sum over all documents of a language
of their shares, each weighing with the square root of its length, so that every
document counts whole and no long one sets the reference. They are one row per
language and are gathered by a partial aggregate; up to BROADCAST_LANGUAGES of
them (a kilobyte each) go to every task, and documents are not shuffled.

Per-document counts stay inside the row (no row per word); the histograms are
written once to the shared folder and the verdict is a second pass over those
few numbers.

Defined results: null text counts as empty (no words, fails the word minimum);
a null language is a language of its own; repeated rows are judged alike; an
empty table gives no rows; columns named like the outputs are replaced in the
result, which holds doc_id and measures only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import WS_CLASS, staged

#: The commonest words of the corpus's languages.
COMMON_WORDS = (
    "the of and to a in is that it was for on are as with at be this from or had by not but what "
    "de la que el en y los se del las un por con no una su al lo para es "
    "le et les des à une du est dans qui pour pas au sur ne ce plus "
    "der die und das von zu den mit ist im für auf nicht ein eine als auch sich dem"
).split()
SYMBOLS = "#*$%&|<>"
#: Base rules.
MIN_WORDS, WINDOW, MAX_REPEAT_PERCENT = 20, 8, 30
#: Verdict: largest distances of texts of at least so many characters and words.
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.30, 0.32
#: A language whose reference is at least so far from a text without any common
#: word has a limit of its own, this share of that distance.
BARE_DISTANCE, BARE_SHARE = 0.25, 0.97
CLASS_CHARS, JUDGED_WORDS = 400, 100
#: Growth of the squared distance with 1 / length: four times (characters come in
#: clumps) the expected 6 / (8 ln 2) of 7 classes; for words about the rise
#: of the upper quantiles of shorter texts at sf0.1.
CLASS_NOISE, WORD_NOISE = 4.33, 2.0
BROADCAST_LANGUAGES = 10_000


def _pairs(x: Column, step: int, n: Column) -> Column:
    """Order-dependent hash of every element with the one ``step`` later; n: length of x."""
    m = F.greatest(n - step, F.lit(0))
    return F.zip_with(F.slice(x, F.lit(1), m), F.slice(x, F.lit(step + 1), m), lambda a, b: F.xxhash64(a, b))


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, base counts, and both histograms of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), text.alias("t"))
    d = d.withColumn("w", F.array_remove(F.split("t", WS_CLASS + "+"), ""))
    n = F.size("w")
    d = d.withColumns({"n": n, "chars": F.char_length("t"), "word_chars": F.char_length(F.array_join("w", ""))})
    left = F.col("t")
    for c in SYMBOLS:
        left = F.replace(left, F.lit(c), F.lit(""))
    d = d.withColumn("n_symbols", F.col("chars") - F.char_length(left))

    # lines with a word that equal an earlier line
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = d.withColumn("lines", lines).withColumn("n_dup_lines", F.size("lines") - F.size(F.array_distinct("lines")))

    # hashes of the 8-word windows, by doubling: 1, 2, 4, 8 words
    d = d.withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))
    for step in (1, 2, 4):
        d = d.withColumn("h", _pairs(F.col("h"), step, F.size("h")))
    twice = F.size("h") > F.size(F.array_distinct("h"))
    # only texts with a repeated window go on: sort (hash, place), keep places whose neighbour has the same hash
    place = F.when(twice, F.array_sort(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
    d = d.withColumn("p", place)
    again = F.filter("p", lambda x, k: F.coalesce(x["h"] == F.get("p", k - 1)["h"], F.lit(False))
                     | F.coalesce(x["h"] == F.get("p", k + 1)["h"], F.lit(False)))
    again = F.transform(again, lambda x: x["i"])
    d = d.withColumn("p", F.sort_array(_guarded(again)))
    # every window covers WINDOW words; overlapping ones count shared words once
    nxt = F.zip_with("p", F.slice("p", 2, F.greatest(F.size("p") - 1, F.lit(0))),
                     lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
    covered = F.aggregate(nxt, F.lit(0), lambda s, x: s + x)
    d = d.withColumn("n_repeat_words", F.when(F.size("p") > 0, covered).otherwise(0))

    def count(pattern: str) -> Column:
        return F.char_length(F.regexp_replace("t", pattern, ""))
    d = d.withColumns({"upper": count("[^A-Z]+"), "lower": count("[^a-z]+"), "digit": count("[^0-9]+"),
                       "other": count(r"[\x00-\x7F]+")})
    # punctuation: what is neither white space, symbol, letter, digit nor beyond ASCII
    punct = F.col("word_chars") - F.col("n_symbols") - F.col("upper") - F.col("lower") - F.col("digit") - F.col("other")
    classes = F.array(*[x.cast("double") for x in (
        F.col("upper"), F.col("lower"), F.col("digit"), F.col("other"), F.col("n_symbols"),
        F.greatest(punct, F.lit(0)), F.col("chars") - F.col("word_chars"))])
    common = F.filter("w", lambda x: x.isin(COMMON_WORDS))
    d = d.withColumns({"classes": classes, "c": common})
    # the common words as one string, each between spaces of its own: a word's count is what deleting it shortens
    d = d.withColumn("s", F.concat(F.lit(" "), F.array_join("c", "  "), F.lit(" ")))
    hits = [((F.octet_length("s") - F.octet_length(F.replace("s", F.lit(f" {x} "), F.lit(""))))
             / (len(x.encode()) + 2)) for x in COMMON_WORDS]
    rest = (F.col("n") - F.size("c")).cast("double")
    return d.select("doc_id", "lang", F.col("n").cast("long").alias("n_words"),
                    *[F.col(c).cast("long").alias(c) for c in ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "chars")],
                    "classes", F.array(rest, *hits).alias("common"))


def _guarded(a: Column) -> Column:
    return F.coalesce(a, F.array().cast("array<int>"))


def _share(a: Column) -> Column:
    total = F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    # the sum is bound once, not added up again for every element
    return F.get(F.transform(F.array(total), lambda t: F.transform(a, lambda x: F.when(t > 0, x / t).otherwise(0.0))), F.lit(0))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (square root of the base-2 divergence) of two
    histograms that each add up to one."""
    def term(x, m):
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    both = F.zip_with(p, q, lambda x, y: 0.5 * (term(x, (x + y) / 2) + term(y, (x + y) / 2)))
    return F.sqrt(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.aggregate(both, F.lit(0.0), lambda s, x: s + x))))


def references(m: DataFrame, names: dict[str, int]) -> DataFrame:
    """One row per language: reference histograms, each adding up to one.
    Sums are of whole numbers (shares in parts of 2^-20), so reruns agree."""
    scale = F.lit(float(1 << 20))
    sums = []
    for c, n in names.items():
        total = F.aggregate(F.col(c), F.lit(0.0), lambda s, x: s + x)
        weight = F.when(total > 0, 1 / F.sqrt(total)).otherwise(0.0)
        sums += [F.sum(F.round(F.col(c)[i] * weight * scale).cast("long")).cast("double").alias(f"{c}{i}") for i in range(n)]
    r = m.groupBy("lang").agg(*sums)
    r = r.select(F.col("lang").alias("ref_lang"),
                 *[_share(F.array(*[f"{c}{i}" for i in range(n)])).alias(f"ref_{c}") for c, n in names.items()])
    bare = js_distance(F.array(F.lit(1.0), *[F.lit(0.0)] * (names["common"] - 1)), F.col("ref_common"))
    return r.withColumn("bare", bare).withColumn("word_limit", F.when(F.col("bare") >= BARE_DISTANCE, F.col("bare") * BARE_SHARE)
                                                 .otherwise(MAX_WORD_DISTANCE)).drop("bare")


def _largest(distance: Column, noise: float, n: Column, full: int) -> Column:
    """Largest distance of a text of length n: ``distance`` from length ``full`` on."""
    more = noise * (1 / F.greatest(n, F.lit(1)) - 1 / full)
    return F.when(n >= full, distance).otherwise(F.sqrt(distance * distance + more))


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, base counts, base_failed, both distances and the verdict ``kept``."""
    m = staged(measures(docs))
    refs = references(m, {"classes": 7, "common": len(COMMON_WORDS) + 1})
    refs = staged(refs)
    refs = F.broadcast(refs) if refs.count() <= BROADCAST_LANGUAGES else refs       # beyond, a shuffle by language
    j = m.join(refs, F.col("lang").eqNullSafe(F.col("ref_lang")))
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    j = j.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "chars", "word_limit",
                 base_failed.alias("base_failed"),
                 js_distance(_share(F.col("classes")), F.col("ref_classes")).alias("class_distance"),
                 js_distance(_share(F.col("common")), F.col("ref_common")).alias("word_distance"))
    far = ((F.col("class_distance") > _largest(F.lit(MAX_CLASS_DISTANCE), CLASS_NOISE, F.col("chars"), CLASS_CHARS))
           | (F.col("word_distance") > _largest(F.col("word_limit"), WORD_NOISE, F.col("n_words"), JUDGED_WORDS)))
    return j.withColumn("kept", ~F.col("base_failed") & ~far).drop("word_limit")
