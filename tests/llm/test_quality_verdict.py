"""The quality verdict against a plain version: histograms, references, limits, verdict."""
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np

from shelfwise.llm import quality as Q
from llm.conftest import SCHEMA, edge_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def histograms(text):
    w = WORD.findall(text)
    solid = "".join(w)
    n = Counter("upper" if "A" <= c <= "Z" else "lower" if "a" <= c <= "z" else "digit" if "0" <= c <= "9" else "other" if c > "\x7f"
                else "symbol" if c in Q.SYMBOLS else "punct" for c in solid)
    classes = [n["upper"], n["lower"], n["digit"], n["other"], n["symbol"], n["punct"], len(text) - len(solid)]
    words = Counter(x for x in w if x in Q.COMMON_WORDS)
    return classes, [len(w) - sum(words.values()), *[words[x] for x in Q.COMMON_WORDS]], len(w)


def distance(p, q):
    p, q = (np.array(x, float) / sum(x) if sum(x) else np.zeros(len(x)) for x in (p, q))
    m = (p + q) / 2
    part = lambda x: sum(a * np.log2(a / b) for a, b in zip(x, m) if a > 0)
    return math.sqrt(min(1, max(0, (part(p) + part(q)) / 2)))


def brute(rows):
    refs = defaultdict(lambda: [np.zeros(7), np.zeros(len(Q.COMMON_WORDS) + 1)])
    for _, text, lang, *_ in rows:
        c, w, _ = histograms(text or "")
        for k, h in enumerate((c, w)):
            if sum(h):
                refs[lang][k] += np.array(h) / math.sqrt(sum(h))
    out = []
    for doc, text, lang, *_ in rows:
        c, w, n = histograms(text or "")
        dc, dw = distance(c, refs[lang][0]), distance(w, refs[lang][1])
        bare = distance([1] + [0] * len(Q.COMMON_WORDS), refs[lang][1])
        limit = bare * Q.BARE_SHARE if bare >= Q.BARE_DISTANCE else Q.MAX_WORD_DISTANCE
        grown = lambda d, noise, k, full: d if k >= full else math.sqrt(d * d + noise * (1 / max(k, 1) - 1 / full))
        edge_c, edge_w = (grown(Q.MAX_CLASS_DISTANCE, Q.CLASS_NOISE, len(text or ""), Q.CLASS_CHARS),
                          grown(limit, Q.WORD_NOISE, n, Q.JUDGED_WORDS))
        out.append((doc, dc, dw, dc > edge_c or dw > edge_w, min(abs(dc - edge_c), abs(dw - edge_w))))
    return out


def texts():
    r = random.Random(6)
    langs = {"en": Q.COMMON_WORDS[:31], "fr": Q.COMMON_WORDS[55:75], None: ["ok"]}
    rows = []
    for i in range(200):
        lang = r.choice(list(langs))
        share = r.choice([0.5, 0.4, 0.45, 0.0])
        w = [r.choice(langs[lang]) if r.random() < share else "".join(r.choice("abcdefghijé") for _ in range(r.randrange(2, 9)))
             for _ in range(r.choice([10, 25, 60, 150, 3000]))]
        if i % 11 == 0:
            w = [r.choice(["%%%", "#1", "ABC", "9" * 8]) for _ in w]
        rows.append((i, r.choice([" ", "\n", "  "]).join(w) + ".", lang, "s", 1))
    return rows


def test_verdict_equals_brute_force(spark):
    rows = texts() + [(1000 + i, *x[1:]) for i, x in enumerate(edge_rows())]
    got = {x["doc_id"]: x for x in Q.judge(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    verdicts = Counter()
    for doc, dc, dw, far, margin in brute(rows):
        x = got[doc]
        assert abs(x["class_distance"] - dc) < 1e-4 and abs(x["word_distance"] - dw) < 1e-4
        if margin > 1e-4:
            assert x["kept"] == (not x["base_failed"] and not far), doc
            verdicts[x["base_failed"], far] += 1
    assert verdicts[False, True] > 10 and verdicts[False, False] > 50


def test_many_languages_are_joined_by_shuffle(spark, monkeypatch):
    df = spark.createDataFrame(texts(), SCHEMA).repartition(4)
    want = sorted(map(str, Q.judge(df).collect()))
    monkeypatch.setattr(Q, "BROADCAST_LANGUAGES", 1)
    assert sorted(map(str, Q.judge(df).collect())) == want
