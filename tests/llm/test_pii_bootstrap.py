"""The bootstrap against a plain version over tuples of words, and planted identifiers."""
import math
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from shelfwise.llm import pii
from llm.conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")


def contexts(w, k):
    one, two, right = w[k - 1] if k else "^", w[k - 2] if k > 1 else "^", w[k + 1] if k + 1 < len(w) else "$"
    every = [("1", one), ("2", two, one), ("r", right), ("b", one, right)]
    return [c for c in every if not set(c[1:]) <= {"^", "$"}]


def brute(texts):
    """Added spans per text, for texts whose identifiers are single words and whose only base kind is email."""
    items, total = [], Counter()
    for t, text in enumerate(texts):
        spots = [(m.start(), m.end()) for m in WORD.finditer(text)]
        w = [text[a:b].lower() for a, b in spots]
        for k, (a, b) in enumerate(spots):
            total.update(contexts(w, k))
            token = text[a:b]
            base = EMAIL.search(token)
            if base:
                items.append((t, a + base.start(), a + base.end(), base[0].lower(), 0, contexts(w, k)))
            elif re.search("[0-9@]", token):
                inner = token.strip(pii._TRIM)
                a += len(token) - len(token.lstrip(pii._TRIM))
                mixed = (re.fullmatch("[A-Za-z0-9]{16,}", inner) and sum(c.isdigit() for c in inner) >= 3 and sum(c.isalpha() for c in inner) >= 3)
                items.append((t, a, a + len(inner), inner.lower(), 4 if mixed else -1, contexts(w, k)))
    edges = Counter((c, v, kind) for _, _, _, v, kind, cs in items for c in cs)
    held, values = Counter(), defaultdict(set)
    for (c, v, _), n in edges.items():
        held[c] += n
        values[c].add(v)
    down = lambda x: math.floor(x * 10 ** 6) / 10 ** 6
    known = {}                                    # (value, kind) -> confidence
    while True:
        weight, who = Counter(), defaultdict(set)
        for (c, v, kind), n in edges.items():
            if len(values[c]) < 2:
                continue
            if kind >= 0:
                weight[c, kind] += n
                who[c, kind].add(v)
            else:
                for k in range(5):
                    if (v, k) in known and len(v) >= pii.FIRM:
                        weight[c, k] += n * known[v, k]
                        who[c, k].add(v)
        accepted = {}
        for (c, k), x in weight.items():
            conf = down(x / max(total[c], held[c]) + 1e-9)
            if any(conf >= least and len(who[c, k]) >= need for least, need in pii.SUPPORT):
                accepted[c, k] = conf
        new = {}
        for (c, v, kind), _ in edges.items():
            if kind in (-1, 4):
                for k in range(5):
                    if (c, k) in accepted:
                        new[v, k] = max(new.get((v, k), 0), accepted[c, k])
        if new == known:
            break
        known = new
    best = {}
    for (v, k), conf in known.items():
        best[v] = max(best.get(v, (0, -9)), (conf, -k))
    out = defaultdict(list)
    for t, a, b, v, kind, cs in items:
        if kind in (-1, 4):
            found = [(accepted[c, k], -k) for c in cs for k in range(5) if (c, k) in accepted]
            found += [best[v]] if v in best and len(v) >= pii.FIRM else []
            if found:
                out[t].append((-max(found)[1], a, b))
    return out, accepted


def corpus(seed, n):
    r = random.Random(seed)
    hexes = lambda k: "".join(r.choice("0123456789abcdef") for _ in range(k - 6)) + "a1b2c3"
    out = []
    for i in range(n):
        w = prose(seed * 1000 + i, r.randrange(8, 40), 60).split()
        w = [re.sub("[0-9]", lambda m: "abcdefghij"[int(m[0])], x) for x in w]
        for _ in range(r.randrange(3)):
            at = r.randrange(len(w) + 1)
            w[at:at] = r.choice([["mail", "to:", f"u{r.randrange(40)}@mail.example.com"], ["contact:", f"handle{r.randrange(30)}x"],
                                 ["mail", "to:", f"handle{r.randrange(30)}x"], ["key", "=", f'"{hexes(20)}"'], ["key", "=", f"k{r.randrange(9)}"],
                                 [f"room{r.randrange(20)}"], ["seen", f"({hexes(24)})"], [f"p{r.randrange(9)}", "sent", "mail"], ["é", f"7{hexes(300)}"]])
        out.append(" ".join(w))
    return out


def added(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    return {r["doc_id"]: sorted((s["kind"], s["start"], s["end"]) for s in r["added"]) for r in pii.find(df).collect()}


def test_bootstrap_equals_brute_force(spark):
    texts = corpus(3, 400)
    # numbers that stand together would be runs, which the plain version does not know
    texts = [t for t in texts if not re.search(r"(?:^|\s)[0-9]\S*\s+[(\[]*[0-9]", t)]
    want, accepted = brute(texts)
    got = added(spark, texts)
    assert {k: v for k, v in got.items() if v} == {t: sorted(v) for t, v in want.items()}
    assert len(accepted) > 5 and sum(map(len, want.values())) > 50


def test_planted_identifiers_recall_and_precision(spark):
    """Unseen identifiers behind phrases that seeds teach are found; numbers elsewhere are not."""
    r = random.Random(11)
    phrases = {0: ["write to", "his address is", "e-mail:"], 3: ["call me on", "tel.", "mobile:"]}
    texts, planted = [], {}
    for i in range(600):
        w = prose(50_000 + i, 30).split()
        at = r.randrange(5, 25)
        kind = r.choice([0, 3])
        seed = r.random() < 0.9
        value = {0: f"n{i}.x@mail{i % 7}.example.com" if seed else f"n{i}.x(at)mail{i % 7}",
                 3: f"+49 30 {1000000 + i}" if seed else f"030/{1000000 + i}"}[kind]
        phrase = r.choice(phrases[kind])
        text = " ".join(w[:at] + [phrase, value] + w[at:])
        if not seed:
            start = len(" ".join(w[:at] + [phrase])) + 1
            planted[i] = (kind, start, start + len(value))
        texts.append(text)
    got = added(spark, texts)
    found = {(i, s) for i, spans in got.items() for s in spans}
    right = {(i, s) for i, s in planted.items()}
    recall, precision = len(found & right) / len(right), len(found & right) / max(1, len(found))
    assert recall >= 0.9 and precision >= 0.9, (recall, precision)


def test_short_and_long_values(spark):
    texts = [f"row {prose(i, 5)} code: a{i}@mail.example.com" for i in range(30)]
    texts += ["so code: 5 it is", "there are 5 of 5", "a code: " + "9x" * 500_000 + " ends", "again " + "9x" * 500_000, "code: 12345678"]
    got = added(spark, texts)
    at = texts[30].index("5")
    assert got[30] == [(0, at, at + 1)] and got[31] == []
    assert got[32] == [(0, 8, 8 + 1_000_000)] and got[33] == [(0, 6, 6 + 1_000_000)]
    assert got[34] == [(0, 6, 14)]


def test_supplied_documents_get_spans(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = pii.find(docs.select("doc_id", "text"))
    keyed = docs.where(F.col("text").rlike('(?i)token = "[0-9a-f]{40}"')).select("doc_id")
    caught = out.where(F.size("added") > 0).join(keyed, "doc_id", "left_semi").count()
    assert caught >= 0.9 * keyed.count() > 0
