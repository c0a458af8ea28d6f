"""Importance resampling: hashing, scores and draws against brute force, edge rows."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import resampling as R
from llm.conftest import SCHEMA, edge_rows, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def runs(text, longest):
    w = words(text)
    return [" ".join(w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]


def brute(docs, target, longest, buckets, percent, least, seed):
    """(doc_id, n_features, weight, score, rank) of all rows."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, x in docs for f in runs(x, longest))
    t = Counter(bucket(f) for x in target for f in runs(x, longest))
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
    out = []
    for i, (doc, text) in enumerate(docs):
        fs = runs(text, longest)
        weight = sum(gain(bucket(f)) for f in fs)
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc, len(words(text)), len(fs), weight, score, None, i])
    fit = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    for k, r in enumerate(fit[:percent * len(fit) // 100]):
        r[5] = k + 1
    return sorted((tuple(r[:6]) for r in out), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=str)


TARGET = [prose(501, 80), "Größe w1 w2 w3", None, "", prose(502, 40)]


def target_of(spark):
    return spark.createDataFrame([(t,) for t in TARGET], "text string")


def test_checksums_equal_the_library():
    r = random.Random(3)
    raw = np.frombuffer(r.randbytes(5000), np.uint8)
    starts = np.sort(np.array([r.randrange(4000) for _ in range(600)]))
    ends = starts + np.array([r.choice([0, 1, 2, 7, 31, 32, 33, 64, 900]) for _ in range(600)])
    assert R.crc32s(raw, starts, ends).tolist() == [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(starts, ends)]
    assert len(R.crc32s(raw, starts[:0], ends[:0])) == 0


@pytest.mark.parametrize("longest", [1, 3])
def test_features_equal_brute_force(longest):
    texts = ["", None, "A b", "é-Ü x", "x" * 100 + " y", "a", " . ", "ab cd ef gh", "漢字 kana 123 4"]
    found, owner, n = R.features(pa.array(texts), longest, 997)
    assert n.tolist() == [len(words(t)) for t in texts]
    for i, t in enumerate(texts):
        assert sorted(found[owner == i].tolist()) == sorted(zlib.crc32(f.encode()) % 997 for f in runs(t, longest)), t


@pytest.mark.parametrize("longest,percent", [(1, 10), (2, 37), (1, 100)])
def test_draw_equals_brute_force(spark, edge, longest, percent):
    rows = [(r[0], r[1]) for r in edge_rows()]
    out = R.resample(edge, target_of(spark), percent=percent, longest=longest, buckets=500)
    assert got(out) == brute(rows, TARGET, longest, 500, percent, 20, 2024)


def test_ties_and_repeated_rows(spark):
    """A third of the rows are the same row; equal texts under other ids have other noise."""
    r = random.Random(8)
    base = prose(9, 40)
    rows = [(7, base)] * 200 + [(i, base) for i in range(100, 300)] + [(None, prose(i, 30)) for i in range(50)]
    rows += [(i, prose(i, r.randrange(5, 60))) for i in range(400, 550)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    a = got(R.resample(df, target_of(spark), percent=45))
    assert a == brute(rows, TARGET, 1, 10_000, 45, 20, 2024)
    assert a == got(R.resample(df.repartition(3), target_of(spark), percent=45))
    ranks = sorted(x[5] for x in a if x[5])
    assert ranks == list(range(1, len(ranks) + 1))


def test_quickselect_finds_every_place(spark):
    r = random.Random(1)
    rows = [(r.randrange(50), False, r.randrange(5), 0, i) for i in range(400)]
    df = spark.createDataFrame(rows, "falling long, no_id boolean, id long, n_features long, uid long").repartition(5).cache()
    order = sorted(rows)
    for k in (1, 2, 77, 200, 399, 400):
        assert R.kth_key(df, k, pivots=3) == order[k - 1]


def test_empty_tables_and_clashing_names(spark, none, clashing):
    assert R.resample(none, target_of(spark)).count() == 0
    few = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert got(R.resample(few, target_of(spark)))[0][5] is None
    out = R.resample(clashing, none)
    assert out.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert got(out) == brute([(r[0], r[1]) for r in edge_rows()], [], 1, 10_000, 10, 20, 2024)


def test_draw_prefers_texts_like_the_target(spark):
    rows = [(i, " ".join(f"{'t' if i % 4 == 0 else 'o'}{random.Random(i * 99 + j).randrange(60)}" for j in range(50))) for i in range(400)]
    target = spark.createDataFrame([(" ".join(f"t{k}" for k in range(60)),)] * 5, "text string")
    out = R.resample(spark.createDataFrame(rows, "doc_id long, text string"), target, percent=20).where("rank is not null")
    assert out.where(F.col("doc_id") % 4 == 0).count() == out.count() == 80
