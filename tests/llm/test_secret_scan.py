"""Secret scan: spans against a plain reading of the rules, and the ledger's increments."""
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import secret_scan as S
from shelfwise.llm.queries import QUERIES
from llm.conftest import SCHEMA, edge_rows

HEX = "0123456789abcdef"


def brute_base(text):
    """Base spans: every leftmost match of the stated patterns, then the length test."""
    key = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
                   for w in ("password", "passwd", "secret", "token", "api_?key"))
    out = [(m.start(), 0, m.end()) for m in re.finditer(f"({key})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text)
           if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def base_of(found):
    return sorted((r["start"], r["place"], r["end"]) for r in found if r["place"] < 3)


def pieces(seed, n):
    r = random.Random(seed)
    parts = ["token", "TOKEN", "pass", "word", "passwd", "Secret", "api_key", "apikey", "=", ":", " ", "  ", "'", '"', "é", "\n", "ſecret",
             "toKen", "AKIA", "ABCDEFGH1234567", "deadbeef", "0123456789abcdef", "abcdefghijkl", ".", "x", "==", "AKIAAKIA", "f" * 15]
    return "".join(r.choice(parts) for _ in range(n))


def rows():
    out = [(i, pieces(i, 30)) for i in range(300)]
    out += [(1000, "token=secret = abcdefghijklmn"), (1001, "token = secret=abcdefghijkl"), (1002, "AKIA" + "A" * 13), (1003, "AKIA" + "A" * 14),
            (1004, None), (1005, ""), (None, "password: 'hunter2hunter2'"), (1006, "f" * 70000), (1007, "token" + " " * 50000),
            (1008, "token=" + "a" * 100000), (1009, "x" * 50000 + "://"), (1010, "eyJ" * 20000), (1011, "-----BEGIN " * 3000)]
    return out + [(2000 + i, "the same secret = abcdefABCDEF123 here") for i in range(250)]


def scanned(spark, data, ledger, rules=S.RULES):
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    return S.scan(df, str(ledger), rules)


def test_spans_equal_brute_force(spark, tmp_path):
    data = rows()
    out = scanned(spark, data, tmp_path / "l").collect()
    texts = {d: t or "" for d, t in data}
    assert len(out) == len(data)
    for r in out:
        text = texts[r["doc_id"]]
        assert base_of(r["spans"]) == brute_base(text), text[:100]
        assert bytes(r["blob"]) == hashlib.sha256(text.encode()).digest()


@pytest.mark.parametrize("text,kind,secret", [
    ("é a -----BEGIN RSA PRIVATE KEY----- x", "pem", "-----BEGIN RSA PRIVATE KEY-----"),
    ("use ghp_" + "a1B2" * 9 + " now", "github", "ghp_" + "a1B2" * 9),
    ("xoxb-123456789012-abc", "slack", "xoxb-123456789012-abc"),
    ("id eyJhbGciOiJI.eyJzdWIiOiIx.c2lnbmF0dXJl!", "jwt", "eyJhbGciOiJI.eyJzdWIiOiIx.c2lnbmF0dXJl"),
    ("Authorization: Bearer abcdefghijklmnopqrst", "bearer", "Bearer abcdefghijklmnopqrst"),
    ("git clone https://me:pa55word@host/x", "url", "://me:pa55word@"),
])
def test_issued_forms(spark, tmp_path, text, kind, secret):
    found = scanned(spark, [(1, text)], tmp_path / "l").first()["spans"]
    assert [text[r["start"]:r["end"]] for r in found if r["kind"] == kind] == [secret]


def test_prose_is_left_alone(spark, tmp_path):
    data = [(1, "The token is lost: ask the secretary. A password; passwords: yes. https://host/a@b eyJ AKIA deadbeef.")]
    assert scanned(spark, data, tmp_path / "l").first()["spans"] == []


def facts(spark, ledger):
    return S.read_ledger(spark, str(ledger)).collect()


def test_only_unseen_blobs_and_rules_are_scanned(spark, tmp_path):
    ledger = tmp_path / "ledger"
    first = [(i, f"token = {HEX[i]}aaaaaaaaaaaaa") for i in range(6)] + [(9, "token = 0aaaaaaaaaaaaa")]
    scanned(spark, first, ledger, S.BASE).count()
    seen = facts(spark, ledger)
    assert len(seen) == 6 and all(r["rules"] == [x.key for x in S.BASE] for r in seen)        # the copy is scanned once
    # the same again: nothing is written
    scanned(spark, first, ledger, S.BASE).count()
    assert len(facts(spark, ledger)) == 6
    # one new blob: one new fact
    again = scanned(spark, [*first, (10, "secret = bbbbbbbbbbbbbb")], ledger, S.BASE).collect()
    assert len(facts(spark, ledger)) == 7 and sum(len(r["spans"]) for r in again) == 8
    # a new version of one rule: that rule alone runs over all blobs
    stricter = S.Rule("assign", 2, S.BASE[0].pattern, least=99, group=2, hints=S.BASE[0].hints)
    now = scanned(spark, first, ledger, (stricter, *S.BASE[1:])).collect()
    new = [r for r in facts(spark, ledger) if r["rules"] == ["assign@2"]]
    assert len(new) == 6 and all(not r["spans"] for r in now)
    # facts of the old version still answer
    assert sum(len(r["spans"]) for r in scanned(spark, first, ledger, S.BASE).collect()) == 7
    assert len(facts(spark, ledger)) == 13


def test_facts_written_twice_are_read_as_one(spark, tmp_path):
    data, ledger = rows()[:80], str(tmp_path / "ledger")
    want = sorted(map(str, scanned(spark, data, ledger).collect()))
    S.read_ledger(spark, ledger).write.parquet(str(tmp_path / "copy"))
    spark.read.parquet(str(tmp_path / "copy")).write.mode("append").parquet(ledger)
    assert sorted(map(str, scanned(spark, data, ledger).collect())) == want


def test_edge_rows_clashing_and_empty(spark, edge, none, clashing, tmp_path):
    assert S.scan(edge, str(tmp_path / "a")).count() == len(edge_rows())
    assert S.scan(none, str(tmp_path / "b")).count() == 0 and facts(spark, tmp_path / "b") == []
    more = clashing.withColumns({c: F.lit(5) for c in ("blob", "spans", "todo", "salt", "findings", "rules")})
    out = S.scan(more, str(tmp_path / "c"))
    assert set(out.columns) == set(more.columns) - {"text"} and out.count() == len(edge_rows())


def test_all_texts_are_reduced_when_too_many_are_unseen(spark, tmp_path, monkeypatch):
    data = rows()[:100]
    want = sorted(map(str, scanned(spark, data, tmp_path / "a").collect()))
    monkeypatch.setattr(S, "BROADCAST_BLOBS", 3)
    assert sorted(map(str, scanned(spark, data, tmp_path / "b").collect())) == want


def test_the_query_digests_its_spans(spark, tmp_path):
    spark.createDataFrame([(1, "a token = 'abcdefabcdefabcdef'", "en", "s", 1), (2, None, "en", "s", 0)], SCHEMA).write.parquet(
        str(tmp_path / "documents.parquet"))
    one, two = sorted(QUERIES["op13_secrets"](spark, str(tmp_path)).collect(), key=lambda r: r["doc_id"])
    assert (one["n_assign"], one["n_access"], one["n_hex"]) == (1, 0, 1) and one["spans"] == "assign:2:29,hex:11:29"
    assert one["base_sha256"] == hashlib.sha256(b"assign:2:29,hex:11:29").hexdigest()
    assert two["spans"] == "" and two["base_sha256"] == hashlib.sha256(b"").hexdigest()
