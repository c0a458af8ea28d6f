"""Sharding, mixing, exact de-duplication, encoding: brute force and edge rows."""
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import bpe, exact_dedup, mixing, sharding
from shelfwise.llm.queries import vocabulary_path
from llm.conftest import edge_rows

WS = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def place_ok(rows, shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    counts = [len(slots.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1


def test_shards_are_even_gapless_and_repeatable(spark, edge):
    a = sharding.shuffle_into_shards(edge, 4, bucket_bytes=20_000).collect()
    b = sharding.shuffle_into_shards(edge.repartition(5), 4, bucket_bytes=20_000).collect()
    place_ok(a, 4)
    assert Counter((r["doc_id"], r["text"]) for r in a) == Counter((r[0], r[1]) for r in edge_rows())
    # a text's place does not depend on the layout of the input
    assert sorted((str(r["doc_id"]), str(r["text"]), r["shard"], r["slot"]) for r in a) == sorted(
        (str(r["doc_id"]), str(r["text"]), r["shard"], r["slot"]) for r in b)
    ids = [r["doc_id"] for r in sorted(a, key=lambda r: (r["shard"], r["slot"])) if r["doc_id"] is not None]
    assert ids != sorted(ids)


def test_shards_split_a_bucket_of_repeated_rows(spark):
    rows = [(1, "same")] * 4000 + [(i, f"t{i}") for i in range(2, 2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = sharding.shuffle_into_shards(df, 8, bucket_bytes=2000).collect()
    place_ok(out, 8)
    assert Counter(r["doc_id"] for r in out)[1] == 4000


def test_shards_of_empty_and_clashing(spark, none, clashing):
    assert sharding.shuffle_into_shards(none).count() == 0
    out = sharding.shuffle_into_shards(clashing, 3)
    assert set(out.columns) == set(clashing.columns)
    place_ok(out.select("shard", "slot").collect(), 3)


def test_written_shards_keep_slot_order(spark, edge, tmp_path):
    sharding.write_shards(sharding.shuffle_into_shards(edge, 2), str(tmp_path / "s"), tasks_per_shard=1)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == len(edge_rows()) and back.select("shard").distinct().count() == 2


def expected_targets(sizes):
    names = sorted((n for n in sizes if n is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    w = {n: (3, 1, 2)[i % 3] for i, n in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(w[n] for n in open_)
        full = {n for n in open_ if level * w[n] >= 2 * sizes[n]}
        if not full:
            out |= {n: level * w[n] for n in open_}
            break
        for n in full:
            out[n] = 2.0 * sizes[n]
            left -= out[n]
        open_ -= full
    return out


def test_mix_targets_and_copies(spark, edge):
    rows = edge_rows()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    want = expected_targets(sizes)
    got = mixing.with_copies(edge).select("rec.*", "size", "source_size", "target", "copies").collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["size"] == len(WORD.findall(r["text"] or "")) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        rate = r["target"] / r["source_size"] if r["source_size"] else 0
        assert r["copies"] in (int(rate), int(rate) + 1) and r["copies"] <= 2
    mixed = mixing.mix(edge)
    assert mixed.columns == edge.columns and mixed.count() == sum(r["copies"] for r in got)


def test_mix_comes_near_its_targets(spark):
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.concat(F.lit("one two three "), F.col("id")).alias("text"),
                                  F.when(F.col("id") % 2 == 0, "big").otherwise(F.concat(F.lit("s"), F.col("id") % 6)).alias("source"))
    rows = mixing.with_copies(df).groupBy("rec.source").agg(F.sum(F.col("size") * F.col("copies")).alias("t"), F.first("target").alias("w")).collect()
    assert all(abs(r["t"] - r["w"]) < 0.06 * r["w"] for r in rows)
    assert mixing.mix(df).count() == mixing.mix(df.repartition(7)).count()


def test_mix_of_empty_and_clashing(none, clashing):
    assert mixing.mix(none).count() == 0
    assert mixing.mix(clashing).columns == clashing.columns


def expected_owners(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[WS.sub("", r[1] or "")].append(r)
    out = []
    for norm, g in groups.items():
        keep = min(g, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))[0]
        out += [(r[0], keep, len(g), r[0] == keep, hashlib.sha256(norm.encode()).hexdigest()) for r in g]
    return Counter(out)


@pytest.mark.parametrize("budget,bits", [(32 << 20, 63), (500, 63), (500, 2)])
def test_exact_owners(edge, budget, bits):
    got = exact_dedup.owners(edge, budget, bits).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert Counter(tuple(r) for r in got.collect()) == expected_owners(edge_rows())


def test_exact_dedup_keeps_one_row_per_text(edge, none, clashing):
    kept = exact_dedup.deduplicate(edge).collect()
    want = {(k[1], k[4]) for k in expected_owners(edge_rows())}
    assert len(kept) == len(want) and Counter(r["doc_id"] for r in kept) == Counter(k[0] for k in want)
    assert exact_dedup.deduplicate(none).count() == 0 and exact_dedup.owners(none).count() == 0
    assert exact_dedup.deduplicate(clashing).columns == clashing.columns


def test_trie_splits_edges_and_ends_inside():
    t = exact_dedup.Trie()
    keys = [b"", b"a", b"abc", b"abd", b"ab", b"abcdef", b"b", b"abc"]
    for i, k in enumerate(keys):
        t.add(k, len(k), i, 1)
    assert {k: v for k, v in t.items()} == {k: [len(k), keys.index(k), keys.count(k)] for k in keys}


TEXTS = ["", "Hello world", "  lead", "tabs\t\tand\n\nlines \r\n x", "don't we'll I'M", "naïve café 漢字かな 🎉👩‍👩‍👧", "a" * 3000, "ab" * 500 + " " * 700,
         "x<|endoftext|>y<|endoftext|>", "\x00\x1c\x1d\x1e\x1f\x85\xa0 ​ end", "１２３ ½ ² x²", "é" * 130, " \n \n ", "#$%&*|<> !!! ...", "﻿́"]


def test_bpe_equals_the_tokenizers_library(spark):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary_path())
    df = spark.createDataFrame([(i, x) for i, x in enumerate([*TEXTS, None])], "doc_id long, text string").repartition(3)
    rows = {r["doc_id"]: r for r in bpe.encode(df, vocabulary_path(), decode=True).withColumn("ids", bpe.id_array()).collect()}
    for i, x in enumerate([*TEXTS, ""]):
        ids = t.encode(x, add_special_tokens=False).ids
        assert rows[i]["ids"] == ids and rows[i]["n_tokens"] == len(ids), repr(x[:30])
        assert rows[i]["decoded"] == t.decode(ids, skip_special_tokens=False) == x


def test_bpe_long_pieces_equal_short_method():
    c = bpe.Codec(vocabulary_path())
    for piece in ("thethetheand" * 9, "abcabcabd" * 12, "zzzzzzzzz" * 10, "0123456789" * 11):
        ids = [c.byte_id[b] for b in piece.encode()]
        assert c._scan(list(ids)) == c._heap(list(ids))


def test_bpe_edges(edge, none, clashing):
    assert bpe.encode(none, vocabulary_path()).count() == 0
    out = bpe.encode(clashing, vocabulary_path(), decode=True)
    assert set(out.columns) == set(clashing.columns)
    assert out.where(F.coalesce("text", F.lit("")) != F.col("decoded")).count() == 0
    back = bpe.decode(bpe.encode(edge, vocabulary_path()), vocabulary_path())
    assert back.where(F.coalesce("text", F.lit("")) != F.col("decoded")).count() == 0


def test_checksum_is_of_the_text_in_its_shard(spark, edge):
    out = sharding.shuffle_into_shards(edge, 8).select("text", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("c"))
    assert all(r["c"] == zlib.crc32((r["text"] or "").encode()) for r in out.collect())
