"""Exact de-duplication with owners kept in Patricia tries.

Texts are equal when identical after deleting ASCII white space. Partitions
are made by length and content hash; inside a partition the full byte strings
are inserted into a compressed radix trie whose terminal nodes keep the best
owner (most code points in the original text, then smallest doc_id) and the
number of rows seen.

* Pre-aggregation: every input task inserts its own rows into a trie first and
  sends one row per distinct text, so a text that a third of all rows share
  reaches the shuffle once per trie of a task, not once per row.
* Spill by subtree: the shuffled rows arrive sorted by the trie's path (length,
  hash); when the trie outgrows its budget, all subtrees before the current
  path are complete and are sent on as rows. Spark's sort does the disk work,
  so no task writes files of its own.
* Every row then finds its owner through (length, SHA-256); the row side may
  be skewed and is split by AQE, the owner side has one row per text.

Defined results: null text counts as empty; rows that tie in text, code points
and doc_id (repeated rows) all name the same owner and are all ``kept`` as rows
of :func:`owners`, while :func:`deduplicate` keeps one row per text; null
doc_ids lose every tie; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import WS_BYTES, bounded_batches, hashable, quoted

#: Bytes of text a task's trie holds before its finished subtrees are sent on.
TRIE_BYTES = 8 << 20
_NONE = 1 << 63   # sorts after every doc_id


class Trie:
    """Compressed radix trie over byte strings; a terminal holds [points, doc_id, rows]."""

    __slots__ = ("root", "held")

    def __init__(self):
        self.root: dict = {}    # first byte -> [edge bytes, terminal or None, children]
        self.held = 0

    def add(self, key: bytes, points: int, doc: int, rows: int) -> None:
        level, at = self.root, 0
        while True:
            node = level.get(key[at]) if at < len(key) else level.get(-1)
            if node is None:
                rest = key[at:]
                level[rest[0] if rest else -1] = [rest, [points, doc, rows], {}]
                self.held += len(rest) + 200
                return
            edge = node[0]
            if key.startswith(edge, at):
                at += len(edge)
                if at == len(key):
                    owner = node[1]
                    if owner is None:
                        node[1] = [points, doc, rows]
                    else:
                        if (points, -doc) > (owner[0], -owner[1]):
                            owner[0], owner[1] = points, doc
                        owner[2] += rows
                    return
                level = node[2]
                continue
            same = _common(edge, key, at)
            below = [edge[same:], node[1], node[2]]
            node[0], node[1], node[2] = edge[:same], None, {edge[same]: below}
            self.held += 200
            # the loop goes on: the shortened edge now matches

    def items(self) -> Iterator[tuple[bytes, list]]:
        stack = [(b"", n) for n in self.root.values()]
        while stack:
            path, (edge, owner, level) = stack.pop()
            path = path + edge
            if owner is not None:
                yield path, owner
            stack.extend((path, n) for n in level.values())


def _common(edge: bytes, key: bytes, at: int) -> int:
    """Length of the common prefix of edge and key[at:], by halving."""
    low, high = 1, min(len(edge), len(key) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if edge[:mid] == key[at:at + mid]:
            low = mid
        else:
            high = mid - 1
    return low


_PARTS = pa.schema([("len", pa.int64()), ("h", pa.int64()), ("norm", pa.binary()), ("points", pa.int64()),
                    ("doc_id", pa.int64()), ("rows", pa.int64())])
_OWNERS = pa.schema([("len", pa.int64()), ("sha", pa.string()), ("keep_id", pa.int64()), ("group_size", pa.int64())])


def _batches(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(rows), 1024):
        cols = list(zip(*rows[i:i + 1024]))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)


def _hash(norm: bytes, bits: int) -> int:
    return int.from_bytes(hashlib.blake2b(norm, digest_size=8).digest(), "big") >> (64 - bits)


def _local(budget: int, bits: int):
    """Task-local tries over (doc_id, text): one row per distinct text of a trie."""
    def run(batches):
        trie = Trie()

        def out():
            return [(len(p), _hash(p, bits), p, o[0], None if o[1] == _NONE else o[1], o[2]) for p, o in trie.items()]
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = text or ""
                trie.add(text.encode().translate(None, WS_BYTES), len(text), _NONE if doc is None else doc, 1)
            if trie.held > budget:
                yield from _batches(out(), _PARTS)
                trie = Trie()
        yield from _batches(out(), _PARTS)
    return run


def _merge(budget: int):
    """Tries over rows sorted by path (len, h); finished subtrees leave when over budget."""
    def run(batches):
        done: list[tuple] = []
        trie, path = Trie(), None

        def out():
            return [(len(p), hashlib.sha256(p).hexdigest(), None if o[1] == _NONE else o[1], o[2]) for p, o in trie.items()]
        for batch in batches:
            for n, h, norm, points, doc, rows in zip(*[c.to_pylist() for c in batch.columns]):
                if (n, h) != path:
                    if trie.held > budget:
                        yield from _batches(out(), _OWNERS)
                        trie = Trie()
                    path = (n, h)
                trie.add(norm, points, _NONE if doc is None else doc, rows)
        done = out()
        yield from _batches(done, _OWNERS)
    return run


def text_owners(docs: DataFrame, budget: int = TRIE_BYTES, hash_bits: int = 63) -> DataFrame:
    """One row per distinct normalised text: (len, sha, keep_id, group_size)."""
    bounded_batches(docs.sparkSession)
    parts = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _local(budget, hash_bits), "len long, h long, norm binary, points long, doc_id long, rows long")
    dealt = parts.repartition("len", "h").sortWithinPartitions("len", "h")
    return dealt.mapInArrow(_merge(budget), "len long, sha string, keep_id long, group_size long")


def _digests(docs: DataFrame):
    """The input row with the length and digest of its normalised text."""
    norm = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), r"[\x20\x09-\x0D]+", "")
    return (docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("rec"), norm.alias("norm"))
            .select("rec", F.octet_length("norm").cast("long").alias("len"), F.sha2("norm", 256).alias("sha")))


def owners(docs: DataFrame, budget: int = TRIE_BYTES, hash_bits: int = 63) -> DataFrame:
    """Per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    slim = docs.select(F.col("doc_id").cast("long"), "text")
    rows = _digests(slim).select(F.col("rec.doc_id").alias("doc_id"), "len", "sha")
    return (rows.join(text_owners(docs, budget, hash_bits), ["len", "sha"])
            .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.col("sha").alias("text_sha256")))


def deduplicate(docs: DataFrame, budget: int = TRIE_BYTES) -> DataFrame:
    """The input's columns, one row per distinct text: the owner's row."""
    tie = F.xxhash64(*[quoted(c) for c in hashable(docs)])
    rows = _digests(docs.withColumn("_tie", tie)).withColumn("tie", F.col("rec._tie")).withColumn(
        "rec", F.col("rec").dropFields("_tie"))
    owned = text_owners(docs, budget).withColumnsRenamed({"len": "olen", "sha": "osha"})
    return (rows.join(owned, (F.col("len") == F.col("olen")) & (F.col("sha") == F.col("osha"))
                      & F.col("rec.doc_id").cast("long").eqNullSafe(F.col("keep_id")))
            # several rows with the owner's id and text: the one with most code points, then by a hash of all columns
            .groupBy("len", "sha")
            .agg(F.max_by("rec", F.struct(F.char_length(F.coalesce(F.col("rec.text"), F.lit(""))), F.col("tie"))).alias("rec"))
            .select("rec.*"))
