"""Byte-level BPE encoding and decoding with a public vocabulary.

The text is split by the tokenizer's pattern; every piece is looked up in a
bounded per-task cache and otherwise merged:

* Short pieces keep a contiguous array of part boundaries and one of the
  adjacent pairs' ranks, scan it for the smallest rank, delete that boundary
  and refresh the two neighbouring ranks.
* Pieces longer than SHORT bytes do the same merges from a heap over a linked
  list, because repeated scans cost the square of the length. The result is
  equal (smallest rank first, leftmost on ties).

Special tokens of the vocabulary are matched in the text first, as the
tokenizers library does by default. The vocabulary file's path is a parameter.

Defined results: null is the empty text, which has no tokens; ids outside the
vocabulary raise; bytes that are not UTF-8 after decoding become U+FFFD;
input columns named like the outputs are replaced; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import json
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import append_columns, quoted

#: Fixed value: how byte-level vocabularies of this family split text.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
SHORT = 64
#: Pieces a task remembers before it starts its cache anew.
CACHE = 150_000
NO_RANK = 1 << 60


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in such vocabulary files."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Codec:
    """Merges, token bytes and specials of one vocabulary file."""

    def __init__(self, path: str):
        import regex
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        vocab = spec["model"]["vocab"]
        special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.tokens: list[bytes | None] = [None] * (max([*vocab.values(), *special.values()]) + 1)
        for token, i in vocab.items():
            self.tokens[i] = bytes(letters[c] for c in token) if token not in special else token.encode()
        for token, i in special.items():
            self.tokens[i] = token.encode()
        self.byte_id = [vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        self.merge: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merge[vocab[a] << 32 | vocab[b]] = (rank, vocab[a + b])
        self.special = special
        self.pattern = regex.compile(PATTERN)
        self.special_pattern = regex.compile(
            "(" + "|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True)) + ")") if special else None
        self.cache: dict[str, bytes] = {}

    def merge_piece(self, piece: bytes) -> list[int]:
        ids = [self.byte_id[b] for b in piece]
        return self._scan(ids) if len(ids) <= SHORT else self._heap(ids)

    def _scan(self, ids: list[int]) -> list[int]:
        """Rank array: ranks[i] is the rank of the pair (ids[i], ids[i+1])."""
        merge, none = self.merge, (NO_RANK, -1)
        found = [merge.get(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
        ranks = [f[0] for f in found]
        while ranks:
            low = min(ranks)
            if low == NO_RANK:
                break
            i = ranks.index(low)
            ids[i] = found[i][1]
            del ids[i + 1], ranks[i], found[i]
            if i < len(ranks):
                found[i] = merge.get(ids[i] << 32 | ids[i + 1], none)
                ranks[i] = found[i][0]
            if i:
                found[i - 1] = merge.get(ids[i - 1] << 32 | ids[i], none)
                ranks[i - 1] = found[i - 1][0]
        return ids

    def _heap(self, ids: list[int]) -> list[int]:
        n, merge = len(ids), self.merge
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(n - 1) if (m := merge.get(ids[i] << 32 | ids[i + 1]))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue    # one of its parts was merged meanwhile
            ids[i], ids[j] = new, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (m := merge.get(ids[left] << 32 | ids[right])):
                    heapq.heappush(heap, (m[0], left, ids[left], ids[right], m[1]))
        return [x for x in ids if x >= 0]

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        cache, out = self.cache, []
        parts = self.special_pattern.split(text) if self.special_pattern and any(s in text for s in self.special) else [text]
        for part in parts:
            if part in self.special:
                out.append(self.special[part].to_bytes(4, "little"))
                continue
            for piece in self.pattern.findall(part):
                ids = cache.get(piece)
                if ids is None:
                    ids = np.array(self.merge_piece(piece.encode()), "<u4").tobytes()
                    if len(piece) <= SHORT:
                        if len(cache) >= CACHE:
                            cache.clear()
                        cache[piece] = ids
                out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        tokens = self.tokens
        return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def _encode(batches, text: str, path: str, decode: bool):
    codec = Codec(path)
    for batch in batches:
        for i in range(0, max(1, batch.num_rows), 64):    # outputs of few rows at a time stay small
            part = batch.slice(i, 64)
            ids = [codec.encode(t or "") for t in part.column(text).to_pylist()]
            more = [pa.array(ids, pa.binary()), pa.array([len(b) // 4 for b in ids], pa.int64())]
            if decode:
                more.append(pa.array([codec.decode(b) for b in ids], pa.string()))
            yield pa.RecordBatch.from_arrays([*part.columns, *more], names=[
                *part.schema.names, "token_ids", "n_tokens", *["decoded"] * decode])


def encode(docs: DataFrame, path: str, text: str = "text", decode: bool = False) -> DataFrame:
    """The input's columns plus token_ids (little-endian unsigned 32-bit
    integers as binary) and n_tokens; with ``decode`` also the decoded text."""
    more = [T.StructField("token_ids", T.BinaryType()), T.StructField("n_tokens", T.LongType()),
            *[T.StructField("decoded", T.StringType())] * decode]
    return append_columns(docs, text, partial(_encode, path=path, decode=decode), more)


def _decode(batches, ids: str, path: str):
    codec = Codec(path)
    for batch in batches:
        texts = [None if b is None else codec.decode(b) for b in batch.column(ids).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])


def decode(encoded: DataFrame, path: str, ids: str = "token_ids") -> DataFrame:
    """The input's columns plus the decoded text; null ids decode to null."""
    return append_columns(encoded, ids, partial(_decode, path=path), [T.StructField("decoded", T.StringType())])


def id_array(ids: str = "token_ids") -> Column:
    """token_ids as array<bigint>, with SQL functions."""
    n = (F.octet_length(quoted(ids)) / 4).cast("int")

    def one(i):
        h = F.hex(F.substring(quoted(ids), i * 4 + 1, F.lit(4)))
        return F.conv(F.concat(*[F.substring(h, at, 2) for at in (7, 5, 3, 1)]), 16, 10).cast("long")
    return F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), one)
