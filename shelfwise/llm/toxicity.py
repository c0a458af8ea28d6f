"""Toxicity scores by FTRL-proximal logistic regression over hashed n-grams.

Features of a text are the presence of its words, of pairs of neighbouring
words and of skip pairs (one word between), hashed into 2^BITS coordinates.
Longer words also count by their beginnings (4 to 7 bytes; once, twice, three
times in the text), so inflected or compounded forms of a word share weight.
Words are ASCII-lower-cased and ASCII punctuation is dropped, so marks around
or inside a word do not hide it. Training follows FTRL-proximal (McMahan et
al., 2013): per-coordinate rates alpha / (beta + sqrt(n)) and L1 sparsity, so
the fitted weights are a short list of (coordinate, weight), broadcast to the
scoring tasks with a bound of 2^BITS entries.

Training is distributed: labelled rows are dealt to up to SHARDS shards (of
LEAST_SHARD_ROWS rows or more) by a hash of doc_id; each round every shard runs one pass from the common state, and the
states are averaged over shards in fixed point, so reruns agree. A row's shard
and order depend on its content alone.

The fit may use a bounded sample: at most about MAX_TRAIN_ROWS labelled rows,
chosen by a hash of doc_id (documented bound; all rows when there are fewer).
Scoring covers every row and whole texts.

Defined results: null, empty and blank texts get the bias's score; labels
without a value, and rows without a doc_id, do not train; a document labelled
twice trains twice; repeated rows score alike; without usable labels every
score is just under 0.5; an empty table gives no rows.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import (IS_WS, LOWER, append_columns, bounded_batches, chain, keep_bytes, mix64, staged,
                                  text_bytes, word_hashes, word_spans)

BITS = 18
BIAS = 1 << BITS          # one more coordinate, without L1
KEY = BITS + 1            # bits of a coordinate in a feature key
BEGINNINGS, TIMES = (4, 5, 6, 7), 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 2.0, 1.0
SHARDS, ROUNDS, LEAST_SHARD_ROWS = 8, 4, 500
MAX_TRAIN_ROWS = 16_000
FIXED = float(1 << 24)    # states are averaged as integers of this step

_KEPT = np.ones(256, bool)
_KEPT[[b for b in range(33, 127) if not chr(b).isalnum()]] = False
_KEPT |= IS_WS


def features(column: pa.Array, used: np.ndarray | None = None) -> np.ndarray:
    """Sorted distinct keys row << KEY | coordinate of the texts' features; with
    ``used`` (a mask of coordinates) only those."""
    raw, offsets = text_bytes(column)
    raw, offsets = keep_bytes(raw, offsets, _KEPT[raw])
    raw = LOWER[raw]
    starts, ends, first = word_spans(raw, offsets)
    w = word_hashes(raw, starts, ends)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    found = [(row, chain(w))]
    for gap in (1, 2):
        if len(w) > gap:
            pair = chain(w[:-gap], w[gap:], np.full(len(w) - gap, gap, np.uint64))
            same = row[:-gap] == row[gap:]
            found.append((row[:-gap][same], pair[same]))
    keys = [_keys(r, h, used) for r, h in found]
    for length in BEGINNINGS:
        longer = np.flatnonzero(ends - starts > length)
        h = chain(word_hashes(raw, starts[longer], starts[longer] + length), np.full(len(longer), length, np.uint64))
        levels = [mix64(h + np.uint64(k)) for k in range(1, TIMES + 1)]
        if used is not None:
            hit = np.any([used[_coord(x)] for x in levels], axis=0)
            longer, levels = longer[hit], [x[hit] for x in levels]
        # the k-th time a beginning occurs in a text sets the k-th of its coordinates
        r = row[longer]
        order = np.lexsort((levels[0], r))
        new = np.ones(len(order), bool)
        new[1:] = (levels[0][order][1:] != levels[0][order][:-1]) | (r[order][1:] != r[order][:-1])
        heads = np.flatnonzero(new)
        times = np.diff(np.append(heads, len(order)))
        for k, x in enumerate(levels):
            some = order[heads[times > k]]
            keys.append(_keys(r[some], x[some], used))
    return np.unique(np.concatenate(keys))


def _coord(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def _keys(row: np.ndarray, h: np.ndarray, used: np.ndarray | None) -> np.ndarray:
    coord = _coord(h)
    if used is not None:
        hit = used[coord]
        row, coord = row[hit], coord[hit]
    return row << np.int64(KEY) | coord


def _weights(z: np.ndarray, n: np.ndarray, l1: np.ndarray | float) -> np.ndarray:
    w = -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
    return np.where(np.abs(z) <= l1, 0.0, w)


def _feature_rows(batches):
    for batch in batches:
        key = features(batch.column("text"))
        row, coord = key >> KEY, key & ((1 << KEY) - 1)
        at = np.searchsorted(row, np.arange(batch.num_rows + 1))
        packed = [pack(coord[a:b]) for a, b in zip(at[:-1], at[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("shard"), batch.column("place"), batch.column("y"), pa.array(packed, pa.binary())],
                                         names=["shard", "place", "y", "coords"])


def pack(coord: np.ndarray) -> bytes:
    """Sorted coordinates in two bytes each: how many share each upper part, then the lower parts."""
    high = np.bincount(coord >> 16, minlength=1 << (BITS - 16)).astype("<u4")
    return high.tobytes() + (coord & 0xFFFF).astype("<u2").tobytes()


def unpack(blob: bytes) -> np.ndarray:
    parts = 1 << (BITS - 16)
    high = np.frombuffer(blob, "<u4", parts)
    return np.repeat(np.arange(parts) << 16, high) + np.frombuffer(blob, "<u2", offset=4 * parts)


def _pass(table: pa.Table, state) -> pa.Table:
    """One FTRL pass of a shard from the common state; touched coordinates as integers."""
    table = table.sort_by("place")
    z, n = (np.frombuffer(a).copy() for a in state.value)
    touched = np.zeros(len(z), bool)
    for y, blob in zip(table.column("y").to_pylist(), table.column("coords")):
        c = np.append(unpack(blob.as_buffer()), BIAS)
        l1 = np.where(c == BIAS, 0.0, L1)
        zc, nc = z[c], n[c]
        w = _weights(zc, nc, l1)
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - y
        step = (np.sqrt(nc + g * g) - np.sqrt(nc)) / ALPHA
        z[c] = zc + g - step * w
        n[c] = nc + g * g
        touched[c] = True
    c = np.flatnonzero(touched)
    z0, n0 = (np.frombuffer(a) for a in state.value)
    return pa.table({"coord": pa.array(c, pa.int64()),
                     "dz": np.rint((z[c] - z0[c]) * FIXED).astype(np.int64),
                     "dn": np.rint((n[c] - n0[c]) * FIXED).astype(np.int64)})


def _shard_pass(state):
    def run(table: pa.Table) -> pa.Table:
        return _pass(table, state)
    return run


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_TRAIN_ROWS,
        rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(coordinates, weights) with non-zero weight from the labelled rows of ``docs``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where(
        "doc_id is not null and y is not null").withColumn("place", F.xxhash64("doc_id"))
    total = usable.count()
    if not total:
        return np.array([BIAS]), np.array([-1e-9])
    share = min(1.0, max_rows / max(1, total))
    shards = max(1, min(SHARDS, int(total * share) // LEAST_SHARD_ROWS))
    usable = usable.where(F.pmod("place", F.lit(1 << 20)) < int(share * (1 << 20)))
    ids = F.broadcast(usable)     # at most about max_rows rows by the line above
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id")
             .withColumn("shard", F.pmod(F.shiftright("place", 20), F.lit(shards)).cast("int")))
    rows = staged(texts.select("shard", "place", "y", "text").mapInArrow(
        _feature_rows, "shard int, place long, y int, coords binary"))
    z, n = np.zeros(BIAS + 1), np.zeros(BIAS + 1)
    for _ in range(rounds):
        state = spark.sparkContext.broadcast((z.tobytes(), n.tobytes()))
        # at most 2^BITS + 1 rows reach the driver
        step = (rows.groupBy("shard").applyInArrow(_shard_pass(state), "coord long, dz long, dn long")
                .groupBy("coord").agg(F.sum("dz").alias("dz"), F.sum("dn").alias("dn")).toArrow())
        c = step.column("coord").to_numpy()
        z[c] += step.column("dz").to_numpy() / FIXED / shards
        n[c] += step.column("dn").to_numpy() / FIXED / shards
        state.unpersist()
    l1 = np.full(BIAS + 1, L1)
    l1[BIAS] = 0.0
    w = _weights(z, n, l1)
    keep = np.flatnonzero(w)
    return keep, w[keep]


def _score(batches, text: str, model):
    coords, values = model.value
    w = np.zeros(BIAS + 1)
    w[coords] = values
    for batch in batches:
        key = features(batch.column(text), w != 0)
        margin = np.bincount(key >> KEY, weights=w[key & ((1 << KEY) - 1)], minlength=batch.num_rows)
        score = 1.0 / (1.0 + np.exp(-np.clip(margin + w[BIAS], -35, 35)))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())],
                                         names=[*batch.schema.names, "toxicity"])


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], text: str = "text") -> DataFrame:
    """The input's columns plus ``toxicity``, the probability of label 1."""
    return append_columns(docs, text, partial(_score, model=docs.sparkSession.sparkContext.broadcast(model)),
                          [T.StructField("toxicity", T.DoubleType())])


def held_out(doc_id: Column, parts: int = 5) -> Column:
    """Rows kept from training: crc32 of the doc_id as text is a multiple of ``parts``."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == 0, F.lit(False))
