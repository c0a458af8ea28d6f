"""Importance resampling towards a target distribution over hashed word runs.

The raw documents and the texts of the target are both seen as bags of hashed
features (Xie et al., 2023, "Data selection for language models via importance
resampling"). A feature is a run of 1 to ``longest`` consecutive words, joined
by one space; its bucket is the CRC-32 of its UTF-8 bytes modulo ``buckets``.

1. *Gains.* Every task adds its features up in one array of ``buckets`` counts;
   the arrays' non-zero entries are summed by bucket. A bucket's gain is the
   log ratio of its smoothed shares in target and raw texts, in whole
   thousandths. The gains are one array of ``buckets`` longs on every task.
2. *Weights.* A document's weight is the sum of that array over its features.
   Its score adds Gumbel noise seeded by its identifier, so that the highest
   scores are a draw without replacement in proportion to exp(weight).
3. *Distributed quickselect.* Scored rows have a total order, the composite key
   (score falling, identifier, features, place in the staged table). To find
   the key of the last row to draw, rows still open give PIVOTS keys at random;
   one aggregate counts the rows before, at and after each; the open range
   shrinks to that between two pivots, until a pivot is the wanted key.
   Expected rounds are logarithmic in the number of rows, to the base PIVOTS.
4. *Winners only* are range-partitioned by key, sorted and ranked: the place in
   the partition plus the rows of all partitions before it. No row is ranked
   in a single task, and rows not drawn are never sorted.

Words are longest runs of ASCII letters (A-Z lower-cased), digits and all
non-ASCII characters.

Defined results: null and empty texts have no features and weight 0; a null
identifier hashes as the empty string and comes last among equal scores; rows
of equal score and identifier are drawn by fewer features, then in any order
(repeated rows are alike); rows with too few words are never drawn but do count
in the statistics; an empty target makes all gains follow the raw counts alone;
an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import LOWER, bounded_batches, staged, text_bytes

PIVOTS = 15
#: Features of at most so many bytes are hashed together, longer ones singly.
SHORT = 32

_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_ONES = np.uint32(0xFFFFFFFF)


def _crc_table() -> np.ndarray:
    """Table of the reflected CRC-32 polynomial, by its defining rule."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & np.uint32(1), (t >> np.uint32(1)) ^ np.uint32(0xEDB88320), t >> np.uint32(1))
    return t


_TABLE = _crc_table()


def crc32s(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of many byte ranges: short ones byte by byte all at once, in
    falling order of length so that finished ones drop off the end."""
    lens = ends - starts
    out = np.empty(len(starts), np.uint32)
    long_ones = np.flatnonzero(lens > SHORT)
    for i in long_ones:
        out[i] = zlib.crc32(raw[starts[i]:ends[i]])
    short = np.flatnonzero(lens <= SHORT)
    short = short[np.argsort(-lens[short].astype(np.int8), kind="stable")]
    at, n = starts[short], lens[short]
    crc = np.full(len(short), _ONES)
    live = np.searchsorted(-n, -np.arange(1, SHORT + 1), "right")      # ranges of at least 1, 2, ... bytes
    for k, m in enumerate(live):
        if not m:
            break
        crc[:m] = _TABLE[(crc[:m] ^ raw[at[:m] + k]) & np.uint32(255)] ^ (crc[:m] >> np.uint32(8))
    out[short] = crc ^ _ONES
    return out


def features(column: pa.Array, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features of a column of texts, the text of each, and the
    number of words of every text."""
    raw, offsets = text_bytes(column)
    n_texts = len(offsets) - 1
    low = LOWER[raw]
    solid = _IN_WORD[low]
    edge = np.zeros(len(low) + 1, bool)
    edge[offsets] = True                              # words never cross texts
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:-1]
    stops = solid.copy()
    stops[:-1] &= ~solid[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    first = np.searchsorted(starts, offsets, "left")
    n_words = np.diff(first)
    text_of = np.repeat(np.arange(n_texts), n_words)
    if longest == 1:
        return (crc32s(low, starts, ends) % np.uint32(buckets)).astype(np.int64), text_of, n_words
    # words joined by one space, so that every run is one byte range
    lens = ends - starts
    joined_at = np.concatenate([[0], np.cumsum(lens + 1)])
    joined = np.full(int(joined_at[-1]), 32, np.uint8)
    where = np.arange(int(lens.sum())) + np.repeat(np.arange(len(lens)), lens)
    joined[where] = low[solid]
    joined_at, joined_end = joined_at[:-1], joined_at[:-1] + lens
    found, owner = [], []
    for k in range(longest):
        whole = text_of[k:] == text_of[:len(text_of) - k]
        found.append(crc32s(joined, joined_at[:len(text_of) - k][whole], joined_end[k:][whole]) % np.uint32(buckets))
        owner.append(text_of[k:][whole])
    return np.concatenate(found).astype(np.int64), np.concatenate(owner), n_words


def bucket_counts(texts: DataFrame, longest: int = 1, buckets: int = 10_000, text: str = "text") -> DataFrame:
    """(bucket, n) over all texts, non-zero buckets only. A task holds one array
    of ``buckets`` counts, whatever it reads."""
    bounded_batches(texts.sparkSession)

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            found, _, _ = features(batch.column("text"), longest, buckets)
            total += np.bincount(found, minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(total[hit], pa.int64())], names=["bucket", "n"])

    slim = texts.select(F.col("`" + text + "`").cast("string").alias("text"))
    return slim.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000) -> np.ndarray:
    """Gain of every bucket; two arrays of ``buckets`` counts reach the driver."""
    def counts(df):
        out = np.zeros(buckets)
        t = bucket_counts(df, longest, buckets).toArrow()
        out[t.column("bucket").to_numpy()] = t.column("n").to_numpy()
        return out
    s, t = counts(docs), counts(target)
    return np.floor(1000.0 * np.log((t + 1.0) * (s.sum() + buckets) / ((s + 1.0) * (t.sum() + buckets)))).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, longest: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches):
        value = shared.value
        for batch in batches:
            found, owner, n_words = features(batch.column("text"), longest, len(value))
            weight = np.zeros(batch.num_rows, np.int64)
            np.add.at(weight, owner, value[found])
            n = np.bincount(owner, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n, pa.int64()), pa.array(weight, pa.int64())],
                names=["doc_id", "n_words", "n_features", "weight"])

    slim = docs.select(F.col("`" + doc_id + "`").cast("long").alias("doc_id"), F.col("`" + text + "`").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in whole thousandths, from a digest of seed and identifier."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(-1000.0 * F.log(-F.log(u)))


#: The composite key, smallest first: earlier rows are drawn first.
_KEY = ["falling", "no_id", "id", "n_features", "uid"]


def _key_columns() -> list[Column]:
    return [(-F.col("score")).alias("falling"), F.col("doc_id").isNull().alias("no_id"),
            F.coalesce("doc_id", F.lit(0)).alias("id")]


def _literal(key) -> Column:
    kinds = ["long", "boolean", "long", "long", "long"]
    return F.struct(*[F.lit(v).cast(t).alias(c) for v, t, c in zip(key, kinds, _KEY)])


def kth_key(rows: DataFrame, k: int, pivots: int = PIVOTS):
    """The k-th smallest key (1 is the first) of rows with unique keys.

    Each round reads the rows between two known keys, takes ``pivots`` of them by
    the smallest of a random hash, and counts rows before and at each pivot."""
    key = F.struct(*_KEY)
    low = high = None            # the wanted key lies strictly between these
    before, round_ = 0, 0        # rows known to come before the open range
    while True:
        open_ = rows
        if low is not None:
            open_ = open_.where((F.col("falling") >= F.lit(low[0])) & (key > _literal(low)))
        if high is not None:
            open_ = open_.where((F.col("falling") <= F.lit(high[0])) & (key < _literal(high)))
        drawn = (open_.orderBy(F.xxhash64("uid", F.lit(round_)), "uid").limit(pivots).select(*_KEY).collect())
        keys = sorted(tuple(r) for r in drawn)
        sums = []
        for i, p in enumerate(keys):
            sums += [F.count_if(key < _literal(p)).alias(f"less{i}"), F.count_if(key == _literal(p)).alias(f"same{i}")]
        got = open_.agg(*sums).first()
        passed = 0
        for i, p in enumerate(keys):
            less, same = before + got[f"less{i}"], got[f"same{i}"]
            if less < k <= less + same:
                return p
            if k <= less:
                high = p
                break
            low, passed = p, less + same
        before = max(before, passed)
        round_ += 1


def ranked(winners: DataFrame, parts: int) -> DataFrame:
    """``winners`` with rank 1, 2, 3 ... by key: range partitions, the place in
    each, and the rows of those before."""
    held = staged(winners.repartitionByRange(parts, *_KEY).sortWithinPartitions(*_KEY)
                  .withColumn("part", F.spark_partition_id()))
    sizes = sorted(tuple(r) for r in held.groupBy("part").count().collect())       # one row a partition
    starts, at = {}, 0
    for part, n in sizes:
        starts[part] = at
        at += n
    spark = winners.sparkSession
    offsets = spark.createDataFrame(list(starts.items()) or [(0, 0)], "part int, offset long")
    place = F.row_number().over(Window.partitionBy("part").orderBy(*_KEY))
    return (held.join(F.broadcast(offsets), "part").withColumn("rank", place.cast("long") + F.col("offset"))
            .drop("part", "offset"))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, longest: int = 1,
             buckets: int = 10_000, seed: int = 2024) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every document; rank
    is null for documents not drawn. ``percent`` of those with ``least_words``
    words or more are drawn."""
    spark = docs.sparkSession
    scored = weigh(docs, gains(docs, target, longest, buckets), longest)
    scored = scored.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    # the number given here is stored with the row, so a row's key never changes
    scored = staged(scored.withColumn("uid", F.monotonically_increasing_id()).select("*", *_key_columns()))
    fit = scored.where(F.col("n_words") >= least_words)
    n = fit.count()
    k = percent * n // 100
    out = ["doc_id", "n_words", "n_features", "weight", "score"]
    undrawn = F.lit(None).cast("long").alias("rank")
    if not k:
        return scored.select(*out, undrawn)
    last = _literal(kth_key(fit, k))
    drawn = (F.col("n_words") >= least_words) & (F.struct(*_KEY) <= last)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (ranked(scored.where(drawn), parts).select(*out, "rank")
            .unionByName(scored.where(~drawn).select(*out, undrawn)))
