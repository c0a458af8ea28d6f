"""Helpers of the operators: table reading, batch bounds for Arrow functions,
and word hashing over the raw UTF-8 bytes of a whole Arrow batch.

White space is everywhere the six ASCII characters ``[\\x20\\x09-\\x0D]``; a
word is a longest run of other characters.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.session import ensure_checkpoint_dir

WS_CLASS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
WS_BYTES = b" \t\n\x0b\x0c\r"

#: Rows per Arrow batch: with texts of some kilobytes a batch stays in the low
#: megabytes, and a batch of unusually long texts still fits a Python worker.
BATCH_ROWS = 128
#: Bytes hashed at once by :func:`word_hashes` (bounds its temporary arrays).
HASH_BLOCK = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of long texts small; a lower setting of the session stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def words(text: Column) -> Column:
    """Array of the words of a text; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WS_CLASS + "+"), "")


def hashable(df: DataFrame) -> list[str]:
    """Columns that Spark can hash (maps and variants cannot be)."""
    def ok(t: T.DataType) -> bool:
        if isinstance(t, T.ArrayType):
            return ok(t.elementType)
        if isinstance(t, T.StructType):
            return all(ok(f.dataType) for f in t.fields)
        return not isinstance(t, T.MapType) and t.typeName() not in ("variant", "geometry", "geography")
    return [f.name for f in df.schema.fields if ok(f.dataType)]


def quoted(name: str) -> Column:
    """Column by its exact name, also when that name holds dots or back-ticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def append_columns(docs: DataFrame, text: str, fn, fields: list[T.StructField]) -> DataFrame:
    """``docs`` plus the columns ``fields`` that ``fn(batches, name)`` appends to
    Arrow batches; ``name`` is the text's column there. Columns travel under
    plain names, so any column name is fine; those named like the new ones go."""
    bounded_batches(docs.sparkSession)
    docs = docs.drop(*[f.name for f in fields])
    names = docs.columns
    plain = [f"c{i}" for i in range(len(names))]
    kinds = [T.StructField(p, f.dataType) for p, f in zip(plain, docs.schema.fields)]
    at = plain[names.index(text)]
    return (docs.toDF(*plain).mapInArrow(lambda batches: fn(batches, at), T.StructType([*kinds, *fields]))
            .toDF(*names, *[f.name for f in fields]))


# ---- hashing of words in numpy ------------------------------------------------

_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift and multiply)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE = mix64(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_STEP = _U(0xD6E8FEB86659FD93)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WS = np.zeros(256, dtype=bool)
IS_WS[list(WS_BYTES)] = True


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of a column and the offsets of each (a null is empty)."""
    column = column.fill_null("") if column.null_count else column
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def keep_bytes(raw: np.ndarray, offsets: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes where ``keep`` holds, with the offsets moved accordingly."""
    before = np.concatenate([[0], np.cumsum(keep)])
    return raw[keep], before[offsets]


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the first word index of each text
    (one more entry than texts). Words never cross texts."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = ~IS_WS[raw]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = solid[:-1]
    cut = offsets[offsets < n]
    before[cut] = False
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = solid[1:]
    after[offsets[offsets > 0] - 1] = False
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets, "left")


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes (polynomial over mixed bytes, finalised)."""
    out = np.empty(len(starts), _U)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + HASH_BLOCK, "right")))
        s, lens = starts[i:j], ends[i:j] - starts[i:j]
        first = np.concatenate([[0], np.cumsum(lens)[:-1]])
        pos = np.arange(int(lens.sum())) - np.repeat(first, lens)
        power = np.cumprod(np.full(int(lens.max()), _STEP, _U))
        h = np.add.reduceat(_BYTE[raw[pos + np.repeat(s, lens)]] * power[pos], first)
        out[i:j] = mix64(h + lens.astype(_U))
        i = j
    return out


def chain(*parts: np.ndarray) -> np.ndarray:
    """Order-dependent hash of equally long arrays of hashes."""
    h = np.full(len(parts[0]), len(parts), _U) * _U(0x9E3779B97F4A7C15)
    for p in parts:
        h = mix64(h * _U(0xC2B2AE3D27D4EB4F) + p)
    return h


def sha256_hex(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """Path of a new folder in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """Write a frame once into the shared checkpoint folder and read it back:
    cuts the lineage, survives lost executors and computes the plan one time."""
    spark = df.sparkSession
    path = scratch_folder(spark, "staged")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
