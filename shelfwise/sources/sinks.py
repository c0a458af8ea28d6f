"""Sinks: Parquet writes, versioned publish with numbered
pointer files (atomic replace + kept backups), partitioned report output and
a partition-local upsert for large keyed tables.

Paths go through the Hadoop FileSystem API so the same code works on HDFS,
object stores and local disk.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions import scalars as S

POINTERS = "_pointers"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet (snappy is Spark's default codec)."""
    df.write.mode(mode).parquet(path)


def _pointer_names(spark: SparkSession, table_dir: str) -> list[str]:
    fs, p = _fs(spark, f"{table_dir}/{POINTERS}")
    if not fs.exists(p):
        return []
    return sorted(n for n in (f.getPath().getName() for f in fs.listStatus(p)) if n.isdigit())


def current_pointer(spark: SparkSession, table_dir: str) -> dict | None:
    """The newest pointer: its version and the batch it came from (or None)."""
    names = _pointer_names(spark, table_dir)
    if not names:
        return None
    fs, p = _fs(spark, f"{table_dir}/{POINTERS}/{names[-1]}")
    reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        return json.loads(reader.readLine())
    finally:
        reader.close()


def _move_pointer(spark: SparkSession, table_dir: str, content: dict, after: list[str]) -> None:
    """Numbered pointer files: a new one appears by a single rename to a name
    that does not exist yet, so readers see the old pointer or the new one."""
    folder = f"{table_dir}/{POINTERS}"
    fs, tmp = _fs(spark, f"{folder}/.tmp-{uuid.uuid4().hex}")
    out = fs.create(tmp, False)
    out.write(bytearray(json.dumps(content).encode("utf-8")))
    out.close()
    number = int(after[-1]) + 1 if after else 1
    final = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{number:012d}")
    if fs.exists(final) or not fs.rename(tmp, final):
        fs.delete(tmp, False)
        raise RuntimeError(f"{table_dir}: another publish took place meanwhile; read the table again and retry")


def current_version(spark: SparkSession, table_dir: str) -> str | None:
    now = current_pointer(spark, table_dir)
    return now["version"] if now else None


def publish(df: DataFrame, table_dir: str, version: str | None = None, batch: int | None = None) -> str:
    """Write the new content to a version folder of its own, then add
    a pointer. Every attempt writes a new folder (an existing name gets a
    suffix), so neither a failed nor a retried job ever touches a published
    version; old versions stay as backups. ``batch``: an increasing number
    recorded with the pointer; a batch already applied is skipped. Returns the
    version that is current afterwards."""
    spark = df.sparkSession
    before = _pointer_names(spark, table_dir)
    now = current_pointer(spark, table_dir)
    if batch is not None and now and now.get("batch") is not None and now["batch"] >= batch:
        return now["version"]
    version = version or _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d_%H%M%S_%f")
    fs, p = _fs(spark, f"{table_dir}/v={version}")
    if fs.exists(p):
        version = f"{version}-{uuid.uuid4().hex[:12]}"
    df.write.mode("errorifexists").parquet(f"{table_dir}/v={version}")
    _move_pointer(spark, table_dir, {"version": version, "batch": batch}, before)
    return version


def read_published(spark: SparkSession, table_dir: str, version: str | None = None) -> DataFrame | None:
    v = version or current_version(spark, table_dir)
    if v is None:
        return None
    return spark.read.parquet(f"{table_dir}/v={v}")


def write_partitioned(df: DataFrame, path: str, by: str, sort: Sequence[str] = (),
                      label: str | None = None, descending: bool = True) -> None:
    """One output folder per (sanitised, F12) label, in order: read by
    file name, a folder's rows are sorted by ``sort`` (falling, nulls last). The
    label is a column of its own (``<by>_label``), so groups whose labels fall
    together stay apart by ``by``.

    Rows are range-partitioned by (label, sort keys, a hash of the row) with bounds
    that Spark samples, so a label with a third of the rows spans as many tasks as
    its size needs, and task numbers, which the file names carry, follow the order.
    AQE joins small neighbouring ranges. The sampling reads the frame's sort columns
    once more; stage a frame that is dear to compute."""
    label = label or f"{by}_label"
    x = df.withColumn(label, S.safe_label(F.col(by)))
    keys = [F.col(f"`{c}`").desc_nulls_last() if descending else F.col(f"`{c}`").asc_nulls_last() for c in sort]
    whole = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, T.MapType)])
    order = [F.col(label), *keys, whole]
    x.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").partitionBy(label).parquet(path)


def order_report(spark: SparkSession, path: str, label: str, key: str) -> DataFrame:
    """Per label of a partitioned output: rows, files, rows that stand after a
    smaller one of their file, and files that begin with a greater key than the
    file before ends with (both 0 where read order is falling order of ``key``)."""
    at = spark.read.parquet(path).select(F.col(label).cast("string").alias("label"), F.col(f"`{key}`").alias("k"),
                                         F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    inside = Window.partitionBy("label", "file").orderBy("row")
    # nulls come last, so a value after a null is out of place too
    before = F.lag(F.struct(F.col("k").isNull().alias("none"), "k")).over(inside)
    wrong = before.isNotNull() & ((before["none"] & F.col("k").isNotNull()) | F.coalesce(before["k"] < F.col("k"), F.lit(False)))
    files = (at.withColumn("wrong", wrong).groupBy("label", "file")
             .agg(F.count("*").alias("n"), F.count_if("wrong").alias("wrong"), F.min_by("k", "row").alias("first"), F.max_by("k", "row").alias("last")))
    ends = Window.partitionBy("label").orderBy("file")
    late = F.coalesce(F.lag("last").over(ends) < F.col("first"), F.lit(False))
    return (files.withColumn("late", late).groupBy("label")
            .agg(F.sum("n").alias("rows"), F.count("*").alias("files"), F.sum("wrong").alias("rows_out_of_order"),
                 F.count_if("late").alias("files_out_of_order")))


def read_partitioned(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """A partitioned table with the types of ``like`` for the columns both have
    (folder names carry no types; guessing would turn '007' into 7)."""
    types = {f.name: f.dataType for f in like.schema.fields}
    found = spark.read.parquet(path).schema
    return spark.read.schema(T.StructType([T.StructField(f.name, types.get(f.name, f.dataType)) for f in found.fields])).parquet(path)


def upsert_partitioned(spark: SparkSession, table_path: str, batch: DataFrame, keys: Sequence[str],
                       partition_col: str, match: str = "cross", file_no: str | None = None) -> DataFrame:
    """C1 for a large table partitioned by the first key (e.g. day): only the
    partitions whose value (null included) occurs in the batch are rewritten.
    With ``file_no`` (1, 2, ...) the batch's files apply one after another.
    The new content is written once to the shared checkpoint folder (cutting
    the lineage to the files about to be replaced), then moved in by dynamic
    partition overwrite. Returns the per-partition row counts written.

    Difference to the whole-table upsert: stored rows whose partition value
    is null are compared only if the batch itself holds a null partition value."""
    from shelfwise.operators.upsert import conform, merge_numbered
    from shelfwise.session import stage_table

    stored = read_partitioned(spark, table_path, batch.select(partition_col))
    touched = batch.select(F.col(partition_col).alias("_touched")).distinct()
    affected = stored.join(touched, F.col(partition_col).eqNullSafe(F.col("_touched")), "left_semi")
    number = file_no or "_file_no"
    numbered = batch if file_no else batch.withColumn(number, F.lit(1))
    marked = merge_numbered(affected, conform(numbered, stored.schema), keys, number, match)
    new = stage_table(marked.where("_gone IS NULL").select(*stored.columns))
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(table_path)
    return new.groupBy(partition_col).agg(F.count("*").alias("rows"))
