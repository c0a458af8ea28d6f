"""Data-quality checks, row counts and table profiles (SURVEY A8, A21, C12,
C13, C14).

Checks return DataFrames (one row per rule / column) instead of printing.
Every statistic is a distributed aggregate; first rows and examples are taken
with ``orderBy(..).limit(k)`` (a bounded top-k), never by collecting a column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem (works for any cluster
    file system; a metadata call, not a job)."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def table_row_counts(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """Row count per table; a missing table gives status 'missing' and a
    null count instead of an error."""
    found = {n: path_exists(spark, p) for n, p in tables.items()}
    names = spark.createDataFrame([(n, "ok" if ok else "missing") for n, ok in found.items()], "table_name string, status string")
    scans = None        # column-less scans (row counts come from the file footers), one grouped count
    for n, p in tables.items():
        if found[n]:
            one = spark.read.parquet(p).select(F.lit(n).alias("_name"))
            scans = one if scans is None else scans.unionAll(one)
    if scans is None:
        return names.select("table_name", F.lit(None).cast("bigint").alias("row_count"), "status")
    counts = scans.groupBy("_name").agg(F.count("*").alias("_rows"))
    return (F.broadcast(names).join(counts, F.col("table_name") == F.col("_name"), "left")
            .select("table_name", F.when(F.col("status") == "ok", F.coalesce("_rows", F.lit(0))).alias("row_count"), "status"))


def in_file_order(df: DataFrame, place: str = "_place") -> DataFrame | None:
    """The rows of a file scan with their place: file name, then row number in
    the file. None for a frame that is no scan of Parquet files."""
    try:
        return df.select("*", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias(place))
    except AnalysisException:
        return None


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of a table by file name and row number. Only rows
    that are among the first ``n`` of their file are compared."""
    placed = in_file_order(df)
    if placed is None:
        raise ValueError("rows have an order only in a scan of files")
    return placed.where(F.col("_place.row") < n).orderBy("_place").limit(n).drop("_place")


def profile(df: DataFrame, examples: int = 3, approx: bool = False, sample: int = 2) -> DataFrame:
    """Per column the table's row count, the column's values in
    the first `sample` rows, null count, unique count (null counts as a value,
    as Polars n_unique does), min/max for numeric columns, the first `examples`
    non-null values for strings, else 'N/A'. Rows come in column order.

    First means by file name and row number in the file. A frame that is no file
    scan has no first rows: its sample is null and its examples are the
    smallest different values.

    Row count, null counts and ranges are one aggregate. Unique values are taken
    column by column, each reading its own column only and reduced in every task
    before the shuffle; approx=True estimates them (HyperLogLog) in the one
    aggregate. First values are a bounded top-k per column."""
    fields = df.schema.fields
    placed = in_file_order(df)
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        aggs.append(F.count_if(c.isNull()).alias(f"n{i}"))
        if approx:
            aggs.append((F.approx_count_distinct(c) + F.coalesce(F.max(F.when(c.isNull(), 1).otherwise(0)), F.lit(0)))
                        .cast("bigint").alias(f"u{i}"))
        if isinstance(f.dataType, NUMERIC):
            aggs += [F.min(c).cast("string").alias(f"lo{i}"), F.max(c).cast("string").alias(f"hi{i}")]
    stats = df.agg(*aggs)
    if placed is None:
        stats = stats.withColumn("samples", F.lit(None).cast("array<string>"))
    else:
        texts = F.array(*[F.coalesce(F.col(f"`{f.name}`").cast("string"), F.lit("null")) for f in fields])
        some = (placed.where(F.col("_place.row") < sample).select("_place", texts.alias("t")).orderBy("_place").limit(sample)
                .agg(F.array_sort(F.collect_list(F.struct("_place", "t"))).alias("firsts")))
        stats = stats.crossJoin(F.broadcast(some)).withColumn("samples", F.transform(
            F.sequence(F.lit(0), F.lit(len(fields) - 1)),
            lambda i: F.array_join(F.transform("firsts", lambda r: F.get(r["t"], i)), ", ")))
    rows = []
    for i, f in enumerate(fields):
        if isinstance(f.dataType, NUMERIC):
            stat = F.concat(F.lit("Min: "), F.coalesce(F.col(f"lo{i}"), F.lit("null")),
                            F.lit(", Max: "), F.coalesce(F.col(f"hi{i}"), F.lit("null")))
        else:
            stat = F.lit(None).cast("string")
        rows.append(F.struct(F.lit(i).alias("pos"), F.lit(f.name).alias("column_name"),
                             F.lit(f.dataType.simpleString()).alias("data_type"), F.get("samples", F.lit(i)).alias("sample_values"),
                             F.col(f"n{i}").alias("null_count"),
                             (F.col(f"u{i}") if approx else F.lit(None).cast("bigint")).alias("approx_count"),
                             stat.alias("stat")))
    long = stats.select("rows", F.explode(F.array(*rows)).alias("r")).select(F.col("rows").alias("row_count"), "r.*")
    own = None          # per column: unique count and, for text, examples
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        text = isinstance(f.dataType, T.StringType)
        values = df.select(c.alias("v")).groupBy("v").agg(F.lit(1).alias("one"))
        parts = []
        if not approx:
            parts.append(values.agg(F.count("*").alias("unique_count")).select(F.lit(i).alias("p"), "unique_count",
                                                                               F.lit(None).cast("string").alias("ex")))
        if text:
            if placed is None:
                few = values.where("v IS NOT NULL").select("v", F.col("v").alias("o")).orderBy("o").limit(examples)
            else:
                few = placed.select(c.alias("v"), F.col("_place").alias("o")).where("v IS NOT NULL").orderBy("o").limit(examples)
            joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", "v"))), lambda x: x["v"]), ", ")
            parts.append(few.agg(joined.alias("ex")).select(F.lit(i).alias("p"), F.lit(None).cast("bigint").alias("unique_count"), "ex"))
        for part in parts:
            own = part if own is None else own.unionByName(part)
    if own is not None:
        own = own.groupBy("p").agg(F.max("unique_count").alias("unique_count"), F.max("ex").alias("ex"))
        long = long.join(F.broadcast(own), F.col("pos") == F.col("p"), "left")       # one row per column
    else:
        long = long.withColumns({"unique_count": F.lit(None).cast("bigint"), "ex": F.lit(None).cast("string")})
    return long.orderBy("pos").select("row_count", "column_name", "data_type", "sample_values", "null_count",
                                      F.coalesce("unique_count", "approx_count").alias("unique_count"),
                                      F.coalesce("stat", "ex", F.lit("N/A")).alias("stat"))


# ------------------------------------------------------------------- C13
def dq_report(df: DataFrame, rules: Sequence[Mapping]) -> DataFrame:
    """One row per rule (rule, detail, observed, passed).

    Rules: {"rule": "required_columns", "columns": [...]},
    {"rule": "unique_key", "keys": [...]}, {"rule": "row_count_range", "min": a, "max": b},
    {"rule": "row_conservation", "before": DataFrame}, {"rule": "allowed_keys",
    "keys": [...], "allowed": [...]}, {"rule": "non_empty"}.

    Schema rules are decided on the driver from the schema. All data rules
    read one row of statistics: the frame's row count is one aggregate
    shared by every rule that needs it, each unique-key rule and each
    "before" frame adds one aggregate; the rule rows are then exploded from
    that single row.
    """
    stats = df.agg(F.count("*").alias("n"))
    entries = []
    for i, r in enumerate(rules):
        kind = r["rule"]
        if kind == "required_columns":
            miss = [c for c in r["columns"] if c not in df.columns]
            entries.append((kind, F.lit(",".join(miss)), F.lit(len(miss)), F.lit(not miss)))
        elif kind == "allowed_keys":
            bad = [k for k in r["keys"] if k not in r["allowed"]]
            entries.append((kind, F.lit(",".join(bad)), F.lit(len(bad)), F.lit(not bad)))
        elif kind == "unique_key":
            dup = (df.groupBy(*r["keys"]).agg(F.count("*").alias("c")).filter("c > 1")
                   .agg(F.count("*").alias(f"_d{i}")))
            stats = stats.crossJoin(F.broadcast(dup))          # one row
            entries.append((kind, F.lit(",".join(r["keys"])), F.col(f"_d{i}"), F.col(f"_d{i}") == 0))
        elif kind == "row_count_range":
            lo, hi = r["min"], r["max"]
            entries.append((kind, F.lit(f"{lo}-{hi}"), F.col("n"), F.col("n").between(lo, hi)))
        elif kind == "row_conservation":
            stats = stats.crossJoin(F.broadcast(r["before"].agg(F.count("*").alias(f"_b{i}"))))
            entries.append((kind, F.concat(F.lit("before="), F.col(f"_b{i}").cast("string")), F.col("n"),
                            F.col("n") == F.col(f"_b{i}")))
        elif kind == "non_empty":
            entries.append((kind, F.lit(""), F.col("n"), F.col("n") > 0))
        else:
            raise ValueError(f"unknown rule {kind}")
    structs = [F.struct(F.lit(k).alias("rule"), d.alias("detail"), o.cast("bigint").alias("observed"),
                        p.alias("passed")) for k, d, o, p in entries]
    return stats.select(F.explode(F.array(*structs)).alias("r")).select("r.*")
