"""Results kept up to date: sums that follow an upsert's changes, and column
profiles whose distinct counts merge."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators.upsert import conform, merge_numbered
from shelfwise.session import stage_table
from shelfwise.sources import sinks as SK

ROWS = "row_count"


# ------------------------------------------------------------ A2 / C4: sums
def full_sums(df: DataFrame, group: Mapping[str, Column], measures: Mapping[str, Column]) -> DataFrame:
    """Sums and row count per group of a whole table. Measures must be exact
    (integers or decimals), so that adding and taking away gives the same."""
    for name, c in measures.items():
        kind = df.select(c).schema[0].dataType
        if not isinstance(kind, (T.IntegralType, T.DecimalType)):
            raise ValueError(f"{name} is {kind.simpleString()}; sums are kept for integers and decimals only")
    keyed = df.select(*[c.alias(n) for n, c in group.items()], *[c.alias(n) for n, c in measures.items()])
    return keyed.groupBy(*group).agg(*[_sum(m, F.col(m)) for m in measures], F.count(F.lit(1)).alias(ROWS))


def _sum(name: str, c: Column) -> Column:
    return F.coalesce(F.sum(c).cast("decimal(38,6)"), F.lit(0).cast("decimal(38,6)")).alias(name)


def changed_sums(marked: DataFrame, number: str, group: Mapping[str, Column], measures: Mapping[str, Column]) -> DataFrame:
    """What an upsert adds to the sums: rows that joined count once, stored rows
    that went count minus one. ``marked`` comes from ``merge_numbered``."""
    sign = (F.when((F.col(number) == 0) & F.col("_gone").isNotNull(), -1)
            .when((F.col(number) > 0) & F.col("_gone").isNull(), 1))
    x = marked.select(sign.alias("_sign"), *[c.alias(n) for n, c in group.items()], *[c.alias(n) for n, c in measures.items()])
    return (x.where("_sign IS NOT NULL").groupBy(*group)
            .agg(*[_sum(m, F.col(m) * F.col("_sign")) for m in measures], F.sum("_sign").cast("long").alias(ROWS)))


def merged_sums(sums: DataFrame, changes: DataFrame, group: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sums after the changes; groups without a row are gone."""
    return (sums.unionByName(changes).groupBy(*group)
            .agg(*[_sum(m, F.col(m)) for m in measures], F.sum(ROWS).cast("long").alias(ROWS)).where(F.col(ROWS) > 0))


def maintain(spark: SparkSession, table_dir: str, sums_dir: str, batch: DataFrame, keys: Sequence[str],
             group: Mapping[str, Column], measures: Mapping[str, Column], match: str = "cross") -> DataFrame:
    """Upsert one delivery into a published table and bring its sums up to date
    from the rows that went and came. The sums are published under the version
    of the table that they belong to; where that is not the current one (a first
    delivery, or a run that died between the two), they are taken from the whole
    table. Returns the sums."""
    before = SK.current_version(spark, table_dir)
    stored = SK.read_published(spark, table_dir)
    numbered = batch.withColumn("_n", F.lit(1))
    marked = merge_numbered(stored, numbered if stored is None else conform(numbered, stored.schema), list(keys), "_n", match)
    marked = stage_table(marked)
    version = SK.publish(marked.where("_gone IS NULL").drop("_n", "_gone"), table_dir)
    known = SK.current_version(spark, sums_dir)
    if before is not None and known == before:
        new = merged_sums(SK.read_published(spark, sums_dir), changed_sums(marked, "_n", group, measures), list(group), list(measures))
    else:
        new = full_sums(SK.read_published(spark, table_dir), group, measures)
    SK.publish(new, sums_dir, version)
    return SK.read_published(spark, sums_dir)


# --------------------------------------------- A6 / A21: mergeable profiles
LG_K = 12          # 4,096 registers: a standard error of about 1.6 percent
_STATS = "file string, column string, rows bigint, nulls bigint, sketch binary"


def _sketchable(c: Column, kind: T.DataType) -> Column:
    return c if isinstance(kind, (T.IntegerType, T.LongType, T.StringType, T.BinaryType)) else c.cast("string")


def _plain(path: Column) -> Column:
    """A file's address with one slash after ``file:``, as listings write it in either way."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def file_sketches(df: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """Per file of a scan and column: rows, nulls and a HyperLogLog sketch of the
    values, in one aggregate with partial sketches in every task."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        aggs += [F.count_if(c.isNull()).alias(f"n{i}"), F.hll_sketch_agg(_sketchable(c, f.dataType), F.lit(lg_k)).alias(f"s{i}")]
    one = df.select("*", _plain(F.col("_metadata.file_path")).alias("_path")).groupBy(F.col("_path").alias("file")).agg(*aggs)
    parts = [F.struct(F.lit(f.name).alias("column"), F.col(f"n{i}").alias("nulls"), F.col(f"s{i}").alias("sketch")) for i, f in enumerate(fields)]
    return one.select("file", "rows", F.explode(F.array(*parts)).alias("x")).select("file", "x.column", "rows", "x.nulls", "x.sketch")


def sketched_profile(spark: SparkSession, path: str, sketch_dir: str, lg_k: int = LG_K) -> DataFrame:
    """Rows, nulls and estimated distinct values per column of a table of
    Parquet files. Sketches are kept per file; only files that have none yet are
    read, and files that are gone no longer count. A file is known by its path:
    versions and appended files get new names."""
    table = spark.read.parquet(path)
    spark.createDataFrame([], _STATS).write.mode("ignore").parquet(sketch_dir)
    held = spark.read.schema(_STATS).parquet(sketch_dir)
    files = sorted(re.sub("^file:/+", "file:/", f) for f in table.inputFiles())      # the listing that the scan itself makes
    known = {r[0] for r in held.select("file").distinct().collect()}      # one name a file, as in the listing
    new = [f for f in files if f not in known]
    if new:
        file_sketches(spark.read.schema(table.schema).parquet(*map(unquote, new)), lg_k).select(
            "file", "column", "rows", "nulls", "sketch").write.mode("append").parquet(sketch_dir)
    now = spark.read.schema(_STATS).parquet(sketch_dir).dropDuplicates(["file", "column"])
    current = spark.createDataFrame([(f,) for f in files], "file string")
    return (now.join(current, "file", "left_semi").groupBy("column")
            .agg(F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"),
                 F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values")))
