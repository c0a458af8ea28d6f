"""Stored layouts that later reads profit from: facts partitioned by week, so
that the latest week prunes files, and tables bucketed on join keys, so that the
wide fact is joined without being shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions import scalars as S

YEAR, WEEK = "week_year", "week_no"


def write_weekly(df: DataFrame, path: str, week: str = "week") -> None:
    """A fact stored by (year, week number) of its week label (F1). Rebalancing
    puts a week's rows together and splits weeks that are large; rows whose label
    is no week get a folder of their own."""
    x = df.withColumns({YEAR: S.week_year(week), WEEK: S.week_num(week)})
    x.hint("rebalance", F.col(YEAR), F.col(WEEK)).write.mode("overwrite").partitionBy(YEAR, WEEK).parquet(path)


def latest_weeks(spark: SparkSession, path: str, weeks: int = 1) -> DataFrame:
    """Rows of the latest weeks of a fact stored by week. The weeks
    come from the folders' values (no column is read) and prune the fact's files
    while the query runs (dynamic partition pruning), without a value from the caller."""
    fact = spark.read.parquet(path)
    # the bounds say nothing new; they tell the planner that this side is selective
    known = fact.select(YEAR, WEEK).where(F.col(YEAR).between(1, 9999) & (F.col(WEEK) >= 0)).distinct()
    last = known.orderBy(F.desc(YEAR), F.desc(WEEK)).limit(weeks).where(F.col(YEAR) >= 1)
    return fact.join(F.broadcast(last), [YEAR, WEEK])


def write_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """A table in ``buckets`` files by a hash of ``keys``, sorted by them.
    Tables with the same keys and number join without a shuffle of either. Keys
    should spread the rows (week and item rather than one hot item alone): a
    bucket is one file. Returns the table."""
    (df.repartition(buckets, *keys).write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))
    return df.sparkSession.table(name)
