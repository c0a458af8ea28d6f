"""Review and question backlogs.

The backlog statistics are one hash aggregate per business unit (count of
non-null dates, oldest date, count older than N days, low ratings, rows).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import scalars as S
from shelfwise.operators.enrich import join_prefix

# Fixed values from the reference.
LOW_RATINGS = [1, 2, 3]
OLDER_DAYS = 14
BLANK_BU_LABEL = "No BU"


def keep_unless_equal(df: DataFrame, column: str, value) -> DataFrame:
    """Drop rows equal to a value but keep nulls (pandas `!=`)."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(value)))


def enrich_with_fg(df: DataFrame, fg_grouped: DataFrame, upc: str = "upc",
                   text_cols: Sequence[str] = ()) -> DataFrame:
    """C5/C6 join step: left join on the first 11 chars of both UPCs (J3, may
    fan out, K13), FG text columns and the given text columns normalised
    with F4 (null -> '')."""
    fg = fg_grouped.select(F.col("upc").alias("_fg_upc"), "mpg", "ipg", "bu", "mpg_ipg", "basic_dash")
    j = join_prefix(df, fg, upc, "_fg_upc", 11, cut_right=True)
    cols = ["mpg", "ipg", "bu", "mpg_ipg", "basic_dash", *text_cols]
    return j.withColumns({c: S.strip_point_zero(c) for c in cols})


def backlog(df: DataFrame, group: str, date: str, as_of: _dt.datetime | str,
            older_days: int = OLDER_DAYS, rating: str | None = None,
            keep_blank_bu: bool = False, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Per group: count of non-null dates (K14), oldest date and its text
    ('No Date' when none), rows older than N days before as_of (zero when
    none), low-rating count (when a rating column is given) and total rows.
    Blank groups are dropped, or kept and labelled 'No BU'."""
    as_of_c = F.lit(as_of if isinstance(as_of, str) else as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    cutoff = as_of_c - F.make_interval(days=F.lit(older_days))
    g = F.coalesce(F.col(group).cast("string"), F.lit(""))
    aggs = [F.count(date).alias("count"), F.min(date).alias("oldest_date"),
            F.count_if(F.col(date) < cutoff).alias("old_count"), F.count("*").alias("row_count")]
    if rating:
        aggs.append(F.count_if(F.col(rating).isin(*LOW_RATINGS)).alias("low_rating_count"))
    if keep_blank_bu:      # label before grouping: all blank texts are one group
        df = df.withColumn("_bu", F.when(F.trim(g) == "", F.lit(BLANK_BU_LABEL)).otherwise(g))
    else:
        df = df.withColumn("_bu", g).filter(F.trim("_bu") != "")
    out = df.groupBy("_bu").agg(*aggs)
    out = out.withColumn("oldest_date_str", S.date_text(F.col("oldest_date"), date_format))
    return out.withColumnRenamed("_bu", group)


def low_rating_count(df: DataFrame, rating: str = "rating") -> DataFrame:
    """Total rows with a rating of 1, 2 or 3 (one row)."""
    return df.agg(F.count_if(F.col(rating).isin(*LOW_RATINGS)).alias("low_rating_count"))


def sort_for_report(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """O3: multi-key descending sort, nulls last."""
    return df.orderBy(*[F.col(c).desc_nulls_last() for c in cols])
