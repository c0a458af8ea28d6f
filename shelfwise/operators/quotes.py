"""Quote summaries.

Averages of money are exact sum / count (sum in decimal, so the result does
not depend on the order in which partitions are combined)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import scalars as S
from shelfwise.operators.enrich import join_null_safe

# Fixed value from the reference: quotes above this total are reported.
QUOTE_THRESHOLD = 15000


def money_mean(c: str) -> Column:
    """Mean of a money column as double. The sum is exact (decimal with twelve
    places, finer than any amount), so it does not depend on the order in
    which partitions are combined."""
    return F.sum(F.col(c).cast("decimal(38,12)")).cast("double") / F.count(c)


def quotes_above(quotes: DataFrame, territory: DataFrame, threshold: float = QUOTE_THRESHOLD,
                 store: str = "store", store_no: str = "store_no", owner: str = "owner",
                 total_text: str = "quote_total_text") -> DataFrame:
    """Owner lookup by store (null-safe, J5), total coerced to a number (bad ->
    null, F9), rows above the threshold (W6)."""
    j = join_null_safe(quotes, territory, store, store_no, [owner])
    j = j.withColumn("quote_total", S.to_number(total_text))
    return j.filter(F.col("quote_total") > threshold)


def pivot_mean(df: DataFrame, keys: Sequence[str], value: str = "quote_total") -> DataFrame:
    """Mean value per key tuple; rows with a null key are dropped (pandas
    pivot_table)."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(money_mean(value).alias(value))


def owner_summary(df: DataFrame, owner: str = "owner", order: str = "order_no",
                  value: str = "quote_total") -> DataFrame:
    """A10: per owner the distinct orders (nulls ignored, pandas nunique) and
    the mean quote total; null owners are dropped (pandas groupby)."""
    return (df.filter(F.col(owner).isNotNull()).groupBy(owner)
            .agg(F.countDistinct(order).alias("unique_orders"), money_mean(value).alias("avg_quote_total")))
