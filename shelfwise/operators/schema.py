"""Schema operations as DataFrame -> DataFrame.

Column checks look at the schema only (driver side, no job is run).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class MissingColumns(ValueError):
    pass


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required columns absent from the frame, in the given order."""
    have = set(df.columns)
    return [c for c in required if c not in have]


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    miss = missing_columns(df, required)
    if miss:
        raise MissingColumns(f"missing columns: {miss}")
    return df


def add_missing(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add absent columns as typed nulls."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def trim_headers(df: DataFrame) -> DataFrame:
    """Strip spaces around column names."""
    return df.toDF(*[c.strip() for c in df.columns])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename the present columns."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def backfill(df: DataFrame, derived: Mapping[str, Column]) -> DataFrame:
    """Add a derived column only when the frame does not have it yet."""
    return df.withColumns({c: e for c, e in derived.items() if c not in df.columns})


def order_counts(visits: str, rate: str) -> Column:
    """Order count = visits * conversion rate, as float."""
    return (F.col(visits) * F.col(rate)).cast("float")


def derive_order_counts(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """P7 for several outputs: {name: (visits column, rate column)}."""
    return df.withColumns({n: order_counts(v, r) for n, (v, r) in pairs.items()})


def insert_constants(df: DataFrame, constants: Mapping[str, object]) -> DataFrame:
    """Constant columns placed in front."""
    return df.select(*[F.lit(v).alias(k) for k, v in constants.items()],
                     *[F.col(f"`{c}`") for c in df.columns if c not in constants])


def drop_all_null(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows where every column of the subset is null."""
    return df.dropna(how="all", subset=list(subset))


def widen(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Widen stored columns (e.g. int -> float) before new data is
    appended; absent columns are ignored."""
    return df.withColumns({c: F.col(f"`{c}`").cast(t) for c, t in types.items() if c in df.columns})
