"""First-per-key, duplicate detection, prefer-active de-duplication and
ordered text roll-ups (SURVEY A4, A5, A12-A16, C9, N1, N3).

"First" always means first by an explicit order (K8). The key operators
are aggregates with map-side partial aggregation (min_by / bool_and /
count; sort-based where the buffer is a struct), so a hot key is
pre-reduced in every task before the shuffle instead of being sorted whole
in one window partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions import scalars as S

# Item statuses the reference treats as obsolete.
OBSOLETE_STATUSES = ["Z-Obsolete", "Obsolete", "Sell Off", "Final Bld", "Sell Out", "Build Out"]


def ordered_listagg(value: str, sep: str, order: str) -> Column:
    """listagg(value, sep) WITHIN GROUP (ORDER BY order) on named columns."""
    q = sep.replace("'", "''")
    return F.expr(f"listagg(`{value}`, '{q}') WITHIN GROUP (ORDER BY `{order}`)")


def _order_struct(order: Sequence[str | Column]) -> Column:
    cols = [F.col(o) if isinstance(o, str) else o for o in order]
    return F.struct(*cols)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The whole first row per key (all columns from one row)."""
    rest = [c for c in df.columns if c not in keys]
    g = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in rest]),
                                       _order_struct(order)).alias("_row"))
    return g.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def first_nonnull_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                          columns: Sequence[str] | None = None) -> DataFrame:
    """A5: per column, the first non-null value per key (pandas 'first')."""
    cols = columns or [c for c in df.columns if c not in keys]
    o = _order_struct(order)
    return df.groupBy(*keys).agg(*[
        F.min_by(F.col(c), F.when(F.col(c).isNotNull(), o)).alias(c) for c in cols])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("count")).filter(F.col("count") > 1)


def distinct_count(df: DataFrame, columns: Sequence[str], null_as_value: bool = False,
                   approx: bool = False) -> DataFrame:
    """Distinct values per column in one aggregate. pandas `nunique`
    ignores nulls (default); Polars `n_unique` counts null as a value
    (null_as_value=True). approx=True uses HyperLogLog for very large data."""
    aggs = []
    for c in columns:
        col = F.col(f"`{c}`")
        n = F.approx_count_distinct(col) if approx else F.countDistinct(col)
        if null_as_value:
            n = n + F.max(F.when(col.isNull(), 1).otherwise(0))
        aggs.append(n.cast("bigint").alias(c))
    return df.agg(*aggs)


def top_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int,
                    buckets: int | None = None) -> DataFrame:
    """N4 per group: the first n rows of each group by `order` (make the order
    total for a deterministic result). Each group is first cut to n rows per
    hash bucket of its rows, so a group holding a third of the data is ranked
    by many tasks; the final ranking per group sees at most buckets * n rows.
    The buckets default to the session's shuffle partitions."""
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(buckets))
    x = df.withColumn("_salt", salt)
    w1 = Window.partitionBy(*group, "_salt").orderBy(*order)
    x = x.withColumn("_r", F.row_number().over(w1)).filter(F.col("_r") <= n).drop("_r", "_salt")
    w2 = Window.partitionBy(*group).orderBy(*order)
    return x.withColumn("rank", F.row_number().over(w2)).filter(F.col("rank") <= n)


def group_all_any(df: DataFrame, group: Sequence[str], conditions: Mapping[str, Column]) -> DataFrame:
    """Per group, whether a condition holds for all rows (`<name>_all`)
    and for any row (`<name>_any`); a null condition counts as false, as a
    pandas comparison with a missing value does."""
    aggs = []
    for name, cond in conditions.items():
        c = F.coalesce(cond, F.lit(False))
        aggs += [F.bool_and(c).alias(f"{name}_all"), F.bool_or(c).alias(f"{name}_any")]
    return df.groupBy(*group).agg(*aggs)


def distinct_tuple_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of distinct key tuples (nulls count as a value)."""
    return df.select(*keys).distinct().agg(F.count("*").alias("distinct_count"))


def rollup_text(df: DataFrame, key: Sequence[str], spec: Mapping[str, tuple[str, bool]],
                order: Sequence[str | Column], null_text: str | None = None,
                empty: str | None = "") -> DataFrame:
    """Ordered string roll-up per key.

    spec: {column: (separator, unique)}. Duplicates keep input order; unique
    keeps the first appearance order. Nulls are dropped unless null_text is
    given (pandas astype(str) turns them into 'nan'). An all-null group gives
    ``empty``.
    """
    o = _order_struct(order)

    def text(c):
        v = F.col(c).cast("string")
        return F.coalesce(v, F.lit(null_text)) if null_text is not None else v

    def finish(agg, c):
        return (F.coalesce(agg, F.lit(empty)) if empty is not None else agg).alias(c)

    src = df.select(*key, o.alias("_o"), *[text(c).alias(f"_t_{c}") for c in spec])
    plain = [finish(ordered_listagg(f"_t_{c}", sep, "_o"), c)
             for c, (sep, unique) in spec.items() if not unique]
    out = src.groupBy(*key).agg(*plain) if plain else df.select(*key).distinct()
    for c, (sep, unique) in spec.items():
        if not unique:
            continue
        # Unique values in first-appearance order: reduce to one row per
        # (key, value) with its first position first (partial aggregation),
        # so only distinct values reach the final roll-up.
        firsts = (src.select(*key, F.col(f"_t_{c}").alias("_v"), "_o")
                  .groupBy(*key, "_v").agg(F.min("_o").alias("_o")))
        u = firsts.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)]).agg(
            finish(ordered_listagg("_v", sep, "_o"), c))
        cond = None
        for i, k in enumerate(key):
            e = out[k].eqNullSafe(u[f"_k{i}"])
            cond = e if cond is None else cond & e
        out = out.join(u, cond, "left").drop(*[f"_k{i}" for i in range(len(key))])
    return out


def prefer_active(df: DataFrame, key: str, status: str, obsolete: Sequence[str] = OBSOLETE_STATUSES,
                  ) -> DataFrame:
    """C9 row filter: for each key keep the non-obsolete rows; when every row
    of the key is obsolete keep them all. The per-key flag is a partial
    aggregate joined back on the key (no O(keys x rows) loop, no window)."""
    flagged = df.withColumn("_obs", F.coalesce(F.col(status).isin(*obsolete), F.lit(False)))
    allobs = flagged.groupBy(key).agg(F.bool_and("_obs").alias("_all_obs"))
    j = flagged.join(allobs, on=key, how="inner")
    return j.filter(~F.col("_obs") | F.col("_all_obs")).drop("_obs", "_all_obs")


def prefer_active_rollup(df: DataFrame, upc: str, status: str, item: str,
                         order: Sequence[str | Column], obsolete: Sequence[str] = OBSOLETE_STATUSES,
                         sep: str = ",", null_text: str = "nan") -> DataFrame:
    """Clean the code (F5), prefer active rows, roll up status and item
    number per code (input order, null -> 'nan').

    One aggregate by code: the texts of the active rows, those of all rows and
    whether any row is active; the choice follows per code. A code's text
    necessarily holds all of that code's kept rows."""
    key = F.coalesce(S.clean_upc_key(F.col(upc)), F.lit(null_text))
    x = df.select(key.alias("upc"), _order_struct(order).alias("_o"),
                  F.coalesce(F.col(status).isin(*obsolete), F.lit(False)).alias("_obs"),
                  F.coalesce(F.col(status).cast("string"), F.lit(null_text)).alias("_s"),
                  F.coalesce(F.col(item).cast("string"), F.lit(null_text)).alias("_i"))
    x = x.withColumns({f"_active{c}": F.when(~F.col("_obs"), F.col(c)) for c in ("_s", "_i")})
    g = x.groupBy("upc").agg(F.bool_and("_obs").alias("_all_obs"), *[
        ordered_listagg(c, sep, "_o").alias(c) for c in ("_s", "_i", "_active_s", "_active_i")])
    pick = lambda c: F.when(F.col("_all_obs"), F.col(c)).otherwise(F.col(f"_active{c}"))
    return g.select("upc", pick("_s").alias(status), pick("_i").alias(item))
