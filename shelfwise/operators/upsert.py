"""Keyed upsert of a feed batch into a stored table.

The delete step is expressed with equi-joins against the *distinct* key
values of the batch (never a collected Python list, never a non-equi join),
so it scales with the stored table: a small batch key set is broadcast by
AQE from its measured size, a large one is shuffled.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _membership(df: DataFrame, col: str, values: DataFrame, tag: str) -> tuple[DataFrame, Column]:
    """SQL `col IN (values)` with three-valued logic, as a left equi-join:
    true on a hit, null when col is null and the set is not empty, else false."""
    s = values.select(F.col(col).alias(f"_v{tag}")).filter(F.col(f"_v{tag}").isNotNull()).distinct()
    hits = s.withColumn(f"_hit{tag}", F.lit(True))
    nonempty = s.agg((F.count("*") > 0).alias(f"_ne{tag}"))
    j = (df.join(hits, df[col] == hits[f"_v{tag}"], "left").drop(f"_v{tag}")
         .crossJoin(F.broadcast(nonempty)))
    e = (F.when(F.col(f"_hit{tag}"), F.lit(True))
         .when(F.col(col).isNull() & F.col(f"_ne{tag}"), F.lit(None).cast("boolean"))
         .otherwise(F.lit(False)))
    return j, e


def mark_deletes(stored: DataFrame, batch: DataFrame | None, keys: Sequence[str],
                 match: str = "cross", conditions: Mapping[str, Sequence] | None = None) -> DataFrame:
    """Adds boolean `_keep` to every stored row.

    match="cross" (reference, K1): delete where every key value occurs
    somewhere in the batch — independent sets, not tuples; a null key value
    with the others matching is lost by three-valued logic.
    match="pair": delete only rows whose key tuple occurs in the batch.
    conditions: explicit value lists per key (the CLI form); only when all
    keys are given is anything deleted.
    """
    if conditions is not None:
        bad = [c for c in conditions if c not in keys]
        if bad:
            raise ValueError(f"invalid search column(s) {bad}; allowed: {list(keys)}")
        if not all(k in conditions and len(conditions[k]) for k in keys):
            return stored.withColumn("_keep", F.lit(True))
        types = {f.name: f.dataType for f in stored.schema.fields}
        pred = None
        for k in keys:
            # values may be given as text (CLI JSON): literals cast to the
            # column's type; IN becomes a hash set and reaches the file scan
            vals = [v.isoformat(sep=" ") if isinstance(v, (_dt.date, _dt.datetime)) else v
                    for v in conditions[k]]
            e = F.col(k).isin(*[F.lit(v).cast(types[k]) for v in vals])
            pred = e if pred is None else pred & e
        return stored.withColumn("_keep", F.coalesce(~pred, F.lit(False)))
    if match == "pair":
        tuples = batch.select(*keys).dropna().distinct().withColumn("_hit", F.lit(True))
        j = stored.join(tuples, on=list(keys), how="left")
        return j.withColumn("_keep", F.col("_hit").isNull()).drop("_hit")
    if match != "cross":
        raise ValueError(f"match must be 'cross' or 'pair', not {match!r}")
    x, pred = stored, None
    for i, k in enumerate(keys):
        x, e = _membership(x, k, batch, str(i))
        pred = e if pred is None else pred & e
    drop = [c for c in x.columns if c.startswith(("_hit", "_ne"))]
    return x.withColumn("_keep", F.coalesce(~pred, F.lit(False))).drop(*drop)


def merge_numbered(stored: DataFrame | None, batch: DataFrame, keys: Sequence[str], number: str,
                   match: str = "cross", conditions: Mapping[str, Sequence] | None = None) -> DataFrame:
    """Several delivered files applied one after another, in one pass: files are
    numbered 1, 2, ... in ``number``, the stored table counts as file 0. Adds
    ``number`` to stored rows and ``_gone`` to every row: the first later file
    whose delete step removes it (null: it stays).

    A row goes when a later file holds each of its key values (match="cross",
    K1), its key tuple (match="pair"), or, with ``conditions``, at the next
    file when it meets them. Key values are joined to the short list of files
    that hold them, so nothing is expanded to rows x files."""
    rows = batch if stored is None else stored.withColumn(number, F.lit(0)).unionByName(batch, allowMissingColumns=True)
    none = F.array().cast("array<int>")
    if conditions is not None:
        last = batch.agg(F.max(number).alias("_last"))
        return (mark_deletes(rows, None, keys, match, conditions).crossJoin(F.broadcast(last))
                .withColumn("_gone", F.when(~F.col("_keep") & (F.col(number) < F.col("_last")), F.col(number) + 1))
                .drop("_keep", "_last"))
    if match == "pair":
        names = {k: f"_k{i}" for i, k in enumerate(keys)}
        held = (batch.select(number, *[F.col(k).alias(n) for k, n in names.items()]).dropna(subset=list(names.values()))
                .groupBy(*names.values()).agg(F.collect_set(number).alias("_in")))
        cond = None
        for k, n in names.items():
            cond = (rows[k] == held[n]) if cond is None else cond & (rows[k] == held[n])
        both = rows.join(held, cond, "left").drop(*names.values())
        files = F.coalesce("_in", none)
    elif match == "cross":
        both, files = rows, None
        for i, k in enumerate(keys):
            values = batch.select(number, F.col(k).alias(f"_k{i}")).where(f"_k{i} IS NOT NULL")
            held = values.groupBy(f"_k{i}").agg(F.collect_set(number).alias(f"_in{i}"))
            any_ = values.agg(F.collect_set(number).alias(f"_any{i}"))     # one row: the files with any value
            both = (both.join(held, both[k] == held[f"_k{i}"], "left").drop(f"_k{i}").crossJoin(F.broadcast(any_)))
            # a null key counts as held by every file (three-valued logic of the delete, K1)
            here = F.when(F.col(k).isNull(), F.col(f"_any{i}")).otherwise(F.coalesce(F.col(f"_in{i}"), none))
            files = here if files is None else F.array_intersect(files, here)
    else:
        raise ValueError(f"match must be 'cross' or 'pair', not {match!r}")
    gone = F.array_min(F.filter(files, lambda x: x > F.col(number)))
    return both.withColumn("_gone", gone).drop(*[c for c in both.columns if c.startswith(("_in", "_any"))])


def delete_matching(stored: DataFrame, batch: DataFrame, keys: Sequence[str], match: str = "cross",
                    conditions: Mapping[str, Sequence] | None = None) -> DataFrame:
    """The stored rows that survive the delete step."""
    return mark_deletes(stored, batch, keys, match, conditions).filter("_keep").drop("_keep")


def conform(batch: DataFrame, stored_schema) -> DataFrame:
    """Cast the batch's shared columns to the stored types (bad -> null)."""
    types = {f.name: f.dataType for f in stored_schema.fields}
    return batch.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c)
                          for c in batch.columns])


def upsert(stored: DataFrame, batch: DataFrame, keys: Sequence[str], match: str = "cross",
           conditions: Mapping[str, Sequence] | None = None) -> tuple[DataFrame, DataFrame]:
    """Delete matching stored rows, append the conformed batch.
    Returns (merged table, one-row stats). Publishing is a separate step
    (sinks.publish) because a path being read cannot be overwritten."""
    marked = mark_deletes(stored, batch, keys, match, conditions)
    kept = marked.filter("_keep").drop("_keep")
    merged = kept.unionByName(conform(batch, stored.schema), allowMissingColumns=True)
    return merged, upsert_stats(marked, batch)


def upsert_stats(marked: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows before, removed, added and final, from one pass over the
    marked stored rows plus a count of the batch."""
    s = marked.agg(F.count("*").alias("rows_before"),
                   F.count_if(~F.col("_keep")).alias("rows_removed"))
    b = batch.agg(F.count("*").alias("rows_added"))
    return (s.crossJoin(b)
            .withColumn("final_row_count", F.col("rows_before") - F.col("rows_removed") + F.col("rows_added")))
