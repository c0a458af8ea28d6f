"""Joins and catalogue enrichment.

Physical join choice is left to Catalyst + AQE: a dimension below the
broadcast threshold (measured, not assumed) becomes a BroadcastHashJoin, a
large one a shuffled join whose skewed partitions AQE splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import scalars as S
from shelfwise.operators.dedupe import first_nonnull_per_key, first_per_key


def join_prefix(left: DataFrame, right: DataFrame, left_code: str, right_code: str,
                n: int = 11, right_cols: Sequence[str] | None = None,
                cut_right: bool = True, how: str = "left",
                one_per_prefix: Sequence[str] | None = None) -> DataFrame:
    """Left join on the first n characters of a code. With cut_right the
    right code is cut too (both sides cut; may fan out, K13); otherwise the
    right code already is the n-char key. `one_per_prefix` (an order) keeps
    only the first right row per prefix, so left rows never fan out."""
    rk = S.prefix(F.col(right_code), n) if cut_right else F.col(right_code).cast("string")
    cols = right_cols if right_cols is not None else [c for c in right.columns if c != right_code]
    if one_per_prefix:
        r = first_per_key(right.select(rk.alias("_pk"), *cols, *[c for c in one_per_prefix if c not in cols]),
                          ["_pk"], list(one_per_prefix)).select("_pk", *cols)
    else:
        r = right.select(rk.alias("_pk"), *cols)
    l = left.withColumn("_pk", S.prefix(F.col(left_code), n))
    return l.join(r, on="_pk", how=how).drop("_pk")


def join_null_safe(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                   right_cols: Sequence[str], how: str = "left") -> DataFrame:
    """Lookup join where null matches null (pandas merge); the right key
    is dropped."""
    r = right.select(F.col(right_key).alias("_rk"), *right_cols)
    return left.join(r, left[left_key].eqNullSafe(r["_rk"]), how).drop("_rk")


def outer_with_indicator(low: DataFrame, high: DataFrame, keys: Sequence[str],
                         suffixes: tuple[str, str] = ("_low", "_high")) -> DataFrame:
    """Full outer join with a side indicator (left_only/right_only/both)
    and suffixes on the non-key columns."""
    lo = low.select(*keys, *[F.col(c).alias(c + suffixes[0]) for c in low.columns if c not in keys],
                    F.lit(True).alias("_in_low"))
    hi = high.select(*keys, *[F.col(c).alias(c + suffixes[1]) for c in high.columns if c not in keys],
                     F.lit(True).alias("_in_high"))
    j = lo.join(hi, on=list(keys), how="full_outer")
    side = (F.when(F.col("_in_low") & F.col("_in_high"), F.lit("both"))
            .when(F.col("_in_low"), F.lit("left_only")).otherwise(F.lit("right_only")))
    return j.withColumn("merge_side", side).drop("_in_low", "_in_high")


def missing_ids(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Distinct ids present in old but in no row of new."""
    return old.select(key).distinct().join(new.select(key), on=key, how="left_anti")


def key_spine(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct union of key tuples observed in two facts."""
    return a.select(*keys).unionByName(b.select(*keys)).distinct()


def distribute_evenly(fact: DataFrame, metrics_by_key: DataFrame, keys: Sequence[str],
                      metrics: Sequence[str]) -> DataFrame:
    """Every fact row gets its key's metrics divided by the
    number of fact rows of that key, so metric sums are conserved; a key
    with metrics but no fact row gives one row with the metrics whole (the
    key spine of the reference = fact keys union metric keys).

    Per-key work happens on one row per key with metrics: it gets the fact's
    row count (a partial aggregate), and the fact rows are joined once with
    that table, however many keys the fact has besides (a hot key is split by
    AQE's skew handling)."""
    keys = list(keys)
    cnt = fact.groupBy(*keys).agg(F.count("*").alias("_n"))
    info = metrics_by_key.join(cnt, keys, "left")
    rows = fact.join(info.filter(F.col("_n").isNotNull()), keys, "left")
    rows = rows.withColumns({m: F.col(m) / F.col("_n") for m in metrics}).drop("_n")
    extra = info.filter(F.col("_n").isNull()).drop("_n")
    return rows.unionByName(extra, allowMissingColumns=True)


# ------------------------------------------------------------------ C2 / C7
def classification_clean(feed: DataFrame, item: str = "item", upc: str = "upc",
                         order: Sequence[str] = ("file_no", "row_no")) -> DataFrame:
    """C2 part 1: keep 12-char codes (W4), then the first row per item (A4)."""
    f = feed.filter(F.length(F.col(upc).cast("string")) == 12)
    return first_per_key(f, [item], list(order))


def fg_status_clean(feed: DataFrame, upc: str = "upc", order: Sequence[str] = ("file_no", "row_no"),
                    ) -> DataFrame:
    """C2 part 2: Basic-Dash = basic || '-' || dash (null-propagating, F7),
    then the first row per UPC (A4)."""
    f = feed.withColumn("basic_dash", S.concat_code("basic", "dash"))
    return first_per_key(f, [upc], list(order))


def merged_classification(classification: DataFrame, fg: DataFrame, item: str = "item",
                          upc: str = "upc", order: Sequence[str] = ("file_no", "row_no"),
                          fg_cols: Sequence[str] = ("mpg", "ipg", "bu", "basic_dash")) -> DataFrame:
    """Classification left join FG on the 11-char prefix of the 12-char
    code = full FG UPC (one side cut), then one row per item (first by the
    FG UPC, so fan-out is resolved deterministically)."""
    fgk = fg.select(F.col(upc).alias("fg_upc"), *fg_cols)
    c = classification.withColumn("_pk", S.prefix(F.col(upc), 11))
    j = c.join(fgk, c["_pk"] == fgk["fg_upc"], "left").drop("_pk")
    return first_per_key(j, [item], [*order, "fg_upc"])


def fg_grouped(fg: DataFrame, upc: str = "upc", order: Sequence[str] = ("file_no", "row_no"),
               cols: Sequence[str] = ("mpg", "ipg", "bu", "basic", "dash")) -> DataFrame:
    """Text-normalise (F4), first non-null per UPC (A5), MPG_IPG with the
    'Unknown' default (F8) and Basic_Dash."""
    t = fg.select(S.strip_point_zero(upc).alias(upc), *[S.strip_point_zero(c).alias(c) for c in cols],
                  *order)
    g = first_nonnull_per_key(t, [upc], list(order), list(cols))
    return g.withColumns({
        "mpg_ipg": S.concat_code_default("mpg", "ipg"),
        "basic_dash": F.concat(F.col("basic"), F.lit("-"), F.col("dash")),
    })
