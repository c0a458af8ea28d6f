"""Week-over-week inventory snapshot comparison.

Every label is decided on per-key aggregates (one row per key and side)
and then applied to the snapshot rows with an equi-join on the labelled
keys, so no (low row x high row) pairs are ever formed: a key with h rows on
each side costs O(h), not O(h^2).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The change labels of the reference, in its report order.
NEW_COMBO = "New OMSID/DC Combo"
REPLEN_CHANGE = "Replenishment Change OMSID/DC"
ZERO_INVENTORY = "All DCs Off Inventory Now at 0"
MISSING_ID = "OMSID Present LW Not Present TW"
CHANGE_LABELS = [NEW_COMBO, REPLEN_CHANGE, ZERO_INVENTORY, MISSING_ID]
INVENTORY_COLUMNS = ["Avail OH Qty", "OH Qty", "CurrATSOHQty", "OO Qty", "Eff Inv"]


def normalise_snapshot(df: DataFrame, id_col: str = "omsid", dc_col: str = "dc",
                       dc_len: int = 4) -> DataFrame:
    """W9 + F6: id coerced to bigint (bad -> 0) and zero ids dropped; DC cut to
    its first 4 chars with null as text 'nan' (so null DCs match each other)."""
    x = df.withColumn(id_col, F.coalesce(F.col(id_col).cast("string").try_cast("bigint"), F.lit(0)))
    x = x.filter(F.col(id_col) != 0)
    return x.withColumn(dc_col, F.coalesce(F.substring(F.col(dc_col).cast("string"), 1, dc_len),
                                           F.lit("nan")))


def labelled_keys(low: DataFrame, high: DataFrame, id_col: str = "omsid", dc_col: str = "dc",
                  flags: Sequence[str] = ("ntwk_replen", "dc_replen"),
                  inventory: Sequence[str] = ("oh_qty", "oo_qty")) -> DataFrame:
    """One row per (id, DC) key of two normalised snapshots: its rows on each
    side (``l_rows``, ``h_rows``; null: none), the label of its low rows
    (``low_label``) and the list of labels of its high rows (``high_labels``).

    Each snapshot is aggregated once to one row per key; all decisions
    are made on those key rows (a full outer join of the two key tables plus
    id-level facts over it). A pair (low row, high row) with an ON -> OFF change
    exists exactly when some low row of the key is ON and some high row is OFF,
    so no row pairs are formed."""
    keys = [id_col, dc_col]
    inv = [c for c in inventory if c in low.columns and c in high.columns]

    def key_stats(df, p, state):
        all_off = None
        for f in flags:
            e = F.coalesce(F.col(f) == "OFF", F.lit(False))
            all_off = e if all_off is None else all_off & e
        inv_sum = sum((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in inv), F.lit(0.0))
        return df.groupBy(*keys).agg(
            F.count("*").alias(f"{p}_rows"),
            *[F.coalesce(F.max(F.col(f) == state), F.lit(False)).alias(f"{p}_{f}") for f in flags],
            F.bool_and(all_off).alias(f"{p}_off"), F.sum(inv_sum).alias(f"{p}_inv"))

    kk = key_stats(low, "l", "ON").join(key_stats(high, "h", "OFF"), keys, "full_outer")
    in_l, in_h = F.col("l_rows").isNotNull(), F.col("h_rows").isNotNull()
    # id-level facts beside each key row: a window over the key table, whose
    # partitions hold one row per DC of an id (a handful), however many
    # snapshot rows the id has; the key table is used once, not recomputed
    by_id = Window.partitionBy(id_col)
    kk = kk.withColumns({
        "_id_l": F.max(in_l).over(by_id), "_id_h": F.max(in_h).over(by_id),
        "_id_l_off": F.bool_and("l_off").over(by_id), "_id_h_off": F.bool_and("h_off").over(by_id),
        "_id_l_inv": F.sum("l_inv").over(by_id), "_id_h_inv": F.sum("h_inv").over(by_id)})
    missing = F.col("_id_l") & ~F.col("_id_h")
    zero = (F.col("_id_l") & F.col("_id_h") & F.col("_id_l_off") & F.col("_id_h_off") &
            (F.col("_id_l_inv") > 0) & (F.col("_id_h_inv") == 0))
    if not inv:
        zero = F.lit(False)
    changed = None
    for f in flags:
        e = F.col(f"l_{f}") & F.col(f"h_{f}")
        changed = e if changed is None else changed | e
    return kk.select(
        *keys, "l_rows", "h_rows",
        F.when(in_l & missing, F.lit(MISSING_ID)).alias("low_label"),
        F.filter(F.array(F.when(in_h & ~in_l, F.lit(NEW_COMBO)),
                         F.when(in_h & in_l & F.coalesce(changed, F.lit(False)), F.lit(REPLEN_CHANGE)),
                         F.when(in_h & F.coalesce(zero, F.lit(False)), F.lit(ZERO_INVENTORY))),
                 lambda x: x.isNotNull()).alias("high_labels"))


def snapshot_diff(low: DataFrame, high: DataFrame, id_col: str = "omsid", dc_col: str = "dc",
                  flags: Sequence[str] = ("ntwk_replen", "dc_replen"),
                  inventory: Sequence[str] = ("oh_qty", "oo_qty"),
                  label_col: str = "change_type") -> DataFrame:
    """The four change labels. Rows of an id missing from high come from
    low; the other labels emit the high rows of the flagged key / id once
    per label (one row may carry several labels).

    The rows of both snapshots meet the labelled key table in one join, so the
    key table is computed once and building the frame runs no job."""
    low, high = normalise_snapshot(low, id_col, dc_col), normalise_snapshot(high, id_col, dc_col)
    cols, keys = low.columns, [id_col, dc_col]
    labels = labelled_keys(low, high, id_col, dc_col, flags, inventory).select(
        *keys, F.array_compact(F.array("low_label")).alias("_low"), F.col("high_labels").alias("_high"))
    labels = labels.filter((F.size("_low") > 0) | (F.size("_high") > 0))
    rows = low.withColumn("_is_low", F.lit(True)).unionByName(high.select(*cols).withColumn("_is_low", F.lit(False)))
    return rows.join(labels, keys, "inner").select(
        *cols, F.explode(F.when(F.col("_is_low"), F.col("_low")).otherwise(F.col("_high"))).alias(label_col))


def _every_label(counts: DataFrame, label_col: str) -> DataFrame:
    """Counts (label, n) with every expected label present (zero-filled). The
    label list is a fixed four-row frame, so the join is a broadcast."""
    labels = counts.sparkSession.createDataFrame(list(enumerate(CHANGE_LABELS)), "label_order int, change_type string")
    return (F.broadcast(labels).join(counts, labels.change_type == counts[label_col], "left")
            .select(labels.label_order, labels.change_type, F.coalesce(F.col("n"), F.lit(0)).alias("count"))
            .orderBy("label_order"))


def change_counts(changes: DataFrame, label_col: str = "change_type") -> DataFrame:
    """Rows per label of a comparison, zero-filled."""
    return _every_label(changes.groupBy(label_col).agg(F.count("*").alias("n")), label_col)


def count_changes(low: DataFrame, high: DataFrame, id_col: str = "omsid", dc_col: str = "dc", **options) -> DataFrame:
    """A18 straight from two snapshots: the labelled rows are counted by the
    key table's row counts and never built. Equal to ``change_counts`` of ``snapshot_diff``."""
    k = labelled_keys(normalise_snapshot(low, id_col, dc_col), normalise_snapshot(high, id_col, dc_col),
                      id_col, dc_col, **options)
    each = k.select(F.explode(F.concat(
        F.array(F.struct(F.col("low_label").alias("label"), F.col("l_rows").alias("n"))),
        F.transform("high_labels", lambda x: F.struct(x.alias("label"), F.col("h_rows").alias("n"))))).alias("e"))
    counts = each.where(F.col("e.label").isNotNull()).groupBy(F.col("e.label").alias("_label")).agg(F.sum("e.n").alias("n"))
    return _every_label(counts, "_label")


def zero_inventory(low: DataFrame, high: DataFrame, id_col: str = "omsid", dc_col: str = "dc", **options) -> DataFrame:
    """Ids labelled ZERO_INVENTORY, from the key table alone."""
    k = labelled_keys(normalise_snapshot(low, id_col, dc_col), normalise_snapshot(high, id_col, dc_col),
                      id_col, dc_col, **options)
    return k.filter(F.array_contains("high_labels", ZERO_INVENTORY)).select(id_col).distinct().orderBy(id_col)


def zero_inventory_ids(changes: DataFrame, id_col: str = "omsid", label_col: str = "change_type") -> DataFrame:
    return (changes.filter(F.col(label_col) == ZERO_INVENTORY).select(id_col).distinct()
            .orderBy(id_col))
