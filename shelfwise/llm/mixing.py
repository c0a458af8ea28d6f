"""Mixing sources to target weights.

The tokens of each source are added up, targets are set from weights, and a
source's repetition rate is target / size. Every document is emitted
floor(rate) times plus one more copy drawn by a seeded hash with probability
equal to the fraction of the rate.

Targets: sources by code point (null last) weigh 3, 1, 2, repeating, and share
``share`` of all sizes; a target stops at ``cap`` times its source's size and
the excess goes to the others by weight until none is above. The result of
that procedure is min(cap * size, level * weight) for the one level that
spends the whole share, found from running sums over one row per source.

Defined results: null text has size 0; a null source is one source, last in
order; documents without words count 0 words and get copies like others;
repeated rows draw alike (their hash takes doc_id and text); an empty table
gives no rows; a source without words has target 0 and rate 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import quoted, staged, words

#: Fixed values of the mix: weights by source order, share of all sizes, cap.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
SEED = "mix-1"
#: Broadcast the per-source table only up to this many rows, else a shuffle join.
BROADCAST_SOURCES = 100_000


def token_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """(source, source_size, target, rate) from (source, source_size); one row per source."""
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("k") % len(weights) + 1).cast("int"))
    s = (sizes.withColumn("k", F.row_number().over(order) - 1).withColumn("w", w.cast("double"))
         .withColumn("most", F.lit(cap) * F.col("source_size").cast("double")))
    # Sources that fill up first come first; `level` if all before this one are full.
    fill = Window.orderBy(F.col("most") / F.col("w"), "k")
    every = Window.partitionBy()
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    s = (s.withColumn("place", F.row_number().over(fill))
         .withColumn("full", F.coalesce(F.sum("most").over(before), F.lit(0.0)))
         .withColumn("open", F.sum("w").over(after))
         .withColumn("budget", F.lit(share) * F.sum("source_size").over(every))
         .withColumn("lev", (F.col("budget") - F.col("full")) / F.col("open")))
    first_open = F.min(F.when(F.col("lev") * F.col("w") < F.col("most"), F.struct("place", "lev"))).over(every)
    s = s.withColumn("level", first_open["lev"])
    target = F.when(F.col("level").isNull(), F.col("most")).otherwise(F.least(F.col("most"), F.col("level") * F.col("w")))
    return s.select("source", "source_size", target.alias("target"),
                    F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("rate"))


def draw(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """Uniform number in [0, 1) from a seeded hash of the document."""
    key = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")),
                            F.md5(F.coalesce(text, F.lit("")))))
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("double") / F.lit(float(2 ** 32))


def with_copies(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """(rec: the input row, size, source_size, target, copies)."""
    base = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("rec"), F.col("source").alias("_src"),
                       token_count(F.col("text")).alias("size"))
    sizes = staged(base.groupBy("_src").agg(F.sum("size").alias("source_size"))
                        .select(F.col("_src").alias("source"), "source_size"))
    targets = source_targets(sizes, weights, share, cap)
    if sizes.count() <= BROADCAST_SOURCES:
        targets = F.broadcast(targets)
    whole = F.floor("rate")
    extra = (draw(F.col("rec.doc_id"), F.col("rec.text"), seed) < F.col("rate") - whole).cast("long")
    return (base.join(targets, F.col("_src").eqNullSafe(F.col("source")))
            .select("rec", "size", "source_size", "target", (whole + extra).alias("copies")))


def mix(docs: DataFrame, **params) -> DataFrame:
    """The mixed corpus: every document as often as drawn, with the input's columns."""
    return (with_copies(docs, **params).where("copies > 0")
            .select("rec", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy"))
            .select("rec.*"))
