"""Two-pass external shuffle into shards, with DataFrame functions only.

Pass one scatters every row into one of B memory-sized buckets by a seeded
hash of the whole row. Pass two shuffles each bucket with Fisher-Yates
(Spark's ``shuffle`` of the bucket's index array; Spark documents it as that
algorithm) and lays the buckets end to end, so a row's place is its bucket's
offset plus its drawn index. Shards are equal runs of places: their row
counts differ by at most one (law ``rows``) and slots have no gaps.

* The permutations are drawn over ``spark.range`` with a fixed number of
  buckets per partition, so the seeded generator depends on the bucket number
  alone: reruns, retried tasks and other cluster sizes give the same shards.
* Only index arrays are held in memory; texts pass through one spillable
  exchange and sort.
* A bucket that outgrows four times the mean (many rows equal in every
  column share one hash) is split by row number, so no task gets it whole.
  The rows of one text that repeats under different ids are spread anyway.

Defined results: a null in any column takes part in the hash; ties are rows
equal in all hashable columns, which are interchangeable; an empty table
gives no rows; input columns named like the outputs are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import hashable, quoted

#: UTF-8 bytes per bucket, and the most buckets (beyond it buckets grow):
#: the bucket table has a proven bound of MAX_BUCKETS rows of 24 bytes.
BUCKET_BYTES = 16 << 20
MAX_BUCKETS = 1_000_000
#: Buckets whose permutations are drawn in one task.
BUCKETS_PER_TASK = 64


def _buckets(docs: DataFrame, n: int, seed: int) -> DataFrame:
    cols = [quoted(c) for c in hashable(docs)]
    return docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("rec"),
                       F.xxhash64(F.lit(seed), *cols).alias("h"),
                       F.xxhash64(F.lit(seed + 1), *cols).alias("h2")
                       ).withColumn("bucket", F.pmod("h", F.lit(n)))


def shuffle_into_shards(docs: DataFrame, shards: int = 8, seed: int = 17, text: str = "text",
                        bucket_bytes: int = BUCKET_BYTES, shard_col: str = "shard",
                        slot_col: str = "slot") -> DataFrame:
    """All rows and columns of ``docs`` plus their shard (0 to shards-1) and
    their slot in it (0, 1, 2, ... in shuffled order)."""
    spark = docs.sparkSession
    docs = docs.drop(shard_col, slot_col)
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    total = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("b")).first()
    rows = total["n"]
    n = min(MAX_BUCKETS, max(1, -(-int(total["b"] or 0) // bucket_bytes)))

    scattered = _buckets(docs, n, seed)
    counts = scattered.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    limit = 4 * (rows // n) + 1000
    large = counts.where(F.col("n") > limit).select(
        "bucket", F.ceil(F.col("n") / F.lit(limit)).alias("parts"))
    if not large.isEmpty():          # at most n / 4 rows by the limit's definition
        scattered = (scattered.join(F.broadcast(large), "bucket", "left")
                     .withColumn("bucket", F.when(F.col("parts").isNotNull(), F.col("bucket") + F.lit(n) * F.pmod(
                         F.monotonically_increasing_id(), F.col("parts"))).otherwise(F.col("bucket")))
                     .drop("parts"))
        counts = scattered.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))

    # One row per bucket: at most MAX_BUCKETS (5/4 of it after splitting).
    order = Window.orderBy("bucket")
    layout = counts.select("bucket", "n", (F.row_number().over(order) - 1).cast("long").alias("id"),
                           (F.sum("n").over(order) - F.col("n")).alias("offset"))
    most = n + (n // 4 + 1) * 4
    perms = (spark.range(0, most, 1, max(1, -(-most // BUCKETS_PER_TASK)))
             .join(F.broadcast(layout), "id")
             .select("bucket", "offset", F.shuffle(F.sequence(F.lit(0), F.col("n").cast("int") - 1),
                                                   F.lit(seed)).alias("perm")))

    in_bucket = Window.partitionBy("bucket").orderBy("h", "h2")
    place = F.col("offset") + F.element_at("perm", F.col("rn"))
    shard = F.floor(F.col("place") * shards / F.lit(rows)) if rows else F.lit(0)
    placed = (scattered.withColumn("rn", F.row_number().over(in_bucket))
              .join(perms, "bucket")
              .select("rec", place.alias("place")))
    # integer arithmetic: floor(place * shards / rows) without rounding of doubles
    shard = F.expr(f"place * {shards}L div {max(rows, 1)}L").cast("int")
    first = F.expr(f"(_s * {max(rows, 1)}L + {shards - 1}L) div {shards}L")
    return (placed.withColumn("_s", shard)
            .select("rec.*", F.col("_s").alias(shard_col), (F.col("place") - first).alias(slot_col)))


def write_shards(shuffled: DataFrame, path: str, shard_col: str = "shard", slot_col: str = "slot",
                 tasks_per_shard: int = 16) -> None:
    """Write one folder per shard; files hold consecutive slots in order."""
    n = shuffled.select(F.max(shard_col)).first()[0]
    (shuffled.repartitionByRange(((n or 0) + 1) * tasks_per_shard, shard_col, slot_col)
     .sortWithinPartitions(shard_col, slot_col)
     .write.partitionBy(shard_col).parquet(path))
