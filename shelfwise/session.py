"""Session helpers: a tuned local session for tests/bench, and the shared
checkpoint folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job wants regardless of cluster size. AQE re-plans joins
# (broadcast by measured size), coalesces small shuffles and splits skewed
# partitions at run time.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def cluster_settings(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Settings for a large cluster, sized from the bytes a job reads.

    Shuffle partitions are input / 256 MB (at least 2 per core) and AQE
    coalesces them at run time, so small stages do not pay for the size of
    big ones; scans read 512 MB splits (several Parquet row groups); a
    partition counts as skewed above 512 MB and 3x the median and is split.
    The broadcast threshold stays small: what is broadcast is decided from
    measured sizes, never assumed. Used by ``build_session`` when the input
    size is given."""
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(int(parts)),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(int(parts)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(512 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        **SCALE_CONF,
    }


def build_session(master: str = "local[8]", partitions: int = 8, app: str = "shelfwise",
                  extra: dict | None = None, input_bytes: int | None = None) -> SparkSession:
    """A tuned session; with ``input_bytes`` its sizes follow the input (``partitions`` is then ignored)."""
    if input_bytes is not None:
        cores = int(master.split("[")[1].rstrip("]")) if master.startswith("local[") and master[6:-1].isdigit() else 8
        sized = cluster_settings(input_bytes, cores)
        partitions = int(sized["spark.sql.shuffle.partitions"])
        extra = {**sized, **(extra or {})}
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(partitions))
         .config("spark.driver.memory", "16g"))
    for k, v in {**SCALE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder. On a cluster it must be configured
    (``spark.checkpoint.dir``); only a local master, whose tasks run in this
    process, gets a scratch folder when it is unset."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="shelfwise-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:   # a core setting may be read-only at run time; the context setting below counts
            pass
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def stage_table(df: DataFrame) -> DataFrame:
    """Write a frame once into the shared checkpoint folder and read it back:
    one computation however often it is used, and the lineage is cut."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable cut through the shared folder (survives executor loss, unlike
    localCheckpoint); the plan is computed once and nothing stays cached."""
    return stage_table(df)
