"""Session construction and the shared folder used for lineage cuts."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. AQE turns sort-merge joins into broadcast joins
# only when the runtime size of a side is below the threshold (the size check
# behind every broadcast of data-derived tables), coalesces small shuffle
# partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a rebalanced write splits a hot partition value over several tasks
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # executors may be lost at any time: a decommissioning executor hands its
    # shuffle and cached blocks to the others instead of forcing recomputation
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
    "spark.storage.decommission.rddBlocks.enabled": "true",
}

# target bytes per shuffle partition and per scan split
PARTITION_BYTES = 128 * 1024 * 1024


def scale_conf(input_bytes: int, cores: int, most_partitions: int = 100_000) -> dict[str, str]:
    """Shuffle sizing for a job reading ``input_bytes`` on ``cores`` task slots.

    AQE can merge small shuffle partitions but cannot split a large one (only
    skewed join sides and rebalances), so the initial partition count is sized
    from the input: about one partition per 128 MB, never fewer than two per
    core. Map-status metadata on the driver grows with maps x reducers, so the
    count stops at ``most_partitions``: with the default, 100 TB give ~1 GB of
    input per partition before projection and partial aggregation, which sorts and
    aggregates spill; raise it with the driver's memory. It drops nothing. AQE coalesces the partitions towards 128 MB each at run time.
    """
    n = min(most_partitions, max(2 * cores, -(-input_bytes // PARTITION_BYTES)))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
        "spark.sql.files.maxPartitionBytes": str(PARTITION_BYTES),
    }


def get_session(master: str | None = None, app: str = "marketbars",
                shuffle_partitions: int | None = None,
                extra: dict | None = None, input_bytes: int | None = None,
                cores: int | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if input_bytes:
        conf.update(scale_conf(input_bytes, cores or os.cpu_count() or 1))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    The setting is read from the session. Only when it is unset in local mode
    (tests) is a folder of our own created and registered: on a cluster the
    executors would not see it, so there it must be set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="marketbars-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for staged writes and stream state."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def written_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read from there by all that use it, instead
    of being computed by each of them (and again for every executor lost)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on any Hadoop file system (staging that has been published)."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
