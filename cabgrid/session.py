"""Scratch locations for written intermediate tables and stream checkpoints.

Everything goes under the shared checkpoint folder the cluster names in
``spark.checkpoint.dir``; a machine-local folder would vanish with the
executor that wrote it. Only when nothing is configured (local tests) is a
folder of our own created and registered as the checkpoint folder.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The context's checkpoint folder, registering it first when needed.

    ``DataFrame.checkpoint`` needs the SparkContext's folder set: a folder
    given only as a session setting is registered from that setting. Without
    any, a local session gets a temporary folder and a cluster an error.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            root = tempfile.mkdtemp(prefix="cabgrid-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Within it, folders are listed by four tasks a core at most; Spark takes one per folder, up to 10,000.

    A stream takes the setting over as it starts.
    """
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(4 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def cluster_conf(input_bytes: int, total_cores: int, large_state: bool = False) -> dict[str, str]:
    """Session settings sized for a scan of ``input_bytes`` on ``total_cores`` task slots.

    * Scan splits of up to 512 MiB: 100 TB becomes ~200k scan tasks.
    * Initial shuffle partitions: at least 2 per core, and enough that the
      partially aggregated output (assumed at most 1/20 of the input) lands
      in ~256 MiB partitions; AQE coalesces the small ones and splits skewed
      join partitions.
    * Runtime broadcast only below 64 MiB of measured size.
    * ``large_state``: RocksDB state store for streams with many open windows.
    """
    mib = 1 << 20
    split = 512 * mib
    shuffle = max(2 * total_cores, -(-input_bytes // 20 // (256 * mib)))
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * mib),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * mib),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
    }
    if large_state:
        conf["spark.sql.streaming.stateStore.providerClass"] = (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        )
    return conf
