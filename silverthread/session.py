"""Session settings the plans rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Runtime settings under which the plans were designed. AQE sizes and splits
#: partitions; forcing the skew-join rule lets it split a hot key even where the
#: split costs one more shuffle above the join; the next setting is what makes
#: joins on more keys than an input is partitioned by shuffle that input anew. The last
#: bounds what a task hands to Python at a time, which both sides hold several times.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}

#: Shuffled bytes that one reduce task should get, before AQE merges small ones.
BYTES_PER_PARTITION = 128 << 20

_own_scratch: str | None = None


def tune(spark: SparkSession, shuffle_bytes: int | None = None) -> SparkSession:
    """Apply :data:`RUNTIME_SETTINGS` to the session and return it.

    AQE can merge shuffle partitions but not add any, so for a large input say
    how many bytes its widest shuffle moves; shuffles then start from enough
    partitions (never fewer than the session has).
    """
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    if shuffle_bytes is not None:
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        wanted = max(least, -(-shuffle_bytes // BYTES_PER_PARTITION))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))
    return spark


def tune_lake(spark: SparkSession, shuffle_bytes: int | None = None) -> SparkSession:
    """:func:`tune`, with Parquet written by zstd: tables of a lake and those staged for
    them take about half the bytes that they do with snappy."""
    spark.conf.set("spark.sql.parquet.compression.codec", "zstd")
    return tune(spark, shuffle_bytes)


def shared_scratch(spark: SparkSession) -> str:
    """Folder all executors can reach: the session's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its
    own; on a cluster a machine-local folder would lose data with its machine.
    """
    global _own_scratch
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if _own_scratch is None:
        _own_scratch = tempfile.mkdtemp(prefix="silverthread-")
    return _own_scratch


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path for ``name`` in the shared scratch folder."""
    return f"{shared_scratch(spark)}/silverthread/{uuid.uuid4().hex}/{name}"


@contextmanager
def scratch_folder(spark: SparkSession) -> Iterator[str]:
    """A fresh folder in the shared scratch folder, removed with what a block
    staged in it when the block ends or fails."""
    folder = scratch_path(spark, "staged")
    try:
        yield folder
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
