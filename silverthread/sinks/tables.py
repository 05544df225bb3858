"""Parquet sinks. Each call here runs a Spark job at once."""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F


def write_table(df: DataFrame, path: str) -> None:
    """Replace an unpartitioned table."""
    df.write.mode("overwrite").parquet(path)


_appending = threading.Lock()


def append_rows(df: DataFrame, path: str) -> None:
    """Add rows to a table. Of the threads of one driver, one appends at a time: a commit
    removes what another has not committed in that folder."""
    with _appending:
        df.write.mode("append").parquet(path)


def write_partitioned(
    df: DataFrame, path: str, keys: Sequence[str], replace: str = "touched"
) -> None:
    """Replace partitions of a table laid out by ``keys``.

    ``touched`` replaces only the partitions that ``df`` has rows for, so earlier
    dates survive; ``all`` replaces the whole table.
    """
    mode = {"touched": "dynamic", "all": "static"}[replace]
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy(*keys)
        .parquet(path)
    )


def write_snapshot(
    df: DataFrame,
    path: str,
    run_date: dt.date,
    keys: Sequence[str] = (),
    idempotent: bool = True,
) -> None:
    """Store ``df`` as the snapshot of ``run_date``.

    A repeated run replaces exactly its own date, including partitions that the
    new run no longer has. ``idempotent=False`` appends, so a repeated run
    doubles the snapshot.
    """
    if idempotent:
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        target = f"{path}/run_date={run_date:%Y-%m-%d}"
        (writer.partitionBy(*keys) if keys else writer).parquet(target)
    else:
        dated = df.withColumn("run_date", F.lit(run_date))
        dated.write.mode("append").partitionBy("run_date", *keys).parquet(path)


def rebalance_for_write(df: DataFrame, *keys: str, partitions: int | None = None) -> DataFrame:
    """Bring rows of one output directory together before a partitioned write.

    A rebalance, not a repartition: AQE merges small partitions and splits a
    large one, so a hot key is written by many tasks as files of normal size.
    ``partitions`` sets the number to start from.
    """
    if partitions is None:
        return df.hint("rebalance", *keys)
    return df.hint("rebalance", partitions, *keys)


def cluster_for_write(df: DataFrame, by: str, keys: Sequence[str] = (), files: int | None = None) -> DataFrame:
    """Bring rows into ranges of ``by`` before a write, within each output directory of
    ``keys``: footers then tell which files, and pages, can hold a value, so looking up
    one reads a few of many. Ranges are made from a sample, so a hot directory is written
    by many tasks and a small one by few; ``files`` sets their number for the table."""
    order = [*[F.col(k) for k in keys], F.col(by)]
    ranged = df.repartitionByRange(*order) if files is None else df.repartitionByRange(files, *order)
    return ranged.sortWithinPartitions(*order)


def write_counted(
    df: DataFrame, write: Callable[[DataFrame], None], **counts: Column
) -> dict[str, int]:
    """Write ``df`` and return aggregates seen by the same pass.

    The aggregates sit on top of the plan, in the stage that writes, where each
    task is counted once even if executors are lost and work is repeated.
    """
    seen = Observation(f"write_{uuid.uuid4().hex}")
    named = [column.alias(name) for name, column in counts.items()]
    write(df.observe(seen, *named))
    found: Mapping[str, int] = seen.get
    return {name: int(found.get(name) or 0) for name in counts}


def write_together(*writes: Callable[[], object]) -> list:
    """Run independent writes at the same time, so that the last tasks of one do
    not leave the cluster idle. Returns what they return, or raises the first error,
    once all have ended."""
    in_thread = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max_workers=len(writes)) as pool:
        return [done.result() for done in [pool.submit(in_thread(write)) for write in writes]]


def stage(
    df: DataFrame, path: str, keys: Sequence[str] = (), **counts: Column
) -> tuple[DataFrame, dict[str, int]]:
    """Write ``df`` below the shared scratch folder and read it back.

    Cuts lineage with a table that outlives any executor, and computes ``df`` once
    for all its consumers. ``keys`` lay it out so that readers of one outcome skip
    the files of the others. Returns the table and the observed ``counts``. For
    ``path`` see :func:`silverthread.session.scratch_path` and ``scratch_folder``.
    """

    def write(rows: DataFrame) -> None:
        writer = rows.write.mode("overwrite")
        (writer.partitionBy(*keys) if keys else writer).parquet(path)

    seen = write_counted(df, write, **counts) if counts else write(df)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen or {}
