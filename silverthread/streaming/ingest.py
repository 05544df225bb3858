"""Events from a landing folder as a stream.

The same operators as in batch: parsing, routing, flattening and quality rules
keep no state, so one append-mode query writes every domain and outcome.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas, session
from ..operators.events import normalize_all
from ..operators.latest import latest_per_key
from ..sinks import rebalance_for_write, stage, write_counted, write_partitioned
from ..sinks.generations import exists
from .ids import IdIndex, by_rows


def events_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = schemas.EVENT,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Stream of events from JSON files as they land."""
    reader = (
        spark.readStream.schema(schemas.with_malformed(schema))
        .option("columnNameOfCorruptRecord", schemas.MALFORMED)
    )
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def ingest_events(
    events: DataFrame,
    out: str,
    checkpoint: str,
    keep_empty: bool = False,
) -> StreamingQuery:
    """Normalize what has landed and stop.

    The Parquet file sink commits each batch once, so a restart from
    ``checkpoint`` neither loses nor repeats rows. Read the result with
    ``spark.read.parquet(out)``.
    """
    return (
        normalize_all(events, keep_empty=keep_empty)
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("outcome", "domain")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def fresh_events(batch: DataFrame, index: IdIndex, number: int, scratch: str) -> DataFrame:
    """Events of a batch whose ids no earlier batch has delivered, each id once: the
    newest delivery of the batch, ties settled by the other fields. Events without an
    id cannot be compared and all stay. Written below ``scratch`` and read back."""
    known = F.col("event_id").isNotNull()
    # A micro-batch reads and parses its files anew for every use.
    read, _ = stage(batch, f"{scratch}/read")
    many = read.where(known).count()
    ids = read.where(known).select(F.col("event_id").alias("id")).distinct()
    seen, left = index.seen(ids, number, scratch, many), read.where(known)
    if index.ids_read:
        # Ids meet ids first, so that rows seen before need not be shuffled if few are new.
        new, _ = stage(ids.join(by_rows(seen, many), "id", "left_anti"), f"{scratch}/new")
        new = by_rows(new.withColumnRenamed("id", "event_id"), new.count())
        left = left.join(new, "event_id", "left_semi").select(*batch.columns)
    newest = latest_per_key(left, ["event_id"], ["event_timestamp"])
    return stage(newest.unionByName(read.where(~known)), f"{scratch}/fresh")[0]


def add_ids(fresh: DataFrame, index: IdIndex, number: int) -> None:
    """Add the ids of a batch to the index and commit it there."""
    ids = fresh.where(F.col("event_id").isNotNull()).select(F.col("event_id").alias("id"))
    index.add(ids, number)


def write_generation(wide: DataFrame, out: str, column: str, name: str | int, **counts: Column) -> dict[str, int]:
    """Store normalized events by outcome, domain and a generation of their own, in few
    files. A generation that is written again is replaced."""
    keys = ["outcome", "domain", column]
    rows = rebalance_for_write(wide.withColumn(column, F.lit(name)), *keys)
    if not counts:
        write_partitioned(rows, out, keys)
        return {}
    return write_counted(rows, lambda df: write_partitioned(df, out, keys), **counts)


def ingest_once(
    events: DataFrame,
    out: str,
    checkpoint: str,
    keep_empty: bool = False,
    ids: str | None = None,
) -> StreamingQuery:
    """Normalize what has landed, drop redelivered events, and stop.

    Of each ``event_id`` one event stays, however late the first or any later
    delivery comes and whatever time it carries: within a batch the newest (see
    :func:`fresh_events`), across batches the first that was stored. The ids of earlier
    batches are kept in ``ids`` (by default ``out`` with ``_ids`` added), where a batch
    reads only the buckets that may hold one of its own; see :mod:`.ids`. A table that
    was stored without them has its ids added once.
    Each batch is rebalanced, so it writes few files, into directories of its own; a
    batch that is run again replaces them. Columns are those of :func:`ingest_events`
    and ``batch``.
    """
    ids = ids or f"{out.rstrip('/')}_ids"

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        index = IdIndex(spark, ids)
        if index.manifests.before(number) is None and number and exists(spark, out):
            stored = spark.read.parquet(out).where(F.col("batch") < number)
            add_ids(stored.select("event_id").distinct(), index, number - 1)
        with session.scratch_folder(spark) as scratch:
            fresh = fresh_events(batch, index, number, scratch)
            write_generation(normalize_all(fresh, keep_empty=keep_empty), out, "batch", number)
            add_ids(fresh, index, number)

    return (
        events.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
