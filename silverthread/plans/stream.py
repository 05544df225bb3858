"""The event feed as a stream into the lake that the gold run reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas, session
from ..functions import privacy
from ..operators import events as E
from ..operators.aggregates import total
from ..sinks import write_table, write_together
from ..sinks.generations import FAN, Generation, Manifests, delete, exists, to_merge
from ..sources import read_table
from ..streaming.ids import IdIndex
from ..streaming.ingest import add_ids, events_stream, fresh_events, write_generation
from .jobs import EVENT_GENERATIONS, Layout
from .runlog import Run, logged_run


def generations_of(spark: SparkSession, layout: Layout, live: list[Generation]) -> DataFrame:
    """The normalized events of some generations."""
    stored = read_table(spark, layout.silver("events"), EVENT_GENERATIONS)
    return stored.where(F.col("generation").isin([g.name for g in live]))


def stream_events(
    spark: SparkSession,
    layout: Layout,
    files_per_batch: int | None = None,
    keep_empty: bool = False,
    mask_members: bool = False,
    fan: int = FAN,
) -> Run:
    """Take in the events that have landed since the last call, each event id once.

    Batches go where :func:`silverthread.plans.jobs.run_events` writes and the gold run
    reads, as generations of few files; bad rows (once each in a batch) and rejected
    events go to quarantine. A batch becomes visible as a whole when its manifest is
    written, after its rows, its quarantine and its ids; one that failed before that
    runs again and replaces what it had written. ``fan`` generations of one order of
    size are merged into one, and the directories of replaced ones are removed a batch
    later, so readers that began before still find them.

    Adds one entry to the run log: valid rows as processed, bad rows as failed. Fails
    where ``run_events`` has written the events of the lake.
    """
    log = layout.generations("events")
    with logged_run(session.tune_lake(spark), "event_stream", layout.run_log) as run:
        manifests = Manifests(spark, log)
        if manifests.newest() is None and exists(spark, layout.silver("events")):
            if not exists(spark, f"{layout.base}/metadata/event_stream"):
                raise ValueError("the events of this lake come from run_events")
        names = ["batches", "rejected"] + [d.category + bad for d in E.DOMAINS for bad in ("", "_BAD")]
        run.counts = dict.fromkeys(names, 0)

        def remove(name: str) -> None:
            delete(spark, f"{layout.silver('events')}/outcome=*/domain=*/generation={name}")

        def quarantine(name: str, rows: DataFrame, table: str) -> None:
            write_table(rows, f"{layout.quarantine(table)}/generation={name}")

        def write(batch: DataFrame, number: int) -> None:
            index = IdIndex(spark, f"{layout.base}/metadata/event_ids")
            manifests.forget(number, remove)
            live = manifests.before(number) or []
            name = f"{number}"
            with session.scratch_folder(spark) as scratch:
                fresh = fresh_events(batch, index, number, scratch)
                wide = E.normalize_all(fresh, keep_empty=keep_empty)
                if mask_members:
                    wide = privacy.masked(wide, ["first_name", "last_name", "email", "city", "raw_event"])
                verdicts = {
                    d.category + bad: F.count_if((F.col("domain") == d.category) & (F.col("outcome") == outcome))
                    for d in E.DOMAINS
                    for bad, outcome in (("", E.VALID), ("_BAD", E.BAD))
                }
                found = write_generation(
                    wide, layout.silver("events"), "generation", name,
                    rejected=F.count_if(F.col("outcome") == E.REJECTED), **verdicts,
                )
                if rows := sum(found.values()):
                    made = Generation(name, rows)
                    own = generations_of(spark, layout, [made])
                    write_together(
                        *[
                            lambda d=d: quarantine(name, E.bad_rows(own, d), f"{d.category.lower()}_events")
                            for d in E.DOMAINS
                            if found[d.category + "_BAD"]
                        ],
                        lambda: quarantine(name, E.rejected_events(own), "rejected_events"),
                    )
                    live = _merged(spark, layout, [*live, made], name, fan)
                add_ids(fresh, index, number)
            manifests.commit(number, live)
            for key, count in found.items():
                run.counts[key] += count
            run.counts["batches"] += 1

        feed = events_stream(spark, layout.raw("events"), files_per_batch=files_per_batch)
        (
            feed.writeStream.foreachBatch(write)
            .option("checkpointLocation", f"{layout.base}/metadata/event_stream")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
        run.processed = total(run.counts, *[d.category for d in E.DOMAINS])
        run.failed = total(run.counts, *[f"{d.category}_BAD" for d in E.DOMAINS])
    return run


def _merged(
    spark: SparkSession, layout: Layout, live: list[Generation], name: str, fan: int
) -> list[Generation]:
    """The live generations after merging those of one order of size."""
    merged = 0
    while found := to_merge(live, fan):
        made = Generation(f"{name}-{merged}", sum(g.rows for g in found))
        together = generations_of(spark, layout, found).drop("generation")
        write_generation(together, layout.silver("events"), "generation", made.name)
        live, merged = [*[g for g in live if g not in found], made], merged + 1
    return live
