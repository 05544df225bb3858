"""Runners: read raw tables, build, write layered tables, log the run.

Every expensive intermediate that has several consumers is staged once as a
table (see :func:`silverthread.sinks.stage`); row counts are observed by the
writes themselves, and only the distinct valid history takes a job to count.
Runners apply :func:`silverthread.session.tune_lake` to the session.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from .. import constants as K, schemas, session
from ..functions import privacy
from ..operators import events as E, quality
from ..operators.aggregates import total
from ..operators.latest import latest_per_key
from ..sinks import (
    append_rows,
    cluster_for_write,
    rebalance_for_write,
    stage,
    write_counted,
    write_partitioned,
    write_snapshot,
    write_table,
    write_together,
)
from ..sinks.generations import Manifests
from ..sources import dated_partition, read_csv, read_events, read_table
from . import claims as C, gold as G, members as M
from .balance import Equation, balance_rows, check_balance
from .runlog import Run, logged_run


@dataclass(frozen=True)
class Layout:
    """Where the layers live below one base folder in shared storage."""

    base: str

    def raw(self, table: str) -> str:
        return f"{self.base}/bronze/{table}"

    def silver(self, table: str) -> str:
        return f"{self.base}/silver/{table}"

    def gold(self, table: str) -> str:
        return f"{self.base}/gold/{table}"

    def quarantine(self, table: str) -> str:
        return f"{self.base}/quarantine/{table}"

    def generations(self, table: str) -> str:
        """Manifests of a silver table that grows by generations."""
        return f"{self.base}/metadata/{table}_generations"

    @property
    def run_log(self) -> str:
        return f"{self.base}/metadata/run_log"

    @property
    def run_balance(self) -> str:
        return f"{self.base}/metadata/run_balance"


#: The events as a stream stores them; ``generation`` is the innermost directory.
EVENT_GENERATIONS = T.StructType([*schemas.EVENT_ROWS.fields, T.StructField("generation", T.StringType())])


def _rows() -> Column:
    return F.count(F.lit(1))


def _verdicts() -> dict[str, Column]:
    return {"valid": F.count_if(F.col("is_valid")), "bad": F.count_if(~F.col("is_valid"))}


def _watched(df: DataFrame) -> tuple[Callable[[], int], DataFrame]:
    """``df`` with its rows counted as they are read, for one action; and that count."""
    rows = Observation(f"read_{uuid.uuid4().hex}")
    return (lambda: int(rows.get["rows"])), df.observe(rows, _rows().alias("rows"))


def _balanced(
    spark: SparkSession,
    layout: Layout,
    run: Run,
    equations: Sequence[Equation],
    **recount: Callable[[], int],
) -> None:
    """Check that the counts of a run add up, and append what was compared to the
    balance table; a run whose rows do not add up fails."""
    found = check_balance({**run.counts, **run.points}, equations, recount)
    append_rows(balance_rows(spark, run.run_id, run.job_name, found), layout.run_balance)


def _quarantined(df: DataFrame, mask: bool) -> DataFrame:
    return privacy.masked(df, [*K.PHI_COLUMNS, schemas.MALFORMED]) if mask else df


def run_members(
    spark: SparkSession,
    layout: Layout,
    as_of: dt.date,
    processed_at: dt.datetime | None = None,
    salt: str | None = None,
    mask_quarantine: bool = False,
) -> Run:
    """Raw member history and migrated members to the member dimension."""
    with (
        logged_run(session.tune_lake(spark), "member_dimension", layout.run_log) as run,
        session.scratch_folder(spark) as scratch,
    ):
        historical = read_csv(
            spark,
            layout.raw("historical_member_policy"),
            schemas.HISTORICAL_MEMBER_POLICY,
            keep_malformed=True,
        )
        migrated = read_csv(spark, layout.raw("migrated_members"), schemas.MIGRATED_MEMBERS)
        seen, watched = _watched(historical)
        checked, found = stage(
            M.check_history(watched), f"{scratch}/history", ["is_valid"], **_verdicts()
        )
        run.points.update(read=seen(), valid_copies=found["valid"], bad_copies=found["bad"])
        split = quality.split_on_flag(checked)
        rejected = _quarantined(split.rejected, mask_quarantine)
        dimension = M.dimension_from_valid(
            split.valid, migrated, as_of, processed_at or run.start_time, salt
        )

        def quarantine() -> None:
            path = layout.quarantine("member_records")
            found = write_counted(rejected, lambda df: write_table(df, path), rows=_rows())
            run.counts["bad"] = found["rows"]

        def count() -> None:
            run.counts["valid"] = quality.distinct_row_count(split.valid).first()["records"]

        def save() -> None:
            # The whole date is replaced, so a flag that no member has any more goes.
            path = f"{layout.silver('member_dimension')}/processing_date={as_of:%Y-%m-%d}"
            write_partitioned(
                dimension.drop("processing_date"), path, ["active_flag"], replace="all"
            )

        write_together(save, quarantine, count)
        run.processed, run.failed = run.counts["valid"], run.counts["bad"]
        _balanced(
            spark, layout, run, [("history read", ["read"], ["valid_copies", "bad_copies"])],
            read=historical.count,
            valid_copies=lambda: checked.where("is_valid").count(),
            bad_copies=lambda: checked.where("NOT is_valid").count(),
        )
    return run


def run_claims(
    spark: SparkSession,
    layout: Layout,
    processed_at: dt.datetime | None = None,
    latest_only: bool = False,
    report_unused: bool = False,
    rebalance: bool = True,
    one_date_per_claim: bool = False,
    shuffle_bytes: int | None = None,
) -> Run:
    """Raw claims, adjustments, revenue and violations to silver tables.

    ``rebalance`` shuffles the fact table once more by year before it is written;
    without it each task writes a file per year it meets.

    ``report_unused`` also counts valid adjustments that name another member than
    their claim and so reach neither the fact table nor quarantine. For
    ``one_date_per_claim`` see :func:`silverthread.plans.claims.valid_adjustments`, for
    ``shuffle_bytes`` :func:`silverthread.session.tune`.
    """
    with (
        logged_run(session.tune_lake(spark, shuffle_bytes), "claims_fact", layout.run_log) as run,
        session.scratch_folder(spark) as scratch,
    ):
        moment = processed_at or run.start_time

        def raw(table: str, schema) -> DataFrame:
            return read_csv(spark, layout.raw(table), schema, keep_malformed=True)

        members = read_csv(spark, layout.raw("members_current"), schemas.MEMBERS_CURRENT)
        checked, found = stage(
            C.check_claims(raw("claims", schemas.CLAIMS), members),
            f"{scratch}/claims",
            ["is_valid"],
            **_verdicts(),
        )
        run.counts.update(claims=found["valid"], claims_bad=found["bad"])
        split = quality.split_on_flag(checked, distinct_rejects=False)
        adjustments = raw("claims_adjustments", schemas.CLAIMS_ADJUSTMENTS)
        seen, watched = _watched(adjustments)
        met = C.reconcile(split.valid, watched, scratch, one_date_per_claim, latest_only)
        run.counts["adjustments"] = met.n_valid
        run.points.update(met.counts, adjustments_read=seen())

        revenue = raw("revenue", schemas.REVENUE)
        seen, watched = _watched(revenue)
        judged, _ = stage(
            quality.flag(watched, C.revenue_rules(revenue)), f"{scratch}/revenue", ["is_valid"]
        )
        run.points["revenue_read"] = seen()
        paid = quality.split_on_flag(judged, distinct_rejects=False)
        violations = read_csv(spark, layout.raw("violations"), schemas.VIOLATIONS)
        fact = C.fact_of(met, moment)

        def save(name: str, df: DataFrame, write: Callable[[DataFrame], None]) -> None:
            run.counts[name] = write_counted(df, write, rows=_rows())["rows"]

        def table(name: str, df: DataFrame, path: str) -> Callable[[], None]:
            return lambda: save(name, df, lambda out: write_table(out, path))

        def fact_table() -> None:
            path = layout.silver("claims_fact")
            found = write_counted(
                rebalance_for_write(fact, "claim_year") if rebalance else fact,
                lambda df: write_partitioned(df, path, ["claim_year"], replace="all"),
                rows=_rows(),
                adjusted=F.count("adjusted_final_amount"),
            )
            run.counts["claims_fact"] = found["rows"]
            run.points["fact_adjusted"] = found["adjusted"]

        # Where every claim id is one claim, valid adjustments are used or unused, once.
        once = not latest_only and not met.counts["met_shared"]
        if report_unused or once:
            unused = met.unused.count()
            (run.counts if report_unused else run.points)["adjustments_unused"] = unused
        write_together(
            fact_table,
            table("adjustments_bad", met.rejected, layout.quarantine("adjustments")),
            table("revenue", C.finished_revenue(paid.valid, moment), layout.silver("revenue")),
            table("revenue_bad", paid.rejected, layout.quarantine("revenue")),
            table("violations", C.clean_violations(violations, moment), layout.silver("violations")),
            lambda: write_table(split.rejected, layout.quarantine("claims")),
        )
        equations = [
            ("adjustments met", ["adjustments_read"], [f"met_{v}" for v in C.VERDICTS]),
            ("revenue split", ["revenue_read"], ["revenue", "revenue_bad"]),
        ]
        if once:
            equations.append(("adjustments used", ["met_fits"], ["fact_adjusted", "adjustments_unused"]))
        _balanced(
            spark, layout, run, equations, adjustments_read=adjustments.count, revenue_read=revenue.count,
            **{f"met_{v}": met.judged.where(F.col("__verdict") == v).count for v in C.VERDICTS},
        )
        run.processed = total(run.counts, "claims", "adjustments", "revenue", "violations")
        run.failed = total(run.counts, "claims_bad", "adjustments_bad", "revenue_bad")
    return run


def events_table(spark: SparkSession, layout: Layout) -> DataFrame:
    """The normalized events of all domains and outcomes: what :func:`run_events` has
    written, or the committed generations of the stream."""
    live = Manifests(spark, layout.generations("events")).newest()
    if live is None:
        return read_table(spark, layout.silver("events"), schemas.EVENT_ROWS)
    stored = read_table(spark, layout.silver("events"), EVENT_GENERATIONS)
    return stored.where(F.col("generation").isin([g.name for g in live])).drop("generation")


def run_events(
    spark: SparkSession,
    layout: Layout,
    domain_tables: bool = False,
    keep_empty: bool = False,
    mask_members: bool = False,
    multiline: bool = False,
    rebalance: bool = True,
) -> Run:
    """Landed events to normalized domain tables and quarantine.

    The events are parsed once, into one table laid out by outcome and domain.
    ``domain_tables`` also writes the valid rows of each domain as a table of its own,
    a second time, for readers that cannot use
    :func:`silverthread.operators.events.valid_rows`. ``rebalance`` shuffles the
    parsed rows by outcome and domain before they are written; without it every
    task writes a file for each pair it meets, millions of them for a large feed.
    Fails where :func:`silverthread.plans.stream.stream_events` has stored events.
    """
    with logged_run(session.tune_lake(spark), "event_domains", layout.run_log) as run:
        if Manifests(spark, layout.generations("events")).newest() is not None:
            raise ValueError("the events of this lake come from a stream; see plans.stream")
        events = read_events(spark, layout.raw("events"), multiline=multiline)
        wide = E.normalize_all(events, keep_empty=keep_empty)
        if mask_members:
            wide = privacy.masked(wide, ["first_name", "last_name", "email", "city", "raw_event"])
        verdicts = {
            d.category: F.count_if(
                (F.col("domain") == d.category) & (F.col("outcome") == E.VALID)
            )
            for d in E.DOMAINS
        }
        run.counts = write_counted(
            rebalance_for_write(wide, "outcome", "domain") if rebalance else wide,
            lambda df: write_partitioned(
                df, layout.silver("events"), ["outcome", "domain"], replace="all"
            ),
            rejected=F.count_if(F.col("outcome") == E.REJECTED),
            **verdicts,
        )
        stored = events_table(spark, layout)

        def quarantine(domain: E.Domain) -> None:
            path = layout.quarantine(f"{domain.category.lower()}_events")
            bad = E.bad_rows(stored, domain)
            found = write_counted(bad, lambda df: write_table(df, path), rows=_rows())
            run.counts[f"{domain.category}_BAD"] = found["rows"]

        def table(domain: E.Domain) -> None:
            path = layout.silver(f"{domain.category.lower()}_events")
            write_table(E.valid_rows(stored, domain), path)

        write_together(
            *[partial(quarantine, domain) for domain in E.DOMAINS],
            *[partial(table, domain) for domain in E.DOMAINS if domain_tables],
            lambda: write_table(E.rejected_events(stored), layout.quarantine("rejected_events")),
        )
        run.processed = total(run.counts, *[d.category for d in E.DOMAINS])
        run.failed = total(run.counts, *[f"{d.category}_BAD" for d in E.DOMAINS])
    return run


def silver_facts(spark: SparkSession, layout: Layout) -> G.Facts:
    """The facts of the gold table, as earlier runs left them."""
    return G.Facts(
        read_table(spark, layout.silver("claims_fact"), schemas.CLAIMS_FACT_AMOUNTS),
        read_table(spark, layout.silver("revenue")),
        read_table(spark, layout.silver("violations")),
        events_table(spark, layout),
    )


def run_gold(
    spark: SparkSession,
    layout: Layout,
    as_of: dt.date,
    processed_at: dt.datetime | None = None,
    on_repeated_member: str = "keep",
    count_events_once: bool = False,
    append: bool = False,
    dimension_date: dt.date | None = None,
    cluster_members: bool = False,
) -> Run:
    """Silver tables to the member-360 snapshot of ``as_of``.

    Reads the dimension of ``dimension_date``, by default that of ``as_of``, and
    fails if there is none.
    ``on_repeated_member`` decides about members that the dimension holds more
    than once: ``keep`` all rows, ``fail``, or keep the ``latest`` one.
    ``cluster_members`` writes each state in ranges of ``member_id``, so that looking up
    a member opens a few files.
    """
    with logged_run(session.tune_lake(spark), "member_360", layout.run_log) as run:
        dimension = dated_partition(
            spark,
            layout.silver("member_dimension"),
            "processing_date",
            f"{dimension_date or as_of:%Y-%m-%d}",
            schemas.MEMBER_DIMENSION,
        )
        if on_repeated_member == "fail" and not G.repeated_members(dimension).isEmpty():
            raise ValueError("the member dimension holds some member_id more than once")
        if on_repeated_member == "latest":
            dimension = latest_per_key(
                dimension, ["member_id"], ["enrollment_date", "coverage_start_date"]
            )
        gold = G.build_member_360(
            dimension,
            silver_facts(spark, layout),
            as_of,
            processed_at or run.start_time,
            count_events_once,
        )
        run.counts = write_counted(
            cluster_for_write(gold, "member_id", ["state"])
            if cluster_members
            else rebalance_for_write(gold, "state"),
            lambda df: write_snapshot(
                df, layout.gold("member_360"), as_of, ["state"], idempotent=not append
            ),
            rows=_rows(),
        )
        run.processed = run.counts["rows"]
    return run


def run_backfill(
    spark: SparkSession,
    layout: Layout,
    run_dates: Sequence[dt.date],
    processed_at: dt.datetime | None = None,
    count_events_once: bool = False,
) -> Run:
    """The member-360 snapshots of several dates by one plan, each from the dimension
    that was valid on it (see :func:`silverthread.plans.gold.backfill_member_360`). A
    date's snapshot is replaced state by state. Dates before the first dimension have
    none."""
    with logged_run(session.tune_lake(spark), "member_360_backfill", layout.run_log) as run:
        stored = read_table(spark, layout.silver("member_dimension"), schemas.MEMBER_DIMENSION)
        gold = G.backfill_member_360(
            stored, silver_facts(spark, layout), run_dates, processed_at or run.start_time,
            count_events_once,
        )
        run.counts = write_counted(
            rebalance_for_write(gold, "run_date", "state"),
            lambda df: write_partitioned(df, layout.gold("member_360"), ["run_date", "state"]),
            rows=_rows(),
        )
        run.processed = run.counts["rows"]
    return run


def run_all(
    spark: SparkSession,
    layout: Layout,
    as_of: dt.date,
    processed_at: dt.datetime | None = None,
    domain_tables: bool = False,
) -> list[Run]:
    """All four runs. Members, claims and events have no table in common and run at the
    same time, so that small or uneven steps of one do not leave the cluster idle; the
    snapshot follows, unless one of them has failed."""
    runs = write_together(
        partial(run_members, spark, layout, as_of, processed_at),
        partial(run_claims, spark, layout, processed_at),
        partial(run_events, spark, layout, domain_tables),
    )
    return [*runs, run_gold(spark, layout, as_of, processed_at)]
