"""The member-360 table: active members with everything known about them."""

from __future__ import annotations

import bisect
import datetime as dt
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as K
from ..functions import member, scoring
from ..operators import aggregates as A, events as E, joins, quality
from ..sources import active_members


class Facts(NamedTuple):
    """Silver tables the gold table is built from. ``events`` has the columns
    ``member_id``, ``event_id``, ``domain`` and ``outcome``."""

    claims: DataFrame
    revenue: DataFrame
    violations: DataFrame
    events: DataFrame


def domain_events(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Valid rows kept in one table per domain, as one ``events`` frame."""
    parts = [
        df.select("member_id", "event_id", F.lit(domain).alias("domain"), F.lit(E.VALID).alias("outcome"))
        for domain, df in tables.items()
    ]
    return quality.union_by_name(*parts)


# Gold column counting the events of each domain
EVENT_COUNTS = {
    "CLAIMS": "streaming_claim_events",
    "BILLING": "streaming_payment_events",
    "POLICY": "policy_change_count",
    "MEMBER": "member_update_count",
}


def activity_facts(
    facts: Facts, count_events_once: bool = False
) -> list[tuple[DataFrame, list[A.Measure]]]:
    """The measures of all facts, with the rows they are taken from.

    The domains are counted in one scan of the events. Events are counted per
    flattened row; ``count_events_once`` counts each event once.
    """
    events = facts.events.filter(F.col("outcome") == E.VALID).select(
        "member_id", "event_id", "domain"
    )
    if count_events_once:
        events = events.distinct()
    by_domain = events.selectExpr(
        "member_id",
        *[
            f"CASE WHEN domain = '{domain}' THEN event_id END AS {domain}"
            for domain in EVENT_COUNTS
        ],
    )
    return [
        (facts.claims, A.CLAIM_MEASURES),
        (facts.revenue, A.REVENUE_MEASURES),
        (facts.violations, A.VIOLATION_MEASURES),
        (
            by_domain,
            [A.Measure(name, domain, "count") for domain, name in EVENT_COUNTS.items()],
        ),
    ]


def member_activity(facts: Facts, count_events_once: bool = False) -> DataFrame:
    """All measures of all facts, one row per member, by a single shuffle."""
    return A.aggregate_facts(activity_facts(facts, count_events_once), "member_id")


def score(
    members: DataFrame,
    as_of: dt.date | Column,
    high_violations: float = K.HIGH_RISK_VIOLATIONS,
    high_amount: float = K.HIGH_RISK_CLAIM_AMOUNT,
) -> DataFrame:
    """Tenure, value, engagement, risk and churn of each member row."""
    events = ("streaming_claim_events", "streaming_payment_events")
    return members.withColumns(
        {
            "tenure_days": member.tenure_days("enrollment_date", as_of),
            "lifetime_value": scoring.lifetime_value("lifetime_revenue", "lifetime_claim_amount"),
            "engagement_score": scoring.engagement(*events),
            "risk_tier": scoring.risk_tier(
                "violation_count", "lifetime_claim_amount", high_violations, high_amount
            ),
            "churn_flag": scoring.churn_flag(*events),
        }
    )


def build_member_360(
    dimension: DataFrame,
    facts: Facts,
    as_of: dt.date,
    processed_at: dt.datetime,
    count_events_once: bool = False,
) -> DataFrame:
    """Gold rows of the active members of one version of the dimension."""
    activity = member_activity(facts, count_events_once)
    joined = joins.join_aggregates(active_members(dimension), [activity], "member_id")
    scored = score(A.fill_zero(joined, K.ZERO_FILLED), as_of)
    return scored.withColumn("processing_timestamp", F.lit(processed_at)).select(
        *K.MEMBER_360_COLUMNS
    )


def versions_as_of(
    versions: Sequence[dt.date], run_dates: Sequence[dt.date]
) -> list[tuple[dt.date, dt.date]]:
    """(run date, version): the newest version of the dimension on or before each run
    date, by the range in which a version is valid; dates before all versions have none."""
    known = sorted(set(versions))
    found = []
    for day in sorted(set(run_dates)):
        at = bisect.bisect_right(known, day)
        if at:
            found.append((day, known[at - 1]))
    return found


def backfill_member_360(
    dimension: DataFrame,
    facts: Facts,
    run_dates: Sequence[dt.date],
    processed_at: dt.datetime,
    count_events_once: bool = False,
) -> DataFrame:
    """Gold rows of several run dates, with ``run_date``, by one plan.

    ``dimension`` holds its versions by ``processing_date``. Each run date takes the
    version that is valid on it, so a version is read once for all the dates it serves,
    the facts are aggregated once, and the dates multiply rows only after that. Equals
    a run of :func:`build_member_360` per date.
    """
    spark = dimension.sparkSession
    versions = [r[0] for r in dimension.select("processing_date").distinct().collect()]
    served = versions_as_of(versions, run_dates)
    dates = spark.createDataFrame(served, "run_date date, processing_date date")
    used = sorted({version for _, version in served})
    members = active_members(dimension).where(F.col("processing_date").isin(used))
    activity = member_activity(facts, count_events_once)
    joined = A.fill_zero(joins.join_aggregates(members, [activity], "member_id"), K.ZERO_FILLED)
    # The dates are those that were asked for, a few rows of the driver.
    scored = score(joined.join(F.broadcast(dates), "processing_date"), F.col("run_date"))
    return scored.withColumn("processing_timestamp", F.lit(processed_at)).select(
        *K.MEMBER_360_COLUMNS, "run_date"
    )


def repeated_members(dimension: DataFrame, keys: Sequence[str] = ("member_id",)) -> DataFrame:
    """Keys that the dimension holds more than once, with their counts; the gold
    table has one row per member only if this is empty."""
    counted = dimension.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return counted.filter(F.col("copies") > 1)
