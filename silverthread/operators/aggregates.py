"""Per-member measures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.money import MONEY_TYPE, sum_money


@dataclass(frozen=True)
class Measure:
    """One output column of a grouped aggregate.

    ``how`` is ``money`` (exact sum, double), ``count`` (non-null values) or
    ``max``.
    """

    name: str
    source: str
    how: str

    def carried(self) -> Column:
        """The least that has to travel to the aggregate."""
        source = F.col(self.source)
        if self.how == "money":
            return source.cast(MONEY_TYPE)
        if self.how == "count":
            return F.when(source.isNotNull(), F.lit(1))
        return source

    def reduced(self) -> Column:
        """The aggregate of the carried values."""
        if self.how == "money":
            return sum_money(self.name)
        if self.how == "count":
            return F.count(self.name)
        return F.max(self.name)


# Measures of each fact table
CLAIM_MEASURES = [
    Measure("lifetime_claim_amount", "final_claim_amount", "money"),
    Measure("total_claim_count", "claim_id", "count"),
]
REVENUE_MEASURES = [Measure("lifetime_revenue", "premium_collected", "money")]
VIOLATION_MEASURES = [Measure("violation_count", "violation_id", "count")]
CLAIM_EVENT_MEASURES = [
    Measure("streaming_claim_events", "event_id", "count"),
    Measure("last_claim_event_id", "event_id", "max"),
]
BILLING_EVENT_MEASURES = [Measure("streaming_payment_events", "event_id", "count")]
POLICY_EVENT_MEASURES = [Measure("policy_change_count", "event_id", "count")]
MEMBER_EVENT_MEASURES = [Measure("member_update_count", "event_id", "count")]


def carry(df: DataFrame, key: str, measures: Sequence[Measure]) -> DataFrame:
    """The key and the inputs of the measures, nothing else."""
    return df.select(key, *[m.carried().alias(m.name) for m in measures])


def aggregate_fact(df: DataFrame, key: str, measures: Sequence[Measure]) -> DataFrame:
    """Measures of one fact table per key, summed before the shuffle."""
    return carry(df, key, measures).groupBy(key).agg(
        *[m.reduced().alias(m.name) for m in measures]
    )


def aggregate_facts(
    facts: Sequence[tuple[DataFrame, Sequence[Measure]]], key: str
) -> DataFrame:
    """Measures of several fact tables, one row per key found in any of them.

    All facts go through one aggregate: every task reduces its rows to one per
    key before a single shuffle, in place of a shuffle and a join per table.
    Measures of tables that lack the key are null (counts zero).
    """
    carried = [carry(df, key, measures) for df, measures in facts]
    wide = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), carried)
    every = [m for _, measures in facts for m in measures]
    return wide.groupBy(key).agg(*[m.reduced().alias(m.name) for m in every])


def partial_facts(
    facts: Sequence[tuple[DataFrame, Sequence[Measure]]], key: str
) -> DataFrame:
    """Like :func:`aggregate_facts`, but exact sums that can be added up further: money
    stays decimal, counts are null where a table lacks the key. Several frames may have
    a measure, which is taken over all of them."""
    carried = [carry(df, key, measures) for df, measures in facts]
    wide = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), carried)
    every = {m.name: m for _, measures in facts for m in measures}
    return wide.groupBy(key).agg(*[_partial(m).alias(m.name) for m in every.values()])


def _partial(m: Measure) -> Column:
    return {"money": F.sum, "count": F.sum, "max": F.max}[m.how](m.name)


def merged_facts(partials: DataFrame, key: str, measures: Sequence[Measure]) -> DataFrame:
    """Measures per key from partial ones, as :func:`aggregate_facts` gives them."""
    out = []
    for m in measures:
        total = _partial(m)
        if m.how == "money":
            total = total.cast("double")
        elif m.how == "count":
            total = F.coalesce(total, F.lit(0))
        out.append(total.alias(m.name))
    return partials.groupBy(key).agg(*out)


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace nulls of the named numeric columns by zero."""
    return df.fillna(0, subset=list(columns))


def total(counts: Mapping[str, int], *names: str) -> int:
    """Sum of some of the observed counts of a run."""
    return sum(counts[name] for name in names)


def distinct_events(df: DataFrame) -> DataFrame:
    """One row per member and event, for counts of events in place of counts of
    exploded rows."""
    return df.select("member_id", "event_id").distinct()
