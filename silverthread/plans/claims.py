"""Claims reconciled with adjustments; revenue and violations cleaned."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from .. import constants as K
from ..functions.money import settled_amount
from ..operators import joins, quality
from ..operators.latest import latest_per_key
from ..schemas import MALFORMED
from ..session import scratch_path
from ..sinks import stage

_KEYS = ["claim_id", "member_id"]
#: Order of the adjustments of one claim.
_NEWEST = ["adjustment_date", "adjustment_id"]


def claim_rules(amounts: tuple[float, float] = K.CLAIM_AMOUNT_RANGE) -> list[quality.Rule]:
    """Quality rules of a claim, apart from its member being known."""
    return [
        *quality.not_null("claim_id", "claim_date"),
        quality.in_range("claim_amount", *amounts),
    ]


def check_claims(
    claims: DataFrame,
    members: DataFrame,
    amounts: tuple[float, float] = K.CLAIM_AMOUNT_RANGE,
) -> DataFrame:
    """Distinct claims with ``is_valid``: the rules hold and the member exists.

    The member flag depends on the claim alone, so the dedup may follow the join
    and use its partitioning: one shuffle of the claims does for both.
    """
    flagged = joins.flag_parent(claims, members, "member_id", "has_member")
    known = quality.distinct_rows(flagged)
    rules = [
        *quality.readable(claims),
        quality.Rule("member_unknown", F.col("has_member")),
        *claim_rules(amounts),
    ]
    return quality.flag(known, rules).drop("has_member")


def _adjustment_rules(adjustments: DataFrame) -> list[quality.Rule]:
    """Quality rules of an adjustment, apart from its claim's date."""
    return [
        *quality.readable(adjustments),
        quality.adds_up("original_claim_amount", "adjustment_amount", "adjusted_final_amount"),
    ]


def valid_adjustments(
    adjustments: DataFrame, valid_claims: DataFrame, one_date_per_claim: bool = False
) -> DataFrame:
    """Adjustments of valid claims whose amounts add up and that do not predate
    the claim.

    Where several valid claims share an id, an adjustment comes out once for each
    of them it follows; ``one_date_per_claim`` compares it with the earliest of
    them instead and keeps it once. A ``claim_date`` among the adjustments' own
    columns comes out as ``adjustment_claim_date``.
    """
    adjustments = adjustments.withColumnsRenamed({"claim_date": "adjustment_claim_date"})
    if one_date_per_claim:
        valid_claims = valid_claims.groupBy("claim_id").agg(
            F.min("claim_date").alias("claim_date")
        )
    dated = joins.adjust_with_claim(adjustments, valid_claims)
    rules = [*_adjustment_rules(adjustments), quality.not_before("adjustment_date", "claim_date")]
    return dated.filter(quality.all_hold(rules)).drop("claim_date")


def rejected_adjustments(adjustments: DataFrame, valid: DataFrame) -> DataFrame:
    """Adjustments whose id is null or on no valid adjustment."""
    return joins.without_match(adjustments, valid, "adjustment_id")


def claims_fact(
    valid_claims: DataFrame,
    adjustments: DataFrame,
    processed_at: dt.datetime,
    latest_only: bool = False,
) -> DataFrame:
    """Valid claims with their adjustments and the final amount.

    A claim adjusted several times has a row per adjustment; ``latest_only``
    keeps the newest adjustment of each claim and member.
    """
    if latest_only:
        adjustments = latest_per_key(adjustments, _KEYS, _NEWEST)
    joined = joins.claims_with_adjustments(
        valid_claims.drop(MALFORMED), adjustments.drop(MALFORMED)
    )
    return _finished(joined, processed_at)


def _finished(joined: DataFrame, processed_at: dt.datetime) -> DataFrame:
    return joined.withColumns(
        {
            "final_claim_amount": settled_amount("claim_amount", "adjusted_final_amount"),
            "processing_timestamp": F.lit(processed_at),
            "dq_flag": F.lit(K.DQ_VALID),
            "claim_year": F.year("claim_date"),
        }
    )


class Reconciled(NamedTuple):
    """What becomes of valid claims and of all adjustments.

    ``adjusted``: claims with a valid adjustment of theirs; ``unadjusted``: the other
    claims; ``valid``: valid adjustments, as :func:`valid_adjustments` gives them;
    ``rejected``, ``unused``: see :func:`rejected_adjustments` and
    :func:`silverthread.operators.joins.unused_adjustments`. ``n_valid`` counts ``valid``;
    ``judged`` has every adjustment once with its verdict, and ``counts`` how many have each.
    """

    adjusted: DataFrame
    unadjusted: DataFrame
    valid: DataFrame
    rejected: DataFrame
    unused: DataFrame
    n_valid: int
    judged: DataFrame
    counts: dict[str, int]


VERDICTS = _FREE, _FAILED, _FITS, _SHARED = "free", "failed", "fits", "shared"


def reconcile(
    valid_claims: DataFrame,
    adjustments: DataFrame,
    scratch: str,
    one_date_per_claim: bool = False,
    latest_only: bool = False,
) -> Reconciled:
    """Claims and adjustments brought together by claim id, once.

    Claims are reduced to one row per id before they meet the adjustments, so every
    adjustment, read and shuffled once, comes out once with its verdict and the claim
    of its id, in one table below ``scratch`` laid out by verdict. The results are
    filters of that table: an adjustment that fits a claim of its own member is a row
    of the fact as it stands. Ids that several valid claims share are left to plain
    joins; these take part only if the table has such rows.
    """
    claims = valid_claims.drop(MALFORMED)
    clash = [c for c in adjustments.columns if c in claims.columns and c not in _KEYS]
    marked = adjustments.withColumnsRenamed({c: f"adjustment_{c}" for c in clash})
    raw = dict(zip(marked.columns, adjustments.columns))
    # Valid adjustments keep their own names, but for the claim's date.
    names = {new: old for new, old in raw.items() if old != "claim_date"}
    by_id = claims.groupBy("claim_id").agg(
        F.count(F.lit(1)).alias("__claims"), F.max(F.struct(*claims.columns)).alias("__claim")
    )
    met = joins.hot_key_join(marked, by_id, "claim_id", "left")
    in_time = quality.Rule("late", F.col("adjustment_date") >= F.col("__claim.claim_date"))
    fits = quality.all_hold([*_adjustment_rules(marked), in_time])
    verdict = (
        F.when(F.col("__claims").isNull(), _FREE).when(F.col("__claims") > 1, _SHARED)
        .when(fits, _FITS).otherwise(_FAILED)
    )
    # Only adjustments that fit are read with their claim; the others do without it.
    own_claim = F.when(F.col("__verdict") == _FITS, F.col("__claim"))
    met = met.withColumn("__verdict", verdict).withColumn("__claim", own_claim).drop("__claims")
    judged, found = stage(
        met, f"{scratch}/judged", ["__verdict"],
        **{f"met_{v}": F.count_if(F.col("__verdict") == v) for v in VERDICTS},
    )
    counts = dict(found)
    single = judged.where(F.col("__verdict") == _FITS)
    own = F.col("member_id") == F.col("__claim.member_id")
    valid = single.select(*marked.columns).withColumnsRenamed(names)
    unused = single.where(~F.coalesce(own, F.lit(False))).select(*marked.columns).withColumnsRenamed(names)
    direct = single.where(own)
    if latest_only:
        tie = [c for c in marked.columns if c not in (*_KEYS, *_NEWEST)]
        direct = latest_per_key(direct, _KEYS, _NEWEST, tie)
    rest = [c for c in marked.columns if c not in (*_KEYS, MALFORMED)]
    adjusted = direct.select(*[F.col(f"__claim.{c}").alias(c) for c in claims.columns], *rest)
    taken, rows = direct.select(*_KEYS), counts["met_fits"]
    if counts["met_shared"]:
        wanted = judged.where(F.col("__verdict") == _SHARED).select(*marked.columns)
        of_ids = joins.require_parent(claims, wanted.select("claim_id"), "claim_id")
        more = valid_adjustments(wanted.withColumnsRenamed(raw), of_ids, one_date_per_claim)
        more, found = stage(more, f"{scratch}/shared", rows=F.count(F.lit(1)))
        valid, rows = valid.unionByName(more), rows + found["rows"]
        unused = unused.unionByName(joins.unused_adjustments(more, of_ids))
        if latest_only:
            more = latest_per_key(more, _KEYS, _NEWEST)
        more = more.withColumnsRenamed({old: new for new, old in names.items()}).drop(MALFORMED)
        adjusted = adjusted.unionByName(joins.hot_key_join(of_ids, more, _KEYS, "inner"))
        taken = taken.unionByName(more.select(*_KEYS))
    unadjusted = joins.hot_key_join(claims, taken.distinct(), _KEYS, "left_anti").select(*claims.columns)
    failed = judged.where((F.col("__verdict") != _FITS) | F.col("adjustment_id").isNull())
    failed = failed.select(*marked.columns).withColumnsRenamed(raw)
    rejected = joins.without_match(failed, valid.select("adjustment_id"), "adjustment_id")
    return Reconciled(adjusted, unadjusted, valid, rejected, unused, rows, judged, counts)


def fact_of(found: Reconciled, processed_at: dt.datetime) -> DataFrame:
    """The fact table of reconciled claims."""
    rows = found.adjusted.unionByName(found.unadjusted, allowMissingColumns=True)
    return _finished(rows, processed_at)


class ClaimsBuild(NamedTuple):
    fact: DataFrame
    rejected_claims: DataFrame
    rejected_adjustments: DataFrame


def build_claims_fact(
    members: DataFrame,
    claims: DataFrame,
    adjustments: DataFrame,
    processed_at: dt.datetime,
    latest_only: bool = False,
    staged: bool = False,
    one_date_per_claim: bool = False,
) -> ClaimsBuild:
    """The fact table, rejected claims and rejected adjustments.

    Checked claims and adjustments have several consumers each. ``staged`` writes them
    once to the shared scratch folder, where they stay for the returned frames to read
    until its owner clears it (see :func:`reconcile`, whose folder the caller chooses);
    without it nothing is written and every result computes its own inputs.
    """
    checked, spark = check_claims(claims, members), claims.sparkSession
    if staged:
        folder = scratch_path(spark, "claims")
        checked, _ = stage(checked, f"{folder}/checked", ["is_valid"])
        split = quality.split_on_flag(checked, distinct_rejects=False)
        found = reconcile(split.valid, adjustments, folder, one_date_per_claim, latest_only)
        return ClaimsBuild(fact_of(found, processed_at), split.rejected, found.rejected)
    split = quality.split_on_flag(checked, distinct_rejects=False)
    valid = valid_adjustments(adjustments, split.valid, one_date_per_claim)
    fact = claims_fact(split.valid, valid, processed_at, latest_only)
    return ClaimsBuild(fact, split.rejected, rejected_adjustments(adjustments, valid))


def revenue_rules(revenue: DataFrame) -> list[quality.Rule]:
    return [*quality.readable(revenue), quality.non_negative_money("premium_collected")]


def clean_revenue(revenue: DataFrame, processed_at: dt.datetime) -> DataFrame:
    """Revenue rows of zero or more."""
    return finished_revenue(revenue.filter(quality.all_hold(revenue_rules(revenue))), processed_at)


def finished_revenue(valid: DataFrame, processed_at: dt.datetime) -> DataFrame:
    return valid.drop(MALFORMED).withColumn("processing_timestamp", F.lit(processed_at))


def rejected_revenue(revenue: DataFrame) -> DataFrame:
    """The rows :func:`clean_revenue` leaves out."""
    return revenue.filter(~quality.all_hold(revenue_rules(revenue)))


def clean_violations(violations: DataFrame, processed_at: dt.datetime) -> DataFrame:
    """Distinct violations."""
    return quality.distinct_rows(violations).withColumn(
        "processing_timestamp", F.lit(processed_at)
    )
