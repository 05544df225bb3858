"""Nested, versioned events to flat domain tables, in one pass.

Each event is parsed, routed, flattened and judged by one projection over one
scan: no branch per domain and version, no union, no shuffle. The result is one
wide table with a domain and an outcome per row; laid out by those two, every
consumer prunes to its own files and columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas
from ..functions.money import amount_from_text
from .quality import Rule, Split, all_hold, not_null, positive, split_by_rules

VALID, BAD, REJECTED = "valid", "bad", "rejected"
ENVELOPE = ["event_id", "event_timestamp", "member_id"]


@dataclass(frozen=True)
class Domain:
    """How the events of one category become rows.

    ``shapes`` gives, per schema version, the payload path of each output
    column; a path ending in ``[]`` is an array that yields a row per element. A
    column without a path is null in that version. ``amounts`` are read from
    text as double.
    """

    category: str
    columns: tuple[str, ...]
    shapes: dict[str, dict[str, str]]
    amounts: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    above_zero: tuple[str, ...] = field(default=())

    @property
    def rules(self) -> list[Rule]:
        return [*not_null(*self.required), *[positive(name) for name in self.above_zero]]

    @property
    def output(self) -> list[str]:
        return [*ENVELOPE, *self.columns]

    @property
    def repeated(self) -> str | None:
        """The output column filled from an array in some version."""
        for paths in self.shapes.values():
            for name, path in paths.items():
                if path.endswith("[]"):
                    return name
        return None


# Categories, versions, payload paths and quality rules
CLAIMS = Domain(
    category="CLAIMS",
    columns=("claim_id", "claim_amount", "provider_id", "diagnosis_code"),
    shapes={
        "v1": {
            "claim_id": "claim_id",
            "claim_amount": "claim_amount",
            "provider_id": "provider_id",
        },
        "v2": {
            "claim_id": "claim.id",
            "claim_amount": "claim.amount",
            "provider_id": "provider.id",
            "diagnosis_code": "claim.diagnosis_codes[]",
        },
    },
    amounts=("claim_amount",),
    required=("claim_id", "provider_id"),
    above_zero=("claim_amount",),
)
BILLING = Domain(
    category="BILLING",
    columns=("payment_amount", "payment_method"),
    shapes={
        "v1": {"payment_amount": "payment_amount"},
        "v2": {"payment_amount": "payment.amount", "payment_method": "payment.methods[]"},
    },
    amounts=("payment_amount",),
    above_zero=("payment_amount",),
)
POLICY = Domain(
    category="POLICY",
    columns=("policy_id", "start_date", "end_date"),
    shapes={
        "v1": {"policy_id": "policy_id"},
        "v2": {
            "policy_id": "policy.id",
            "start_date": "policy.coverage.start_date",
            "end_date": "policy.coverage.end_date",
        },
    },
    required=("policy_id",),
)
MEMBER = Domain(
    category="MEMBER",
    columns=("first_name", "last_name", "email", "city"),
    shapes={
        "v1": {
            "first_name": "first_name",
            "last_name": "last_name",
            "email": "email",
            "city": "city",
        },
        "v2": {
            "first_name": "profile.first_name",
            "last_name": "profile.last_name",
            "email": "profile.email",
            "city": "profile.address.city",
        },
    },
    required=("first_name", "last_name"),
)
DOMAINS = (CLAIMS, BILLING, POLICY, MEMBER)


def _problem(events: DataFrame) -> Column:
    """Why an event cannot enter any domain; null when it can."""
    problem = F.when(F.lit(False), F.lit(None).cast("string"))
    if schemas.MALFORMED in events.columns:
        problem = problem.when(F.col(schemas.MALFORMED).isNotNull(), F.lit("malformed"))
    for name in ("event_id", "member_id", "payload"):
        problem = problem.when(F.col(name).isNull(), F.lit(f"{name}_missing"))
    return problem


def validate_events(events: DataFrame) -> DataFrame:
    """Events whose envelope is complete."""
    return events.filter(_problem(events).isNull())


def route(events: DataFrame, domain: Domain, version: str) -> DataFrame:
    """Events of one category and schema version."""
    return events.filter(_is(domain, version))


def _is(domain: Domain, version: str) -> Column:
    return (F.col("event_category") == domain.category) & (F.col("schema_version") == version)


def _routable(domain: Domain) -> Column:
    return (F.col("event_category") == domain.category) & F.col("schema_version").isin(*domain.shapes)


def _field(path: str) -> Column:
    """The value at a path of the payload; names between dots are taken as they are."""
    return reduce(lambda value, name: value.getField(name), path.split("."), F.col("payload"))


def _by_version(domain: Domain, name: str) -> Column:
    """An output column from whichever path its version uses."""
    value = F.when(F.lit(False), F.lit(None).cast("string"))
    for version, paths in domain.shapes.items():
        if name in paths:
            value = value.when(_is(domain, version), _field(paths[name]))
    return amount_from_text(value) if name in domain.amounts else value


def _elements(domains: Sequence[Domain], accepted: Column) -> Column:
    """The array an event yields rows from; one null element where its version has
    none, so that such an event yields one row."""
    one_null = F.array(F.lit(None).cast("string"))
    arrays = F.when(~accepted, one_null)
    for domain in domains:
        for version, paths in domain.shapes.items():
            if domain.repeated in paths:
                own = _field(paths[domain.repeated].removesuffix("[]"))
                arrays = arrays.when(_is(domain, version), own)
    return arrays.otherwise(one_null)


def _flatten(
    events: DataFrame,
    domains: Sequence[Domain],
    kept: Sequence[Column],
    accepted: Column,
    keep_empty: bool,
) -> DataFrame:
    """Envelope, ``kept`` columns and the columns of the domains, a row per
    element."""
    spread = F.explode_outer if keep_empty else F.explode
    single = [(d, name) for d in domains for name in d.columns if name != d.repeated]
    repeated = [d for d in domains if d.repeated]
    rows = events.select(
        *ENVELOPE,
        "event_category",
        *kept,
        *[_by_version(d, name).alias(name) for d, name in single],
        spread(_elements(domains, accepted)).alias("element"),
    )
    return rows.select(
        *[name for name in rows.columns if name != "element"],
        *[
            F.when(F.col("event_category") == d.category, F.col("element")).alias(d.repeated)
            for d in repeated
        ],
    )


def normalize_all(
    events: DataFrame,
    domains: Sequence[Domain] = DOMAINS,
    keep_empty: bool = False,
) -> DataFrame:
    """Every event as wide rows with ``domain``, ``outcome``, ``reject_reason``.

    An event whose array is empty or null yields no row, unless ``keep_empty``
    keeps it with a null element. Events that enter no domain come out once as
    ``rejected``, with the reason and their text in ``raw_event``. Works on batch
    and streaming frames.

    Meant to be written, laid out by outcome and domain. For one domain without a
    table between, :func:`normalize` gives the narrower plan.
    """
    raw = F.to_json(F.struct(*[name for name in events.columns if name != schemas.MALFORMED]))
    if schemas.MALFORMED in events.columns:
        raw = F.coalesce(schemas.MALFORMED, raw)
    known = F.coalesce(reduce(lambda a, b: a | b, map(_routable, domains)), F.lit(False))
    unknown = F.when(~known, F.lit("unknown_category_or_version"))
    judged = events.withColumn("reject_reason", F.coalesce(_problem(events), unknown))
    accepted = F.col("reject_reason").isNull()
    kept = [F.col("reject_reason"), F.when(~accepted, raw).alias("raw_event")]
    rows = _flatten(judged, domains, kept, accepted, keep_empty)
    outcome = F.when(F.col("reject_reason").isNotNull(), F.lit(REJECTED))
    for d in domains:
        own = F.col("event_category") == d.category
        outcome = outcome.when(own, F.when(all_hold(d.rules), F.lit(VALID)).otherwise(F.lit(BAD)))
    return rows.select(
        *ENVELOPE,
        *[name for d in domains for name in d.columns],
        "reject_reason",
        "raw_event",
        outcome.alias("outcome"),
        F.when(accepted, F.col("event_category")).otherwise(F.lit("NONE")).alias("domain"),
    )


def normalize(events: DataFrame, domain: Domain, keep_empty: bool = False) -> DataFrame:
    """Rows of one domain before quality rules, from its own events only."""
    own = validate_events(events).filter(_routable(domain))
    rows = _flatten(own, [domain], [], F.lit(True), keep_empty)
    return rows.select(*domain.output)


def split_domain(
    events: DataFrame, domain: Domain, keep_empty: bool = False, distinct_rejects: bool = True
) -> Split:
    """Rows of one domain that meet its rules, and the rest once each."""
    return split_by_rules(normalize(events, domain, keep_empty), domain.rules, distinct_rejects)


def valid_rows(wide: DataFrame, domain: Domain) -> DataFrame:
    """Rows of a domain that meet its rules, as they come."""
    return _rows(wide, domain, VALID)


def bad_rows(wide: DataFrame, domain: Domain, distinct: bool = True) -> DataFrame:
    """Rows of a domain that break its rules, once each."""
    rows = _rows(wide, domain, BAD)
    return rows.distinct() if distinct else rows


def rejected_events(wide: DataFrame) -> DataFrame:
    """Events that entered no domain, with the reason."""
    return wide.filter(F.col("outcome") == REJECTED).select(
        *ENVELOPE, "reject_reason", "raw_event"
    )


def _rows(wide: DataFrame, domain: Domain, outcome: str) -> DataFrame:
    wanted = (F.col("outcome") == outcome) & (F.col("domain") == domain.category)
    return wide.filter(wanted).select(*domain.output)


def outcome_counts(wide: DataFrame) -> DataFrame:
    """Rows per domain and outcome, copies of a bad row counted once.

    One pass: valid rows collapse to a count before the shuffle, and only bad
    rows travel with their columns.
    """
    content = [name for name in wide.columns if name not in ("domain", "outcome")]
    bad = F.when(F.col("outcome") == BAD, F.struct(*content))
    grouped = (
        wide.filter(F.col("outcome") != REJECTED)
        .groupBy("domain", "outcome", bad.alias("bad_row"))
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    counted = F.when(F.col("outcome") == BAD, F.lit(1)).otherwise(F.col("copies"))
    return grouped.groupBy("domain", "outcome").agg(F.sum(counted).alias("records"))
