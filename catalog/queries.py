"""Each operator as a query over the driver's test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from silverthread import constants as K, schemas, session, sinks, sources, streaming
from silverthread.functions import member, money, privacy, scoring
from silverthread.operators import aggregates as A, drift, events as E, joins, latest, quality
from silverthread.plans import claims as C, gold as G, incremental, jobs, members as M, runlog, stream

from . import inputs as I
from .inputs import AS_OF, PROCESSED_AT, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under its function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _comparable(function(session.tune_lake(spark), sf_dir))

    QUERIES[function.__name__] = run
    return function


def _comparable(df: DataFrame) -> DataFrame:
    """Days and moments as text, the same in any engine and time zone."""
    timed = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return df.select(
        *[
            F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, timed) else f.name
            for f in df.schema.fields
        ]
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.parse_events(I.envelopes(spark, sf_dir), "doc")


def _checked_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.check_claims(I.claims(spark, sf_dir), I.members_current(spark, sf_dir))


def _valid_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.split_on_flag(_checked_claims(spark, sf_dir), distinct_rejects=False).valid


def _valid_adjustments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.valid_adjustments(I.adjustments(spark, sf_dir), _valid_claims(spark, sf_dir))


def _fact(spark: SparkSession, sf_dir: str, latest_only: bool = False) -> DataFrame:
    return C.build_claims_fact(
        I.members_current(spark, sf_dir), I.claims(spark, sf_dir), I.adjustments(spark, sf_dir),
        PROCESSED_AT, latest_only, staged=True,
    ).fact


def _dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.build_member_dimension(
        I.historical(spark, sf_dir), I.migrated(spark, sf_dir), AS_OF, PROCESSED_AT
    ).valid


def _facts(spark: SparkSession, sf_dir: str) -> G.Facts:
    return G.Facts(
        _fact(spark, sf_dir),
        C.clean_revenue(I.revenue(spark, sf_dir), PROCESSED_AT),
        C.clean_violations(I.violations(spark, sf_dir), PROCESSED_AT),
        E.normalize_all(_events(spark, sf_dir)),
    )


#: Name of each field of a payload, flat or nested.
_LEAVES = {
    "nested_claim_id": "claim.id", "nested_claim_amount": "claim.amount",
    "nested_provider_id": "provider.id", "claim_id": "claim_id", "claim_amount": "claim_amount",
    "provider_id": "provider_id", "nested_payment_amount": "payment.amount",
    "payment_amount": "payment_amount", "nested_policy_id": "policy.id",
    "coverage_start": "policy.coverage.start_date", "coverage_end": "policy.coverage.end_date",
    "policy_id": "policy_id", "nested_first_name": "profile.first_name",
    "nested_last_name": "profile.last_name", "nested_email": "profile.email",
    "nested_city": "profile.address.city", "first_name": "first_name", "last_name": "last_name",
    "email": "email", "city": "city",
}
_ENVELOPE = ["event_id", "event_timestamp", "member_id", "event_category", "schema_version"]


def _leaves(payload: str = "payload") -> list:
    """Every field of a payload as a column; amounts as numbers, other text of theirs apart."""
    out = [
        F.array_join(f"{payload}.claim.diagnosis_codes", ",").alias("diagnosis_codes"),
        F.array_join(f"{payload}.payment.methods", ",").alias("methods"),
    ]
    for name, path in _LEAVES.items():
        value = F.col(f"{payload}.{path}")
        if name.endswith("amount"):
            number = value.try_cast("double")
            out += [number.alias(name), F.when(number.isNull(), value).alias(f"{name}_text")]
        else:
            out.append(value.alias(name))
    return out


# --- scans and sinks -------------------------------------------------------


@query
def csv_scan(spark, sf_dir):
    """CSV with an explicit schema keeps leading zeros of ids."""
    path = session.scratch_path(spark, "csv")
    table(spark, sf_dir, "customer").select(
        F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("member_id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    ).write.option("header", True).csv(path)
    schema = schemas.struct(
        member_id="string", name="string", nation="int", balance="double", segment="string"
    )
    return sources.read_csv(spark, path, schema)


@query
def csv_header_order(spark, sf_dir):
    """Two landings of one table: other column order, one column more, one less."""
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment",
        "CAST(c_nationkey AS STRING) AS nation",
    )
    landed = [
        ["segment", "c_custkey", "balance"],
        ["balance", "name", "nation", "c_custkey", "segment"],
    ]
    paths = [session.scratch_path(spark, "csv") for _ in landed]
    for number, (names, path) in enumerate(zip(landed, paths)):
        part = rows.where(F.col("c_custkey") % 2 == number).select(*names)
        part.write.option("header", True).csv(path)
    schema = schemas.struct(c_custkey="bigint", name="string", segment="string", balance="double")
    return sources.read_csv(spark, paths, schema, optional=["name"])


@query
def csv_mixed_folder(spark, sf_dir):
    """One folder with files of three headers, and a file without rows."""
    path = session.scratch_path(spark, "csv")
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment"
    )
    landed = [["c_custkey", "name", "balance"], ["balance", "c_custkey", "name", "segment"], ["NAME", "c_custkey"]]
    for number, names in enumerate(landed):
        part = rows.where(F.col("c_custkey") % 3 == number).select(*names)
        part.write.mode("append").option("header", True).csv(path)
    schema = schemas.struct(c_custkey="bigint", name="string", balance="double")
    return sources.read_csv(spark, path, schema, optional=["balance"], mixed_headers=True)


@query
def csv_malformed(spark, sf_dir):
    """Records that do not fit the schema are rejected, not read as nulls."""
    path = session.scratch_path(spark, "csv")
    key = F.col("o_orderkey")
    table(spark, sf_dir, "orders").select(
        key.cast("string").alias("claim_id"),
        F.when(key % 9 == 0, "n/a").otherwise(key.cast("string")).alias("amount"),
    ).write.option("header", True).csv(path)
    df = sources.read_csv(
        spark, path, schemas.struct(claim_id="string", amount="bigint"), keep_malformed=True
    )
    split = quality.split_by_rules(df, quality.readable(df))
    return split.rejected.select("claim_id", F.col(schemas.MALFORMED).alias("line"))


@query
def json_scan(spark, sf_dir):
    """Landed JSON documents to typed rows."""
    path = session.scratch_path(spark, "landing")
    I.envelopes(spark, sf_dir).write.text(path)
    return sources.read_events(spark, path).select(
        *_ENVELOPE, F.col("payload").isNotNull().alias("has_payload"), *_leaves()
    )


@query
def table_roundtrip(spark, sf_dir):
    """A Parquet table written twice holds the second version only."""
    path = session.scratch_path(spark, "table")
    orders = table(spark, sf_dir, "orders")
    sinks.write_table(orders.withColumn("version", F.lit(1)), path)
    sinks.write_table(orders.withColumn("version", F.lit(2)), path)
    return sources.read_table(spark, path)


@query
def partition_roundtrip(spark, sf_dir):
    """Dated partitions survive later runs; active rows of the newest date are
    read by pruning directories."""
    path = session.scratch_path(spark, "dimension")
    orders = table(spark, sf_dir, "orders")
    for day in (AS_OF - dt.timedelta(days=1), AS_OF):
        dated = orders.select(
            "*",
            F.lit(day).alias("processing_date"),
            member.active_flag("o_orderdate", dt.date(1998, 1, 1)).alias("active_flag"),
        )
        sinks.write_partitioned(dated, path, ["processing_date", "active_flag"])
    stored = sources.read_table(spark, path)
    newest = sources.latest_partition(stored, "processing_date")
    both = stored.groupBy("o_orderkey").agg(F.count("*").alias("dates"))
    return joins.hot_key_join(sources.active_members(newest), both, "o_orderkey", "inner")


@query
def claim_year_roundtrip(spark, sf_dir):
    """A table laid out by a derived year, each year's rows written together."""
    path = session.scratch_path(spark, "claims")
    dated = I.claims(spark, sf_dir).withColumn("claim_year", F.year("claim_date"))
    balanced = sinks.rebalance_for_write(dated, "claim_year")
    sinks.write_partitioned(balanced, path, ["claim_year"], replace="all")
    return sources.read_table(spark, path)


@query
def snapshot_roundtrip(spark, sf_dir):
    """A snapshot written twice for one date is stored once."""
    path = session.scratch_path(spark, "snapshot")
    rows = table(spark, sf_dir, "customer").withColumnRenamed("c_mktsegment", "state")
    balanced = sinks.rebalance_for_write(rows, "state")
    for day in (AS_OF - dt.timedelta(days=1), AS_OF, AS_OF):
        sinks.write_snapshot(balanced, path, day, ["state"])
    return sources.read_table(spark, path)


@query
def snapshot_append(spark, sf_dir):
    """Appending the same date twice keeps both copies."""
    path = session.scratch_path(spark, "snapshot")
    rows = table(spark, sf_dir, "customer").withColumnRenamed("c_mktsegment", "state")
    for _ in range(2):
        sinks.write_snapshot(rows, path, AS_OF, ["state"], idempotent=False)
    return sources.read_table(spark, path)


@query
def quarantine_roundtrip(spark, sf_dir):
    """Rejected member records, masked, in a table of their own."""
    path = session.scratch_path(spark, "quarantine")
    bad = M.build_member_dimension(
        I.historical(spark, sf_dir), I.migrated(spark, sf_dir), AS_OF, PROCESSED_AT
    ).rejected
    sinks.write_table(privacy.masked(bad, ["legacy_member_id"]), path)
    return sources.read_table(spark, path)


@query
def run_log(spark, sf_dir):
    """Counts observed while a table is written, as the log entry of the run."""
    log, out = session.scratch_path(spark, "log"), session.scratch_path(spark, "out")
    with runlog.logged_run(spark, "member_records", log) as run:
        checked = M.check_history(I.historical(spark, sf_dir))
        counts = sinks.write_counted(
            quality.distinct_rows(checked),
            lambda df: sinks.write_partitioned(df, out, ["is_valid"]),
            valid=F.count_if(F.col("is_valid")),
            bad=F.count_if(~F.col("is_valid")),
        )
        run.processed, run.failed = counts["valid"], counts["bad"]
    return sources.read_table(spark, log).select(
        "job_name", "records_processed", "records_failed", "status"
    )


# --- rules and splits ------------------------------------------------------


@query
def quarantine_split(spark, sf_dir):
    """Rows that break a range or a set rule, once each."""
    rules = [
        quality.Rule("balance", F.col("c_acctbal") >= 0),
        quality.one_of("c_mktsegment", ["BUILDING", "MACHINERY"]),
    ]
    return quality.split_by_rules(table(spark, sf_dir, "customer"), rules).rejected


@query
def rule_null_semantics(spark, sf_dir):
    """A rule that is null rejects; an open end passes."""
    n = F.col("c_nationkey")
    df = table(spark, sf_dir, "customer").select(
        "c_custkey", F.nullif(n, F.lit(3)).alias("a"), F.nullif(n % 7, F.lit(2)).alias("b")
    )
    return quality.split_by_rules(df, [quality.interval_in_order("b", "a")]).rejected


@query
def rule_reasons(spark, sf_dir):
    """How many records break each member rule."""
    broken = quality.broken_rules(M.member_rules()).alias("rule")
    rules = I.historical(spark, sf_dir).select(F.explode(broken).alias("rule"))
    return rules.groupBy("rule").agg(F.count("*").alias("records"))


@query
def member_rules_valid(spark, sf_dir):
    """Historical records that meet every rule."""
    return quality.split_by_rules(I.historical(spark, sf_dir), M.member_rules()).valid


@query
def member_rules_bad(spark, sf_dir):
    """Historical records that break a rule, once each."""
    return quality.split_by_rules(I.historical(spark, sf_dir), M.member_rules()).rejected


@query
def claims_valid(spark, sf_dir):
    """Distinct claims of known members within the amount range."""
    return _valid_claims(spark, sf_dir)


@query
def claims_bad(spark, sf_dir):
    """Distinct claims that fail any check."""
    checked = _checked_claims(spark, sf_dir)
    return quality.split_on_flag(checked, distinct_rejects=False).rejected


@query
def adjust_valid(spark, sf_dir):
    """Adjustments that add up and follow their claim."""
    return _valid_adjustments(spark, sf_dir)


@query
def adjust_bad(spark, sf_dir):
    """Adjustments whose id is on no valid adjustment."""
    return C.build_claims_fact(
        I.members_current(spark, sf_dir),
        I.claims(spark, sf_dir),
        I.adjustments(spark, sf_dir),
        PROCESSED_AT,
        staged=True,
    ).rejected_adjustments


@query
def revenue_clean(spark, sf_dir):
    """Premiums of zero or more."""
    return C.clean_revenue(I.revenue(spark, sf_dir), PROCESSED_AT)


@query
def revenue_rejected(spark, sf_dir):
    """Premiums that are negative or missing."""
    return C.rejected_revenue(I.revenue(spark, sf_dir))


@query
def violations_clean(spark, sf_dir):
    """Distinct violations."""
    return C.clean_violations(I.violations(spark, sf_dir), PROCESSED_AT)


# --- projections and scalar functions --------------------------------------


@query
def audit_project(spark, sf_dir):
    """Fixed columns, constants added, personal data dropped."""
    migrated = privacy.drop_phi(I.migrated(spark, sf_dir))
    return M.with_audit(migrated, PROCESSED_AT)


@query
def fill_zero(spark, sf_dir):
    """Missing counts and sums become zero, other columns stay null."""
    n = F.col("c_nationkey")
    df = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(n % 3 != 0, F.col("c_acctbal")).alias("balance"),
        F.when(n % 5 != 0, n).alias("nation"),
        F.when(n % 2 != 0, n).alias("kept_null"),
    )
    return A.fill_zero(df, ["balance", "nation"])


@query
def mask_keys(spark, sf_dir):
    """SHA-256 of text, plain and salted; null stays null."""
    return I.migrated(spark, sf_dir).select(
        "legacy_member_id",
        privacy.hashed("ssn_raw").alias("masked_ssn"),
        privacy.hashed("member_id").alias("member_key"),
        privacy.hashed("member_id", "pepper").alias("salted_key"),
    )


@query
def age_band(spark, sf_dir):
    """Age by calendar year, and its band."""
    age = member.age("birth_year", AS_OF)
    return I.historical(spark, sf_dir).select(
        "policy_id", age.alias("age"), member.band(age).alias("age_band")
    )


@query
def active_flag(spark, sf_dir):
    """Coverage that is open or ends after the day is active."""
    flag = member.active_flag("coverage_end_date", AS_OF)
    return I.historical(spark, sf_dir).select("policy_id", flag.alias("active_flag"))


@query
def tenure(spark, sf_dir):
    """Days since enrollment."""
    days = member.tenure_days("enrollment_date", AS_OF)
    return I.historical(spark, sf_dir).select("policy_id", days.alias("tenure_days"))


@query
def claim_year(spark, sf_dir):
    """Year of the claim date."""
    return I.claims(spark, sf_dir).select("claim_id", F.year("claim_date").alias("claim_year"))


@query
def amount_cast(spark, sf_dir):
    """Amounts as text to double; text that is no number becomes null."""
    events = _events(spark, sf_dir)
    amount = money.amount_from_text(F.col("payload.claim_amount"))
    return E.route(events, E.CLAIMS, "v1").select("event_id", amount.alias("claim_amount"))


@query
def settled_amounts(spark, sf_dir):
    """The adjusted amount, else the claimed amount."""
    fact = _fact(spark, sf_dir).drop("final_claim_amount")
    final = money.settled_amount("claim_amount", "adjusted_final_amount")
    return fact.select("claim_id", "adjustment_id", final.alias("final_claim_amount"))


# --- joins, latest version, set operations ---------------------------------


@query
def member_latest(spark, sf_dir):
    """Newest valid record per member; ties settled by the other columns."""
    valid = quality.split_by_rules(I.historical(spark, sf_dir), M.member_rules()).valid
    return M.latest_members(valid)


@query
def member_latest_incremental(spark, sf_dir):
    """The newest valid record per member, merged day by day, with late and corrected rows.

    The second half of the days comes first, then the first half, late; then records
    that correct those of the second day, and then the second day as it was.
    """
    valid = quality.split_by_rules(I.historical(spark, sf_dir), M.member_rules()).valid
    late = F.dayofmonth("effective_date") <= 15
    kept = incremental.NewestRows(
        spark, session.scratch_path(spark, "newest"), valid.schema, ["legacy_member_id"],
        ["effective_date", "record_updated_ts"], buckets=8,
    )
    wrong = valid.where(late).withColumn("record_updated_ts", F.lit(None).cast("date"))
    for day, rows in enumerate((valid.where(~late), wrong, valid.where(late & F.col("record_updated_ts").isNotNull()), valid.where(late))):
        kept.merge(rows, day)
    return kept.read()


@query
def latest_order(spark, sf_dir):
    """Newest order per customer, ties settled by the order key."""
    orders = table(spark, sf_dir, "orders")
    return latest.latest_per_key(orders, ["o_custkey"], ["o_orderdate"], ["o_orderkey"])


@query
def join_inner_latest(spark, sf_dir):
    """Newest record per member with its migrated identity."""
    valid = quality.split_by_rules(I.historical(spark, sf_dir), M.member_rules()).valid
    joined = joins.join_migrated(M.latest_members(valid), I.migrated(spark, sf_dir))
    return joined.select("legacy_member_id", "member_id", "policy_id", "migration_flag")


@query
def require_parent(spark, sf_dir):
    """Claims of known members, each once though members are listed twice."""
    return joins.require_parent(
        I.claims(spark, sf_dir), I.members_current(spark, sf_dir), "member_id"
    )


@query
def adjust_with_claim(spark, sf_dir):
    """Adjustments with the date of their claim, copies of claims dropped."""
    claims = quality.distinct_rows(I.claims(spark, sf_dir))
    return joins.adjust_with_claim(I.adjustments(spark, sf_dir), claims)


@query
def without_match(spark, sf_dir):
    """Adjustments of no known claim."""
    known = I.claims(spark, sf_dir).filter(F.col("claim_amount") > 100000)
    return joins.without_match(I.adjustments(spark, sf_dir), known, "claim_id")


@query
def claims_with_adjustments(spark, sf_dir):
    """Distinct claims with their adjustments, by claim and member."""
    claims = quality.distinct_rows(I.claims(spark, sf_dir))
    return joins.claims_with_adjustments(claims, I.adjustments(spark, sf_dir))


@query
def unused_adjustments(spark, sf_dir):
    """Valid adjustments that name another member than their claim."""
    folder = session.scratch_path(spark, "claims")
    checked, _ = sinks.stage(_checked_claims(spark, sf_dir), f"{folder}/checked", ["is_valid"])
    valid = quality.split_on_flag(checked, distinct_rejects=False).valid
    return C.reconcile(valid, I.adjustments(spark, sf_dir), folder).unused


@query
def dedup_exact(spark, sf_dir):
    """Lineitems delivered twice, once each."""
    lines = table(spark, sf_dir, "lineitem")
    return quality.distinct_rows(lines.unionAll(lines))


@query
def distinct_row_count(spark, sf_dir):
    """Distinct rows of a table with copies, nulls told apart by their place."""
    h = I.historical(spark, sf_dir)
    return quality.distinct_row_count(h.unionAll(h))


@query
def join_mixed_types(spark, sf_dir):
    """Orders of customers by a key that is int on one side and bigint on the other."""
    customer = table(spark, sf_dir, "customer").withColumn("key", F.col("c_custkey").cast("int"))
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "key")
    return joins.hot_key_join(orders, customer, "key", "inner")


@query
def json_array_text(spark, sf_dir):
    """Events of texts that hold an array of a day's events each."""
    by_day = (
        I.envelopes(spark, sf_dir)
        .groupBy(F.substring(F.get_json_object("doc", "$.event_timestamp"), 1, 10).alias("day"))
        .agg(F.concat(F.lit("["), F.array_join(F.collect_list("doc"), ","), F.lit("]")).alias("doc"))
    )
    events = sources.parse_events(by_day, "doc")
    return events.select(*_ENVELOPE, *_leaves())


@query
def union_by_name(spark, sf_dir):
    """Two shapes of one table, matched by column name."""
    customer = table(spark, sf_dir, "customer")
    old = customer.drop("c_acctbal")
    return quality.union_by_name(customer, old.select(*reversed(old.columns)))


@query
def except_distinct(spark, sf_dir):
    """Distinct rows of one table that another lacks, nulls equal."""
    claims = I.claims(spark, sf_dir)
    late = claims.filter(F.col("claim_date") >= F.lit(dt.date(1998, 1, 1)))
    return quality.except_distinct(claims, late)


# --- aggregates ------------------------------------------------------------


def _aggregate(name: str, fact: Query, measures: list[A.Measure], doc: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return A.aggregate_fact(fact(spark, sf_dir), "member_id", measures)

    run.__name__, run.__doc__ = name, doc
    query(run)


def _valid_events(domain: E.Domain) -> Query:
    return lambda spark, sf_dir: E.split_domain(_events(spark, sf_dir), domain).valid


_aggregate("agg_claims", _fact, A.CLAIM_MEASURES, "Claim amount and number per member.")
_aggregate(
    "agg_revenue",
    lambda spark, sf_dir: C.clean_revenue(I.revenue(spark, sf_dir), PROCESSED_AT),
    A.REVENUE_MEASURES,
    "Revenue per member.",
)
_aggregate(
    "agg_violations",
    lambda spark, sf_dir: C.clean_violations(I.violations(spark, sf_dir), PROCESSED_AT),
    A.VIOLATION_MEASURES,
    "Violations per member.",
)
for _domain, _measures in (
    (E.CLAIMS, A.CLAIM_EVENT_MEASURES),
    (E.BILLING, A.BILLING_EVENT_MEASURES),
    (E.POLICY, A.POLICY_EVENT_MEASURES),
    (E.MEMBER, A.MEMBER_EVENT_MEASURES),
):
    _aggregate(
        f"agg_{_domain.category.lower()}_events",
        _valid_events(_domain),
        _measures,
        "Valid event rows per member.",
    )


@query
def agg_all_facts(spark, sf_dir):
    """All measures of all facts, by one shuffle."""
    return A.fill_zero(G.member_activity(_facts(spark, sf_dir)), K.ZERO_FILLED)


@query
def agg_incremental(spark, sf_dir):
    """All measures of all facts, loaded on three days of which one is replaced."""
    facts = _facts(spark, sf_dir)
    given = G.activity_facts(facts)
    sums = incremental.PartialSums(
        spark, session.scratch_path(spark, "partials"), "member_id", "string",
        [m for _, measures in given for m in measures],
    )
    share = F.coalesce(F.pmod(F.xxhash64("member_id"), F.lit(3)), F.lit(0))
    folder = session.scratch_path(spark, "shares")
    # Four loads read parts of the facts, so these are computed once and laid out by part.
    parts = [
        (
            sinks.stage(
                df.select("member_id", *{m.source: None for m in measures}, share.alias("share")),
                f"{folder}/{n}", ["share"],
            )[0],
            measures,
        )
        for n, (df, measures) in enumerate(given)
    ]
    day = lambda n: [(df.where(F.col("share") == n), m) for df, m in parts]
    sums.load(day(0) + day(1), "2001-07-30")
    sums.load(day(1), "2001-07-31")
    sums.load(day(0), "2001-07-30")
    sums.load(day(2), "2001-08-01")
    return A.fill_zero(sums.read(), K.ZERO_FILLED)


@query
def agg_domain_tables(spark, sf_dir):
    """All measures, from one table per event domain, each event counted once."""
    events = _events(spark, sf_dir)
    tables = {d.category: E.split_domain(events, d).valid for d in E.DOMAINS}
    facts = _facts(spark, sf_dir)._replace(events=G.domain_events(tables))
    return A.fill_zero(G.member_activity(facts, count_events_once=True), K.ZERO_FILLED)


@query
def agg_distinct_events(spark, sf_dir):
    """Events per member, each counted once however many rows it gave."""
    rows = _valid_events(E.CLAIMS)(spark, sf_dir)
    return A.aggregate_fact(A.distinct_events(rows), "member_id", A.CLAIM_EVENT_MEASURES[:1])


@query
def join_aggregates(spark, sf_dir):
    """Members with several aggregates, joined once."""
    facts = _facts(spark, sf_dir)
    aggregates = [
        A.aggregate_fact(facts.claims, "member_id", A.CLAIM_MEASURES),
        A.aggregate_fact(facts.revenue, "member_id", A.REVENUE_MEASURES),
        A.aggregate_fact(facts.violations, "member_id", A.VIOLATION_MEASURES),
    ]
    return joins.join_aggregates(I.members_current(spark, sf_dir), aggregates, "member_id")


@query
def dq_metrics(spark, sf_dir):
    """Rows per event domain and outcome, bad rows once each."""
    return E.outcome_counts(E.normalize_all(_events(spark, sf_dir)))


# --- events ----------------------------------------------------------------


@query
def events_envelope_valid(spark, sf_dir):
    """Events with id, member and payload."""
    return E.validate_events(_events(spark, sf_dir)).select(*_ENVELOPE, *_leaves())


@query
def events_rejected(spark, sf_dir):
    """Events that enter no domain, with the reason and what their text holds."""
    rejected = E.rejected_events(E.normalize_all(_events(spark, sf_dir)))
    return rejected.withColumn("raw", F.from_json("raw_event", schemas.EVENT)).select(
        *_ENVELOPE[:3], "reject_reason", "raw.event_category", "raw.schema_version",
        *_leaves("raw.payload"),
    )


@query
def event_unknown_paths(spark, sf_dir):
    """Payload fields that no domain reads, in a feed to which producers have added some."""
    doc, event = F.col("doc"), F.get_json_object("doc", "$.event_id")
    added = F.when(F.substring(event, -1, 1).isin("3", "4"), F.lit('"payload":{"channel":{"kind":"web","tags":["a","b"]},')).otherwise(
        F.when(F.substring(event, -1, 1) == "5", F.lit('"payload":{"score":7,')).otherwise(F.lit('"payload":{'))
    )
    empty = doc.contains('"payload":{}')
    changed = F.when(empty, doc).otherwise(F.replace(doc, F.lit('"payload":{'), added))
    feed = I.envelopes(spark, sf_dir).select(changed.alias("doc"))
    return drift.unknown_paths(feed, session.scratch_path(spark, "paths"))


@query
def events_routed(spark, sf_dir):
    """Events of one category and version."""
    return E.route(E.validate_events(_events(spark, sf_dir)), E.MEMBER, "v2").select(
        "event_id", "member_id", F.col("payload.profile.address.city").alias("city")
    )


def _event_queries(domain: E.Domain) -> None:
    name = f"events_{domain.category.lower()}"

    def rows(spark, sf_dir):
        return E.normalize(_events(spark, sf_dir), domain)

    def valid(spark, sf_dir):
        return E.split_domain(_events(spark, sf_dir), domain).valid

    def bad(spark, sf_dir):
        return E.split_domain(_events(spark, sf_dir), domain).rejected

    for function, suffix in ((rows, ""), (valid, "_valid"), (bad, "_bad")):
        function.__name__ = name + suffix
        query(function)


for _domain in E.DOMAINS:
    _event_queries(_domain)


@query
def events_keep_empty(spark, sf_dir):
    """Claim events, those with an empty array kept with a null code."""
    return E.normalize(_events(spark, sf_dir), E.CLAIMS, keep_empty=True)


@query
def events_stream(spark, sf_dir):
    """The claims domain, ingested as a stream."""
    wide = _streamed(spark, sf_dir, streaming.ingest_events)
    return E.valid_rows(wide, E.CLAIMS)


@query
def events_dedup_stream(spark, sf_dir):
    """The billing domain of a feed that comes in four deliveries, each event once.

    The first has the later half of the days, the second the whole feed, so most of
    its events are late by weeks, and the third and fourth the whole feed again, with
    other times and without any.
    """
    wide = _streamed(spark, sf_dir, streaming.ingest_once, _deliveries(spark, sf_dir))
    return E.valid_rows(wide, E.BILLING)


def _deliveries(spark, sf_dir) -> list[DataFrame]:
    feed, _ = sinks.stage(I.envelopes(spark, sf_dir), session.scratch_path(spark, "feed"))
    moment = F.get_json_object("doc", "$.event_timestamp")
    late_half = feed.where(F.dayofmonth(F.to_date(F.substring(moment, 1, 10))) > 15)
    stamp = F.lit('"event_timestamp":"[^"]*",')
    moved = feed.select(F.regexp_replace("doc", stamp, F.lit('"event_timestamp":"2031-05-06 07:08:09",')).alias("doc"))
    timeless = feed.select(F.regexp_replace("doc", stamp, F.lit("")).alias("doc"))
    return [late_half, feed, moved, timeless]


def _streamed(spark, sf_dir, ingest, deliveries=None) -> DataFrame:
    landing = session.scratch_path(spark, "landing")
    out, progress = session.scratch_path(spark, "events"), session.scratch_path(spark, "progress")
    for delivery in deliveries or [I.envelopes(spark, sf_dir)]:
        delivery.write.mode("append").text(landing, compression=LANDED)
        ingest(streaming.events_stream(spark, landing), out, progress).awaitTermination()
    return sources.read_table(spark, out)


# --- composites ------------------------------------------------------------


@query
def member_dimension(spark, sf_dir):
    """The member dimension."""
    return _dimension(spark, sf_dir)


@query
def claims_fact(spark, sf_dir):
    """The claims fact table."""
    return _fact(spark, sf_dir)


@query
def claims_fact_latest(spark, sf_dir):
    """The claims fact table with the newest adjustment of each claim only."""
    return _fact(spark, sf_dir, latest_only=True)


@query
def risk_churn(spark, sf_dir):
    """Risk, churn and value of customers, with other thresholds."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("member"), F.col("o_totalprice").alias("amount")
    )
    errors = table(spark, sf_dir, "events").filter(F.col("event_type") == "error")
    activity = A.aggregate_facts(
        [
            (orders, [A.Measure("claims", "amount", "money")]),
            (
                errors.select(F.col("user_id").alias("member"), "event_id"),
                [A.Measure("violations", "event_id", "count")],
            ),
        ],
        "member",
    )
    customer = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "member")
    members = A.fill_zero(
        joins.join_aggregates(customer, [activity], "member"), ["claims", "violations"]
    )
    return members.select(
        "member",
        scoring.risk_tier("violations", "claims", 12, 4000000).alias("risk_tier"),
        scoring.churn_flag("violations").alias("churn_flag"),
        scoring.lifetime_value("c_acctbal", "claims").alias("lifetime_value"),
        F.round(scoring.engagement("violations"), 6).alias("engagement_score"),
    )


@query
def member_360(spark, sf_dir):
    """The gold table, from raw inputs to scores."""
    gold = G.build_member_360(
        _dimension(spark, sf_dir), _facts(spark, sf_dir), AS_OF, PROCESSED_AT
    )
    return _gold_columns(gold)


def _gold_columns(gold: DataFrame) -> DataFrame:
    return gold.withColumn("engagement_score", F.round("engagement_score", 6))


#: Codec of landed text, and most rows of a file of it, as a task reads a file whole.
LANDED, LANDED_ROWS = "snappy", 200_000


def land_raw(spark: SparkSession, sf_dir: str, layout: jobs.Layout, events: bool = True) -> None:
    """Write the raw tables as producers deliver them, CSV and JSON, compressed."""

    def land(name: str, build: Callable[[SparkSession, str], DataFrame]) -> None:
        writer = build(spark, sf_dir).write.option("maxRecordsPerFile", LANDED_ROWS)
        writer.option("header", True).csv(layout.raw(name), compression=LANDED)

    def land_events() -> None:
        writer = I.envelopes(spark, sf_dir).write.option("maxRecordsPerFile", LANDED_ROWS)
        writer.text(layout.raw("events"), compression=LANDED)

    tables = (
        ("claims_adjustments", I.adjustments),
        ("historical_member_policy", I.historical),
        ("migrated_members", I.migrated),
        ("members_current", I.members_current),
        ("claims", I.claims),
        ("revenue", I.revenue),
        ("violations", I.violations),
    )
    sinks.write_together(*[partial(land, *named) for named in tables], *[land_events] * events)


@query
def member_360_from_files(spark, sf_dir):
    """The gold snapshot after all runs, from landed CSV and JSON files."""
    layout = jobs.Layout(session.scratch_path(spark, "lake"))
    land_raw(spark, sf_dir, layout)
    jobs.run_all(spark, layout, AS_OF, PROCESSED_AT)
    return _gold_columns(sources.read_table(spark, layout.gold("member_360")))


@query
def member_360_from_stream(spark, sf_dir):
    """The gold snapshot where the events come as a stream of four deliveries."""
    layout = jobs.Layout(session.scratch_path(spark, "lake"))
    land_raw(spark, sf_dir, layout, events=False)
    for delivery in _deliveries(spark, sf_dir):
        delivery.write.mode("append").text(layout.raw("events"), compression=LANDED)
        stream.stream_events(spark, layout, fan=3)
    jobs.run_members(spark, layout, AS_OF, PROCESSED_AT)
    jobs.run_claims(spark, layout, PROCESSED_AT)
    jobs.run_gold(spark, layout, AS_OF, PROCESSED_AT)
    return _gold_columns(sources.read_table(spark, layout.gold("member_360")))


@query
def gold_backfill(spark, sf_dir):
    """The gold table of three dates from two versions of the dimension, by one plan."""
    older = M.build_member_dimension(
        I.historical(spark, sf_dir), I.migrated(spark, sf_dir), dt.date(1998, 1, 1), PROCESSED_AT
    ).valid
    versions = older.unionByName(_dimension(spark, sf_dir))
    days = [dt.date(1990, 1, 1), dt.date(1998, 1, 1), dt.date(2000, 5, 5), AS_OF]
    return _gold_columns(G.backfill_member_360(versions, _facts(spark, sf_dir), days, PROCESSED_AT))


@query
def run_balance(spark, sf_dir):
    """What the member and claims runs compare: rows read against rows that came out."""
    layout = jobs.Layout(session.scratch_path(spark, "lake"))
    land_raw(spark, sf_dir, layout, events=False)
    jobs.run_members(spark, layout, AS_OF, PROCESSED_AT)
    jobs.run_claims(spark, layout, PROCESSED_AT)
    return sources.read_table(spark, layout.run_balance).drop("run_id")


@query
def snapshot_clustered(spark, sf_dir):
    """A snapshot whose rows lie in ranges of the key, looked up by a few of its keys."""
    path = session.scratch_path(spark, "snapshot")
    rows = table(spark, sf_dir, "customer").withColumnRenamed("c_mktsegment", "state")
    sinks.write_snapshot(sinks.cluster_for_write(rows, "c_custkey", ["state"], 20), path, AS_OF, ["state"])
    return sources.read_table(spark, path).where(F.col("c_custkey").between(100, 220))


@query
def run_log_of_all_runs(spark, sf_dir):
    """What each run reports to the log."""
    layout = jobs.Layout(session.scratch_path(spark, "lake"))
    land_raw(spark, sf_dir, layout)
    jobs.run_all(spark, layout, AS_OF, PROCESSED_AT)
    return sources.read_table(spark, layout.run_log).select(
        "job_name", "records_processed", "records_failed", "status"
    )
