"""Raw tables of the engine, derived by Spark from the driver's test tables.

Orders play member versions and claims, customers play migrated and current
members, lineitems play adjustments, events play the event feed. Every binding
keeps all rows of its table; the arithmetic on ids only spreads the edge cases
(nulls, bad intervals, unknown versions, empty arrays) over the rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, types as T

AS_OF = dt.date(2001, 8, 1)
PROCESSED_AT = dt.datetime(2001, 8, 1, 12, 0, 0)


_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its footer is read for the schema once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def historical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as versions of the member's policy record."""
    day = "CAST(o_orderdate AS DATE)"
    return table(spark, sf_dir, "orders").selectExpr(
        "CASE WHEN o_orderkey % 31 <> 0 THEN concat('L', o_custkey) END AS legacy_member_id",
        f"CASE WHEN o_orderkey % 37 <> 0 THEN {day} END AS effective_date",
        f"CASE WHEN o_orderkey % 5 <> 0 THEN date_add({day}, 1) END AS record_updated_ts",
        "CASE WHEN o_orderkey % 13 <> 0 THEN CAST(1890 + o_orderkey % 150 AS INT) END AS birth_year",
        """CASE WHEN o_orderstatus = 'F' THEN 'F' WHEN o_orderstatus = 'O' THEN 'M'
                WHEN o_orderkey % 3 = 0 THEN 'X' WHEN o_orderkey % 3 = 1 THEN 'M' END AS gender""",
        f"CASE WHEN o_orderkey % 17 <> 0 THEN {day} END AS coverage_start_date",
        f"""CASE o_orderkey % 4 WHEN 1 THEN date_sub({day}, 10) WHEN 2 THEN date_add({day}, 400)
                 WHEN 3 THEN date_add({day}, 4000) END AS coverage_end_date""",
        "concat('P', o_orderkey) AS policy_id",
        "o_orderpriority AS policy_type",
        "concat('S', o_custkey % 25) AS state",
        f"date_sub({day}, 30) AS enrollment_date",
        "o_orderstatus AS member_segment",
    )


def migrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as migrated members; every 40th is listed twice and every 9th has
    a legacy id that no other table knows."""
    listed = table(spark, sf_dir, "customer").selectExpr(
        "*", "explode(sequence(1, IF(c_custkey % 40 = 0, 2, 1))) AS copy"
    )
    return listed.selectExpr(
        "concat(IF(c_custkey % 9 <> 0, 'L', 'X'), c_custkey) AS legacy_member_id",
        "concat('M', c_custkey) AS member_id",
        "CASE WHEN c_custkey % 7 <> 0 THEN c_name END AS ssn_raw",
        "c_mktsegment AS patient_first_name",
        "c_name AS patient_last_name",
        "concat('mail', c_custkey) AS email",
        "concat('555', c_custkey) AS phone_number",
        "concat('street ', c_nationkey) AS address_line",
        "concat('city ', c_nationkey) AS city",
        "lpad(CAST(c_nationkey AS STRING), 5, '0') AS zip_code",
        "concat('wave', copy) AS migration_flag",
    )


def members_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, some listed twice, and those of one segment under an id that no
    claim has."""
    listed = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "IF(c_mktsegment <> 'BUILDING', 'M', 'X') AS kind",
        "explode(sequence(1, IF(c_custkey % 10 = 0, 2, 1))) AS copy",
    )
    return listed.selectExpr("concat(kind, c_custkey) AS member_id")


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as claims."""
    return table(spark, sf_dir, "orders").selectExpr(
        "CASE WHEN o_orderkey % 41 <> 0 THEN concat('C', o_orderkey) END AS claim_id",
        "concat('M', o_custkey) AS member_id",
        "CASE WHEN o_orderkey % 43 <> 0 THEN CAST(o_orderdate AS DATE) END AS claim_date",
        """CASE WHEN o_orderkey % 29 = 0 THEN -0.01D WHEN o_orderkey % 23 = 0 THEN 75000D
                WHEN o_orderkey % 19 <> 0 THEN o_totalprice END AS claim_amount""",
    )


def adjustments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitems as adjustments of their order's claim. Copies of an order are
    dropped first, so that they do not multiply its lineitems."""
    lines = table(spark, sf_dir, "lineitem")
    owner = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").distinct()
    joined = lines.join(owner, lines.l_orderkey == owner.o_orderkey)
    return joined.selectExpr(
        "CASE WHEN l_linenumber <> 6 THEN concat('A', l_orderkey * 10 + l_linenumber) END AS adjustment_id",
        "concat('C', l_orderkey) AS claim_id",
        "CASE WHEN l_linenumber = 3 THEN 'M-other' ELSE concat('M', o_custkey) END AS member_id",
        "l_extendedprice AS original_claim_amount",
        "l_quantity AS adjustment_amount",
        """CASE WHEN l_linenumber = 7 THEN l_extendedprice
                ELSE l_extendedprice + l_quantity END AS adjusted_final_amount""",
        "CAST(l_shipdate AS DATE) AS adjustment_date",
    )


def revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals as premiums, some negative or missing."""
    return table(spark, sf_dir, "orders").selectExpr(
        "concat('M', o_custkey) AS member_id",
        """CASE WHEN o_orderkey % 7 = 0 THEN -o_totalprice
                WHEN o_orderkey % 11 <> 0 THEN o_totalprice END AS premium_collected""",
    )


def violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as violations, errors reported twice."""
    reported = table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id", "explode(sequence(1, IF(event_type = 'error', 2, 1))) AS copy"
    )
    return reported.selectExpr(
        "concat('V', event_id) AS violation_id", "concat('M', user_id) AS member_id"
    )


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event feed as producers send it: one JSON document per row (``doc``).

    Even events use the nested shape v2, odd ones the flat v1, some an unknown
    version; arrays hold zero to two elements; some fields are missing, amounts
    are numbers, and some are text or not positive.
    """
    fields = table(spark, sf_dir, "events").selectExpr(
        "event_id AS id",
        "user_id",
        "event_type AS kind",
        "event_id % 2 = 0 AS nested",
        "CAST(ts AS STRING) AS moment",
        "CAST(value AS STRING) AS value",
        "CAST(get_json_object(props, '$.k') AS INT) AS k",
    ).selectExpr(
        "*",
        "CASE WHEN k % 20 = 4 THEN 'abc' WHEN k % 20 = 6 THEN '-1.5' WHEN k % 20 = 8 THEN '0' ELSE value END AS amount",
        "CASE WHEN k % 11 <> 0 THEN concat('C', id) END AS claim",
        "CASE WHEN k % 13 <> 0 THEN concat('P', k) END AS provider",
        "CASE WHEN k % 7 <> 0 THEN concat('P', id) END AS policy",
        "CASE WHEN k % 17 <> 0 THEN concat('F', k) END AS given",
        "CASE WHEN k % 19 <> 0 THEN concat('G', k) END AS family",
        "concat('mail', user_id) AS mail",
        "concat('city', k) AS city",
    )
    nested = {
        "purchase": {
            "claim": "struct(claim AS id, amount, slice(array('D0', 'D1'), 1, k % 3) AS diagnosis_codes)",
            "provider": "struct(provider AS id)",
        },
        "click": {
            "payment": "struct(amount, slice(array('CARD', 'BANK'), 1, k % 3) AS methods)",
        },
        "view": {
            "policy": """struct(policy AS id, struct(substr(moment, 1, 10) AS start_date,
                                '2030-01-01' AS end_date) AS coverage)""",
        },
        "signup": {
            "profile": """struct(given AS first_name, family AS last_name, mail AS email,
                                 struct(city) AS address)""",
        },
    }
    flat = {
        "purchase": {"claim_id": "claim", "claim_amount": "amount", "provider_id": "provider"},
        "click": {"payment_amount": "amount"},
        "view": {"policy_id": "policy"},
        "signup": {"first_name": "given", "last_name": "family", "email": "mail", "city": "city"},
    }
    payload = ", ".join(
        f"IF(kind = '{kind}' AND {shape}, {value}, NULL) AS {name}"
        for shape, kinds in (("nested", nested), ("NOT nested", flat))
        for kind, members in kinds.items()
        for name, value in members.items()
    )
    return fields.selectExpr(
        f"""to_json(struct(
            IF(id % 107 <> 0, concat('E', id), NULL) AS event_id,
            moment AS event_timestamp,
            IF(id % 101 <> 0, concat('M', user_id), NULL) AS member_id,
            CASE kind WHEN 'purchase' THEN 'CLAIMS' WHEN 'click' THEN 'BILLING'
                 WHEN 'view' THEN 'POLICY' WHEN 'signup' THEN 'MEMBER' ELSE 'OTHER' END AS event_category,
            CASE WHEN id % 50 = 49 THEN 'v3' WHEN nested THEN 'v2' ELSE 'v1' END AS schema_version,
            IF(id % 103 <> 0, struct({payload}), NULL) AS payload)) AS doc"""
    )
