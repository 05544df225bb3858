"""Explicit schemas of every raw table, so no read has to infer one.

Ids stay strings (leading zeros matter and hashing needs text); money arrives as
double; event amounts arrive as text because producers send both JSON numbers
and JSON strings.
"""

from __future__ import annotations

from pyspark.sql import types as T

#: Column that receives the raw text of a record that does not fit its schema.
MALFORMED = "_malformed"

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "strings": T.ArrayType(T.StringType()),
}


def struct(**fields: str | T.DataType) -> T.StructType:
    """A nullable struct from ``name="type"`` pairs."""
    return T.StructType(
        [
            T.StructField(name, _TYPES[kind] if isinstance(kind, str) else kind)
            for name, kind in fields.items()
        ]
    )


HISTORICAL_MEMBER_POLICY = struct(
    legacy_member_id="string",
    effective_date="date",
    record_updated_ts="timestamp",
    birth_year="int",
    gender="string",
    coverage_start_date="date",
    coverage_end_date="date",
    policy_id="string",
    policy_type="string",
    state="string",
    enrollment_date="date",
    member_segment="string",
)

MIGRATED_MEMBERS = struct(
    legacy_member_id="string",
    member_id="string",
    ssn_raw="string",
    patient_first_name="string",
    patient_last_name="string",
    email="string",
    phone_number="string",
    address_line="string",
    city="string",
    zip_code="string",
    migration_flag="string",
)

MEMBERS_CURRENT = struct(member_id="string")

CLAIMS = struct(
    claim_id="string",
    member_id="string",
    claim_date="date",
    claim_amount="double",
)

CLAIMS_ADJUSTMENTS = struct(
    adjustment_id="string",
    claim_id="string",
    member_id="string",
    original_claim_amount="double",
    adjustment_amount="double",
    adjusted_final_amount="double",
    adjustment_date="date",
)

REVENUE = struct(member_id="string", premium_collected="double")

VIOLATIONS = struct(violation_id="string", member_id="string")

#: Union of every payload shape of every category and schema version.
EVENT_PAYLOAD = struct(
    claim=struct(id="string", amount="string", diagnosis_codes="strings"),
    provider=struct(id="string"),
    claim_id="string",
    claim_amount="string",
    provider_id="string",
    payment=struct(amount="string", methods="strings"),
    payment_amount="string",
    policy=struct(id="string", coverage=struct(start_date="string", end_date="string")),
    policy_id="string",
    profile=struct(
        first_name="string",
        last_name="string",
        email="string",
        address=struct(city="string"),
    ),
    first_name="string",
    last_name="string",
    email="string",
    city="string",
)

EVENT = struct(
    event_id="string",
    event_timestamp="string",
    member_id="string",
    event_category="string",
    schema_version="string",
    payload=EVENT_PAYLOAD,
)

#: Silver tables that are laid out by a column, as readers need them. With the
#: schema given, a table without rows (and so without directories) still reads.
MEMBER_DIMENSION = struct(
    member_key="string",
    member_id="string",
    legacy_member_id="string",
    age_band="string",
    gender="string",
    state="string",
    enrollment_date="date",
    policy_id="string",
    policy_type="string",
    coverage_start_date="date",
    coverage_end_date="date",
    member_segment="string",
    active_flag="string",
    migration_flag="string",
    masked_ssn="string",
    processing_timestamp="timestamp",
    record_status="string",
    dq_flag="string",
    processing_date="date",
)

CLAIMS_FACT_AMOUNTS = struct(
    claim_id="string", member_id="string", final_claim_amount="double", claim_year="int"
)

EVENT_ROWS = struct(
    event_id="string",
    event_timestamp="string",
    member_id="string",
    claim_id="string",
    claim_amount="double",
    provider_id="string",
    diagnosis_code="string",
    payment_amount="double",
    payment_method="string",
    policy_id="string",
    start_date="string",
    end_date="string",
    first_name="string",
    last_name="string",
    email="string",
    city="string",
    reject_reason="string",
    raw_event="string",
    outcome="string",
    domain="string",
)

RUN_LOG = struct(
    run_id="string",
    job_name="string",
    records_processed="bigint",
    records_failed="bigint",
    start_time="timestamp",
    end_time="timestamp",
    status="string",
)

RUN_BALANCE = struct(
    run_id="string", job_name="string", equation="string", left_rows="bigint", right_rows="bigint"
)


def with_malformed(schema: T.StructType) -> T.StructType:
    """``schema`` plus the column that keeps unreadable records."""
    return T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
