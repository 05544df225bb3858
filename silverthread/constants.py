"""Values the results depend on.

Fixed values: names, labels, thresholds and column lists below are part of the
data contract and must stay exactly as they are for results to be comparable.
"""

# Member quality rules
GENDERS = ["M", "F"]
BIRTH_YEAR_RANGE = (1900, 2025)

# Age bands (inclusive bounds) and the label of everything else
AGE_BANDS = [
    (18, 24, "18-24"),
    (25, 34, "25-34"),
    (35, 44, "35-44"),
    (45, 54, "45-54"),
]
OTHER_AGE_BAND = "55+"

# Status labels
ACTIVE = "Active"
TERMINATED = "Terminated"
RECORD_STATUS = "ACTIVE"
DQ_VALID = "VALID"
SUCCESS = "SUCCESS"
FAILED = "FAILED"

# Columns holding personal data
PHI_COLUMNS = [
    "patient_first_name",
    "patient_last_name",
    "email",
    "phone_number",
    "address_line",
    "city",
    "zip_code",
    "ssn_raw",
]

# Member dimension columns
DIMENSION_COLUMNS = [
    "member_key",
    "member_id",
    "legacy_member_id",
    "age_band",
    "gender",
    "state",
    "enrollment_date",
    "policy_id",
    "policy_type",
    "coverage_start_date",
    "coverage_end_date",
    "member_segment",
    "active_flag",
    "migration_flag",
    "masked_ssn",
    "processing_timestamp",
    "record_status",
    "dq_flag",
    "processing_date",
]

# Accepted claim amounts
CLAIM_AMOUNT_RANGE = (0, 75000)

# Gold thresholds and labels
HIGH_RISK_VIOLATIONS = 5
HIGH_RISK_CLAIM_AMOUNT = 100000
RISK_HIGH = "HIGH"
RISK_MEDIUM = "MEDIUM"
RISK_LOW = "LOW"
CHURN_HIGH = "HIGH_CHURN_RISK"
CHURN_STABLE = "STABLE"

# Gold columns that are zero when a member has no facts
ZERO_FILLED = [
    "lifetime_claim_amount",
    "total_claim_count",
    "lifetime_revenue",
    "violation_count",
    "streaming_claim_events",
    "streaming_payment_events",
    "policy_change_count",
    "member_update_count",
]

# Gold table columns
MEMBER_360_COLUMNS = [
    "member_id",
    "member_key",
    "age_band",
    "state",
    "tenure_days",
    "lifetime_claim_amount",
    "lifetime_revenue",
    "total_claim_count",
    "violation_count",
    "streaming_claim_events",
    "streaming_payment_events",
    "policy_change_count",
    "member_update_count",
    "engagement_score",
    "lifetime_value",
    "risk_tier",
    "churn_flag",
    "processing_timestamp",
]
