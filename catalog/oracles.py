"""DuckDB SQL giving the result of each query in :mod:`catalog.queries`."""

from __future__ import annotations

_AS_OF = "DATE '2001-08-01'"
_NOW = "'2001-08-01 12:00:00'"
_AMOUNT = """CASE WHEN k % 20 = 4 THEN NULL WHEN k % 20 = 6 THEN -1.5
                            WHEN k % 20 = 8 THEN 0 ELSE value END"""


def _leaf(category: str, nested: bool, value: str, name: str) -> str:
    """A field that payloads of one category hold, in the nested or the flat shape."""
    shape = f"n_event % 2 {'=' if nested else '<>'} 0"
    return f"CASE WHEN has_payload AND event_category = '{category}' AND {shape} THEN {value} END AS {name}"


def _amount_leaf(category: str, nested: bool, name: str) -> str:
    number = _leaf(category, nested, f"CAST({_AMOUNT} AS DOUBLE)", name)
    text = _leaf(category, nested, "CASE WHEN k % 20 = 4 THEN 'abc' END", f"{name}_text")
    return f"{number},\n{text}"


_LEAVES = ",\n".join(
    [
        _leaf("CLAIMS", True, "CASE WHEN k % 11 <> 0 THEN 'C' || n_event END", "nested_claim_id"),
        _amount_leaf("CLAIMS", True, "nested_claim_amount"),
        _leaf("CLAIMS", True, "CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN 'D0' ELSE 'D0,D1' END", "diagnosis_codes"),
        _leaf("CLAIMS", True, "CASE WHEN k % 13 <> 0 THEN 'P' || k END", "nested_provider_id"),
        _leaf("CLAIMS", False, "CASE WHEN k % 11 <> 0 THEN 'C' || n_event END", "claim_id"),
        _amount_leaf("CLAIMS", False, "claim_amount"),
        _leaf("CLAIMS", False, "CASE WHEN k % 13 <> 0 THEN 'P' || k END", "provider_id"),
        _amount_leaf("BILLING", True, "nested_payment_amount"),
        _leaf("BILLING", True, "CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN 'CARD' ELSE 'CARD,BANK' END", "methods"),
        _amount_leaf("BILLING", False, "payment_amount"),
        _leaf("POLICY", True, "CASE WHEN k % 7 <> 0 THEN 'P' || n_event END", "nested_policy_id"),
        _leaf("POLICY", True, "event_day", "coverage_start"),
        _leaf("POLICY", True, "'2030-01-01'", "coverage_end"),
        _leaf("POLICY", False, "CASE WHEN k % 7 <> 0 THEN 'P' || n_event END", "policy_id"),
        *[
            _leaf("MEMBER", nested, value, ("nested_" if nested else "") + name)
            for nested in (True, False)
            for name, value in (
                ("first_name", "CASE WHEN k % 17 <> 0 THEN 'F' || k END"),
                ("last_name", "CASE WHEN k % 19 <> 0 THEN 'G' || k END"),
                ("email", "'mail' || n_user"),
                ("city", "'city' || k"),
            )
        ],
    ]
)
_ENVELOPE = "event_id, event_timestamp, member_id, event_category, schema_version"

# Common table expressions, in an order in which each uses only earlier ones.
_CTES: dict[str, str] = {
    # --- raw tables ---
    "historical": """
        SELECT CASE WHEN o_orderkey % 31 <> 0 THEN 'L' || o_custkey END AS legacy_member_id,
               CASE WHEN o_orderkey % 37 <> 0 THEN CAST(o_orderdate AS DATE) END AS effective_date,
               CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) + 1 END AS record_updated_ts,
               CASE WHEN o_orderkey % 13 <> 0 THEN CAST(1890 + o_orderkey % 150 AS INTEGER) END AS birth_year,
               CASE WHEN o_orderstatus = 'F' THEN 'F' WHEN o_orderstatus = 'O' THEN 'M'
                    WHEN o_orderkey % 3 = 0 THEN 'X' WHEN o_orderkey % 3 = 1 THEN 'M' END AS gender,
               CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_orderdate AS DATE) END AS coverage_start_date,
               CASE WHEN o_orderkey % 4 = 1 THEN CAST(o_orderdate AS DATE) - 10
                    WHEN o_orderkey % 4 = 2 THEN CAST(o_orderdate AS DATE) + 400
                    WHEN o_orderkey % 4 = 3 THEN CAST(o_orderdate AS DATE) + 4000 END AS coverage_end_date,
               'P' || o_orderkey AS policy_id,
               o_orderpriority AS policy_type,
               'S' || (o_custkey % 25) AS state,
               CAST(o_orderdate AS DATE) - 30 AS enrollment_date,
               o_orderstatus AS member_segment
        FROM orders""",
    "migrated": """
        SELECT CASE WHEN c_custkey % 9 <> 0 THEN 'L' ELSE 'X' END || c_custkey AS legacy_member_id,
               'M' || c_custkey AS member_id,
               CASE WHEN c_custkey % 7 <> 0 THEN c_name END AS ssn_raw,
               'wave' || n AS migration_flag
        FROM customer, (VALUES (1), (2)) AS copies(n)
        WHERE n = 1 OR c_custkey % 40 = 0""",
    "members_current": """
        SELECT CASE WHEN c_mktsegment <> 'BUILDING' THEN 'M' ELSE 'X' END || c_custkey AS member_id
        FROM customer, (VALUES (1), (2)) AS copies(n)
        WHERE n = 1 OR c_custkey % 10 = 0""",
    "claims": """
        SELECT CASE WHEN o_orderkey % 41 <> 0 THEN 'C' || o_orderkey END AS claim_id,
               'M' || o_custkey AS member_id,
               CASE WHEN o_orderkey % 43 <> 0 THEN CAST(o_orderdate AS DATE) END AS claim_date,
               CASE WHEN o_orderkey % 29 = 0 THEN CAST(-0.01 AS DOUBLE)
                    WHEN o_orderkey % 23 = 0 THEN CAST(75000.0 AS DOUBLE)
                    WHEN o_orderkey % 19 <> 0 THEN o_totalprice END AS claim_amount
        FROM orders""",
    "adjustments": """
        SELECT CASE WHEN l_linenumber <> 6 THEN 'A' || (l_orderkey * 10 + l_linenumber) END AS adjustment_id,
               'C' || l_orderkey AS claim_id,
               CASE WHEN l_linenumber = 3 THEN 'M-other' ELSE 'M' || o_custkey END AS member_id,
               l_extendedprice AS original_claim_amount,
               l_quantity AS adjustment_amount,
               CASE WHEN l_linenumber = 7 THEN l_extendedprice
                    ELSE l_extendedprice + l_quantity END AS adjusted_final_amount,
               CAST(l_shipdate AS DATE) AS adjustment_date
        FROM lineitem
        JOIN (SELECT DISTINCT o_orderkey, o_custkey FROM orders) ON l_orderkey = o_orderkey""",
    "revenue": """
        SELECT 'M' || o_custkey AS member_id,
               CASE WHEN o_orderkey % 7 = 0 THEN -o_totalprice
                    WHEN o_orderkey % 11 <> 0 THEN o_totalprice END AS premium_collected
        FROM orders""",
    "violations": """
        SELECT 'V' || event_id AS violation_id, 'M' || user_id AS member_id FROM events""",
    "feed": """
        SELECT CASE WHEN event_id % 107 <> 0 THEN 'E' || event_id END AS event_id,
               CAST(ts AS VARCHAR) AS event_timestamp,
               substr(CAST(ts AS VARCHAR), 1, 10) AS event_day,
               CASE WHEN event_id % 101 <> 0 THEN 'M' || user_id END AS member_id,
               CASE event_type WHEN 'purchase' THEN 'CLAIMS' WHEN 'click' THEN 'BILLING'
                    WHEN 'view' THEN 'POLICY' WHEN 'signup' THEN 'MEMBER' ELSE 'OTHER' END AS event_category,
               CASE WHEN event_id % 50 = 49 THEN 'v3' WHEN event_id % 2 = 0 THEN 'v2' ELSE 'v1' END AS schema_version,
               event_id % 103 <> 0 AS has_payload,
               event_id AS n_event, user_id AS n_user,
               CAST(json_extract(props, '$.k') AS INTEGER) AS k, value
        FROM events""",
    # --- member dimension ---
    "history": "SELECT DISTINCT * FROM historical",
    "history_valid": """
        SELECT * FROM history
        WHERE legacy_member_id IS NOT NULL AND effective_date IS NOT NULL
          AND birth_year IS NOT NULL AND birth_year BETWEEN 1900 AND 2025
          AND gender IN ('M', 'F')
          AND (coverage_end_date IS NULL OR coverage_start_date <= coverage_end_date)""",
    "newest": """
        SELECT * FROM history_valid
        QUALIFY row_number() OVER (
            PARTITION BY legacy_member_id
            ORDER BY effective_date DESC NULLS LAST, record_updated_ts DESC NULLS LAST,
                     birth_year DESC NULLS LAST, gender DESC NULLS LAST,
                     coverage_start_date DESC NULLS LAST, coverage_end_date DESC NULLS LAST,
                     policy_id DESC NULLS LAST) = 1""",
    "dimension": f"""
        SELECT sha256(member_id) AS member_key, member_id, legacy_member_id,
               CASE WHEN 2001 - birth_year BETWEEN 18 AND 24 THEN '18-24'
                    WHEN 2001 - birth_year BETWEEN 25 AND 34 THEN '25-34'
                    WHEN 2001 - birth_year BETWEEN 35 AND 44 THEN '35-44'
                    WHEN 2001 - birth_year BETWEEN 45 AND 54 THEN '45-54'
                    ELSE '55+' END AS age_band,
               gender, state, enrollment_date, policy_id, policy_type,
               coverage_start_date, coverage_end_date, member_segment,
               CASE WHEN coverage_end_date IS NULL OR coverage_end_date > {_AS_OF}
                    THEN 'Active' ELSE 'Terminated' END AS active_flag,
               migration_flag, sha256(ssn_raw) AS masked_ssn,
               'ACTIVE' AS record_status, 'VALID' AS dq_flag, {_NOW} AS processing_timestamp,
               {_AS_OF} AS processing_date
        FROM newest JOIN migrated USING (legacy_member_id)""",
    # --- claims ---
    "claims_distinct": "SELECT DISTINCT * FROM claims",
    "claims_good": """
        SELECT DISTINCT * FROM claims
        WHERE member_id IN (SELECT member_id FROM members_current)
          AND claim_id IS NOT NULL AND claim_date IS NOT NULL
          AND claim_amount >= 0 AND claim_amount <= 75000""",
    "adjustments_good": """
        SELECT a.* FROM adjustments a JOIN claims_good c ON a.claim_id = c.claim_id
        WHERE CAST(original_claim_amount AS DECIMAL(18,2)) + CAST(adjustment_amount AS DECIMAL(18,2))
              = CAST(adjusted_final_amount AS DECIMAL(18,2))
          AND adjustment_date >= claim_date""",
    "adjustments_newest": """
        SELECT * FROM adjustments_good
        QUALIFY row_number() OVER (
            PARTITION BY claim_id, member_id
            ORDER BY adjustment_date DESC NULLS LAST, adjustment_id DESC NULLS LAST,
                     original_claim_amount DESC NULLS LAST, adjustment_amount DESC NULLS LAST,
                     adjusted_final_amount DESC NULLS LAST) = 1""",
    "fact": f"""
        SELECT claim_id, member_id, claim_date, claim_amount, adjustment_id,
               original_claim_amount, adjustment_amount, adjusted_final_amount, adjustment_date,
               coalesce(adjusted_final_amount, claim_amount) AS final_claim_amount,
               {_NOW} AS processing_timestamp,
               'VALID' AS dq_flag, CAST(year(claim_date) AS INTEGER) AS claim_year
        FROM claims_good LEFT JOIN adjustments_good USING (claim_id, member_id)""",
    # --- events ---
    "accepted": """
        SELECT *, CAST(CASE WHEN k % 20 = 4 THEN NULL WHEN k % 20 = 6 THEN -1.5
                            WHEN k % 20 = 8 THEN 0 ELSE value END AS DOUBLE) AS amount
        FROM feed WHERE event_id IS NOT NULL AND member_id IS NOT NULL AND has_payload""",
    "routed": """
        SELECT * FROM accepted
        WHERE event_category <> 'OTHER' AND schema_version IN ('v1', 'v2')""",
    "ev_claims": """
        SELECT event_id, event_timestamp, member_id,
               CASE WHEN k % 11 <> 0 THEN 'C' || n_event END AS claim_id,
               amount AS claim_amount,
               CASE WHEN k % 13 <> 0 THEN 'P' || k END AS provider_id,
               unnest(CASE WHEN schema_version = 'v1' THEN [NULL]
                           ELSE (['D0', 'D1'])[1:k % 3] END) AS diagnosis_code
        FROM routed WHERE event_category = 'CLAIMS'""",
    "ev_billing": """
        SELECT event_id, event_timestamp, member_id, amount AS payment_amount,
               unnest(CASE WHEN schema_version = 'v1' THEN [NULL]
                           ELSE (['CARD', 'BANK'])[1:k % 3] END) AS payment_method
        FROM routed WHERE event_category = 'BILLING'""",
    "ev_policy": """
        SELECT event_id, event_timestamp, member_id,
               CASE WHEN k % 7 <> 0 THEN 'P' || n_event END AS policy_id,
               CASE WHEN schema_version = 'v2' THEN event_day END AS start_date,
               CASE WHEN schema_version = 'v2' THEN '2030-01-01' END AS end_date
        FROM routed WHERE event_category = 'POLICY'""",
    "ev_member": """
        SELECT event_id, event_timestamp, member_id,
               CASE WHEN k % 17 <> 0 THEN 'F' || k END AS first_name,
               CASE WHEN k % 19 <> 0 THEN 'G' || k END AS last_name,
               'mail' || n_user AS email, 'city' || k AS city
        FROM routed WHERE event_category = 'MEMBER'""",
    "good_claims": """
        SELECT * FROM ev_claims
        WHERE claim_id IS NOT NULL AND claim_amount > 0 AND provider_id IS NOT NULL""",
    "good_billing": "SELECT * FROM ev_billing WHERE payment_amount > 0",
    "good_policy": "SELECT * FROM ev_policy WHERE policy_id IS NOT NULL",
    "good_member": "SELECT * FROM ev_member WHERE first_name IS NOT NULL AND last_name IS NOT NULL",
    "bad_claims": "SELECT * FROM ev_claims EXCEPT SELECT * FROM good_claims",
    "bad_billing": "SELECT * FROM ev_billing EXCEPT SELECT * FROM good_billing",
    "bad_policy": "SELECT * FROM ev_policy EXCEPT SELECT * FROM good_policy",
    "bad_member": "SELECT * FROM ev_member EXCEPT SELECT * FROM good_member",
    # --- aggregates ---
    "sum_claims": """
        SELECT member_id,
               CAST(sum(CAST(final_claim_amount AS DECIMAL(18,2))) AS DOUBLE) AS lifetime_claim_amount,
               count(claim_id) AS total_claim_count
        FROM fact GROUP BY member_id""",
    "sum_revenue": """
        SELECT member_id, CAST(sum(CAST(premium_collected AS DECIMAL(18,2))) AS DOUBLE) AS lifetime_revenue
        FROM revenue WHERE premium_collected >= 0 GROUP BY member_id""",
    "sum_violations": """
        SELECT member_id, count(violation_id) AS violation_count FROM violations GROUP BY member_id""",
    "sum_ev_claims": """
        SELECT member_id, count(event_id) AS streaming_claim_events FROM good_claims GROUP BY member_id""",
    "sum_ev_billing": """
        SELECT member_id, count(event_id) AS streaming_payment_events FROM good_billing GROUP BY member_id""",
    "sum_ev_policy": """
        SELECT member_id, count(event_id) AS policy_change_count FROM good_policy GROUP BY member_id""",
    "sum_ev_member": """
        SELECT member_id, count(event_id) AS member_update_count FROM good_member GROUP BY member_id""",
    "activity": """
        SELECT member_id,
               coalesce(lifetime_claim_amount, 0) AS lifetime_claim_amount,
               coalesce(total_claim_count, 0) AS total_claim_count,
               coalesce(lifetime_revenue, 0) AS lifetime_revenue,
               coalesce(violation_count, 0) AS violation_count,
               coalesce(streaming_claim_events, 0) AS streaming_claim_events,
               coalesce(streaming_payment_events, 0) AS streaming_payment_events,
               coalesce(policy_change_count, 0) AS policy_change_count,
               coalesce(member_update_count, 0) AS member_update_count
        FROM sum_claims
        FULL JOIN sum_revenue USING (member_id)
        FULL JOIN sum_violations USING (member_id)
        FULL JOIN sum_ev_claims USING (member_id)
        FULL JOIN sum_ev_billing USING (member_id)
        FULL JOIN sum_ev_policy USING (member_id)
        FULL JOIN sum_ev_member USING (member_id)""",
    "scored": f"""
        WITH filled AS (
            SELECT d.*, coalesce(lifetime_claim_amount, 0) AS amount,
                   coalesce(lifetime_revenue, 0) AS revenue,
                   coalesce(total_claim_count, 0) AS claims,
                   coalesce(violation_count, 0) AS violations,
                   coalesce(streaming_claim_events, 0) AS claim_events,
                   coalesce(streaming_payment_events, 0) AS payment_events,
                   coalesce(policy_change_count, 0) AS policy_events,
                   coalesce(member_update_count, 0) AS member_events
            FROM dimension d LEFT JOIN activity USING (member_id))
        SELECT policy_id, migration_flag, active_flag, member_id, member_key, age_band, state,
               CAST(date_diff('day', enrollment_date, {_AS_OF}) AS INTEGER) AS tenure_days,
               amount AS lifetime_claim_amount, revenue AS lifetime_revenue,
               claims AS total_claim_count, violations AS violation_count,
               claim_events AS streaming_claim_events, payment_events AS streaming_payment_events,
               policy_events AS policy_change_count, member_events AS member_update_count,
               round(ln(claim_events + payment_events + 1), 6) AS engagement_score,
               CAST(CAST(revenue AS DECIMAL(28,2)) - CAST(amount AS DECIMAL(28,2)) AS DOUBLE) AS lifetime_value,
               CASE WHEN violations > 5 OR amount > 100000 THEN 'HIGH'
                    WHEN violations > 0 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier,
               CASE WHEN claim_events = 0 AND payment_events = 0
                    THEN 'HIGH_CHURN_RISK' ELSE 'STABLE' END AS churn_flag,
               {_NOW} AS processing_timestamp
        FROM filled""",
    "gold": """
        SELECT * EXCLUDE (policy_id, migration_flag, active_flag) FROM scored WHERE active_flag = 'Active'""",
}

_DAYS = {
    "historical": [
        "effective_date", "record_updated_ts", "coverage_start_date", "coverage_end_date", "enrollment_date",
    ],
    "claims": ["claim_date"],
    "adjustments": ["adjustment_date"],
    "fact": ["claim_date", "adjustment_date"],
    "dimension": ["enrollment_date", "coverage_start_date", "coverage_end_date", "processing_date"],
}


def _with(body: str) -> str:
    """``body`` preceded by the common table expressions it needs."""
    needed: list[str] = []
    text = body
    for name in reversed(_CTES):
        if _mentions(text, name):
            needed.insert(0, name)
            text += _CTES[name]
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({_CTES[name]})" for name in needed) + "\n" + body


def _mentions(text: str, name: str) -> bool:
    words = text.replace("(", " ").replace(")", " ").replace(",", " ").split()
    return any(a in ("FROM", "JOIN") and b == name for a, b in zip(words, words[1:]))


def _text_days(kind: str) -> str:
    days = ", ".join(f"CAST({name} AS VARCHAR) AS {name}" for name in _DAYS[kind])
    return f"* REPLACE ({days})"


_BODIES: dict[str, str] = {
    "csv_scan": """
        SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS member_id, c_name AS name,
               c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment FROM customer""",
    "csv_header_order": """
        SELECT CAST(c_custkey AS BIGINT) AS c_custkey, CASE WHEN c_custkey % 2 = 1 THEN c_name END AS name,
               c_mktsegment AS segment, c_acctbal AS balance,
               CASE WHEN c_custkey % 2 = 1 THEN CAST(c_nationkey AS VARCHAR) END AS nation
        FROM customer""",
    "csv_mixed_folder": """
        SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name AS name,
               CASE WHEN c_custkey % 3 <> 2 THEN c_acctbal END AS balance,
               CASE WHEN c_custkey % 3 = 1 THEN c_mktsegment END AS segment
        FROM customer""",
    "csv_malformed": """
        SELECT CAST(o_orderkey AS VARCHAR) AS claim_id, o_orderkey || ',n/a' AS line
        FROM orders WHERE o_orderkey % 9 = 0""",
    "json_scan": f"SELECT {_ENVELOPE}, has_payload, {_LEAVES} FROM feed",
    "table_roundtrip": """
        SELECT * REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate), CAST(2 AS INTEGER) AS version
        FROM orders""",
    "partition_roundtrip": """
        SELECT * REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate),
               '2001-08-01' AS processing_date, 'Active' AS active_flag, CAST(2 AS BIGINT) AS dates
        FROM orders WHERE o_orderdate > DATE '1998-01-01'""",
    "claim_year_roundtrip": f"""
        SELECT {_text_days("claims")}, CAST(year(claim_date) AS INTEGER) AS claim_year FROM claims""",
    "snapshot_roundtrip": """
        SELECT * EXCLUDE (c_mktsegment, d), c_mktsegment AS state, d AS run_date
        FROM customer, (VALUES ('2001-07-31'), ('2001-08-01')) AS days(d)""",
    "snapshot_append": """
        SELECT * EXCLUDE (c_mktsegment, n), c_mktsegment AS state, '2001-08-01' AS run_date
        FROM customer, (VALUES (1), (2)) AS copies(n)""",
    "quarantine_roundtrip": f"""
        SELECT * REPLACE (sha256(legacy_member_id) AS legacy_member_id) FROM (
            SELECT {_text_days("historical")} FROM (SELECT * FROM history EXCEPT SELECT * FROM history_valid))""",
    "run_log": """
        SELECT 'member_records' AS job_name,
               (SELECT count(*) FROM history_valid) AS records_processed,
               (SELECT count(*) FROM history) - (SELECT count(*) FROM history_valid) AS records_failed,
               'SUCCESS' AS status""",
    "quarantine_split": """
        SELECT * FROM customer EXCEPT
        SELECT * FROM customer WHERE c_acctbal >= 0 AND c_mktsegment IN ('BUILDING', 'MACHINERY')""",
    "rule_null_semantics": """
        WITH base AS (SELECT c_custkey, nullif(c_nationkey, 3) AS a, nullif(c_nationkey % 7, 2) AS b FROM customer)
        SELECT * FROM base EXCEPT SELECT * FROM base WHERE a IS NULL OR b <= a""",
    "rule_reasons": """
        SELECT rule, count(*) AS records FROM (
            SELECT unnest([
                CASE WHEN legacy_member_id IS NULL THEN 'legacy_member_id_missing' END,
                CASE WHEN effective_date IS NULL THEN 'effective_date_missing' END,
                CASE WHEN birth_year IS NULL THEN 'birth_year_missing' END,
                CASE WHEN NOT coalesce(birth_year BETWEEN 1900 AND 2025, false) THEN 'birth_year_out_of_range' END,
                CASE WHEN NOT coalesce(gender IN ('M', 'F'), false) THEN 'gender_unknown' END,
                CASE WHEN NOT coalesce(coverage_end_date IS NULL OR coverage_start_date <= coverage_end_date, false)
                     THEN 'coverage_end_date_before_coverage_start_date' END]) AS rule
            FROM historical)
        WHERE rule IS NOT NULL GROUP BY rule""",
    "member_rules_valid": f"""SELECT {_text_days("historical")} FROM history_valid""",
    "member_rules_bad": f"""
        SELECT {_text_days("historical")} FROM (SELECT * FROM history EXCEPT SELECT * FROM history_valid)""",
    "claims_valid": f"""SELECT {_text_days("claims")} FROM claims_good""",
    "claims_bad": f"""
        SELECT {_text_days("claims")} FROM (SELECT * FROM claims EXCEPT SELECT * FROM claims_good)""",
    "adjust_valid": f"""SELECT {_text_days("adjustments")} FROM adjustments_good""",
    "adjust_bad": f"""
        SELECT {_text_days("adjustments")} FROM adjustments
        WHERE adjustment_id IS NULL OR adjustment_id NOT IN (
            SELECT adjustment_id FROM adjustments_good WHERE adjustment_id IS NOT NULL)""",
    "revenue_clean": """
        SELECT *, '2001-08-01 12:00:00' AS processing_timestamp FROM revenue WHERE premium_collected >= 0""",
    "revenue_rejected": "SELECT * FROM revenue WHERE NOT coalesce(premium_collected >= 0, false)",
    "violations_clean": """
        SELECT DISTINCT *, '2001-08-01 12:00:00' AS processing_timestamp FROM violations""",
    "audit_project": f"""
        SELECT member_id, legacy_member_id, migration_flag, {_NOW} AS processing_timestamp,
               'ACTIVE' AS record_status, 'VALID' AS dq_flag
        FROM migrated""",
    "fill_zero": """
        SELECT c_custkey,
               CASE WHEN c_nationkey % 3 <> 0 THEN c_acctbal ELSE 0 END AS balance,
               CASE WHEN c_nationkey % 5 <> 0 THEN c_nationkey ELSE 0 END AS nation,
               CASE WHEN c_nationkey % 2 <> 0 THEN c_nationkey END AS kept_null
        FROM customer""",
    "mask_keys": """
        SELECT legacy_member_id, sha256(ssn_raw) AS masked_ssn, sha256(member_id) AS member_key,
               sha256('pepper' || member_id) AS salted_key
        FROM migrated""",
    "age_band": """
        SELECT policy_id, CAST(2001 - birth_year AS INTEGER) AS age,
               CASE WHEN 2001 - birth_year BETWEEN 18 AND 24 THEN '18-24'
                    WHEN 2001 - birth_year BETWEEN 25 AND 34 THEN '25-34'
                    WHEN 2001 - birth_year BETWEEN 35 AND 44 THEN '35-44'
                    WHEN 2001 - birth_year BETWEEN 45 AND 54 THEN '45-54'
                    ELSE '55+' END AS age_band
        FROM historical""",
    "active_flag": f"""
        SELECT policy_id, CASE WHEN coverage_end_date IS NULL OR coverage_end_date > {_AS_OF}
                               THEN 'Active' ELSE 'Terminated' END AS active_flag
        FROM historical""",
    "tenure": f"""
        SELECT policy_id, CAST(date_diff('day', enrollment_date, {_AS_OF}) AS INTEGER) AS tenure_days
        FROM historical""",
    "claim_year": "SELECT claim_id, CAST(year(claim_date) AS INTEGER) AS claim_year FROM claims",
    "amount_cast": """
        SELECT event_id, CASE WHEN NOT has_payload THEN NULL WHEN k % 20 = 4 THEN NULL
                              WHEN k % 20 = 6 THEN CAST(-1.5 AS DOUBLE)
                              WHEN k % 20 = 8 THEN CAST(0 AS DOUBLE) ELSE value END AS claim_amount
        FROM feed WHERE event_category = 'CLAIMS' AND schema_version = 'v1'""",
    "settled_amounts": "SELECT claim_id, adjustment_id, final_claim_amount FROM fact",
    "member_latest": f"""SELECT {_text_days("historical")} FROM newest""",
    "member_latest_incremental": f"""SELECT {_text_days("historical")} FROM newest""",
    "latest_order": """
        SELECT * REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate) FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "join_inner_latest": """
        SELECT legacy_member_id, member_id, policy_id, migration_flag
        FROM newest JOIN migrated USING (legacy_member_id)""",
    "require_parent": f"""
        SELECT {_text_days("claims")} FROM claims
        WHERE member_id IN (SELECT member_id FROM members_current)""",
    "adjust_with_claim": """
        SELECT a.* REPLACE (CAST(adjustment_date AS VARCHAR) AS adjustment_date),
               CAST(claim_date AS VARCHAR) AS claim_date
        FROM adjustments a JOIN claims_distinct c ON a.claim_id = c.claim_id""",
    "without_match": f"""
        SELECT {_text_days("adjustments")} FROM adjustments
        WHERE claim_id IS NULL OR claim_id NOT IN (
            SELECT claim_id FROM claims WHERE claim_amount > 100000 AND claim_id IS NOT NULL)""",
    "claims_with_adjustments": f"""
        SELECT {_text_days("fact")} FROM (
            SELECT claim_id, member_id, claim_date, claim_amount, adjustment_id, original_claim_amount,
                   adjustment_amount, adjusted_final_amount, adjustment_date
            FROM claims_distinct LEFT JOIN adjustments USING (claim_id, member_id))""",
    "unused_adjustments": f"""
        SELECT {_text_days("adjustments")} FROM adjustments_good a
        WHERE NOT EXISTS (SELECT 1 FROM claims_good c
                          WHERE c.claim_id = a.claim_id AND c.member_id = a.member_id)""",
    "dedup_exact": """
        SELECT DISTINCT * REPLACE (CAST(l_shipdate AS VARCHAR) AS l_shipdate) FROM lineitem""",
    "distinct_row_count": "SELECT count(*) AS records FROM (SELECT DISTINCT * FROM historical)",
    "join_mixed_types": """
        SELECT CAST(o_custkey AS BIGINT) AS key, orders.* EXCLUDE (o_custkey)
               REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate), customer.*
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "union_by_name": """
        SELECT * FROM customer
        UNION ALL SELECT * REPLACE (NULL AS c_acctbal) FROM customer""",
    "except_distinct": """
        SELECT * REPLACE (CAST(claim_date AS VARCHAR) AS claim_date) FROM (
            SELECT * FROM claims EXCEPT SELECT * FROM claims WHERE claim_date >= DATE '1998-01-01')""",
    "agg_claims": "SELECT * FROM sum_claims",
    "agg_revenue": "SELECT * FROM sum_revenue",
    "agg_violations": "SELECT * FROM sum_violations",
    "agg_claims_events": """
        SELECT member_id, count(event_id) AS streaming_claim_events, max(event_id) AS last_claim_event_id
        FROM good_claims GROUP BY member_id""",
    "agg_billing_events": """
        SELECT member_id, count(event_id) AS streaming_payment_events FROM good_billing GROUP BY member_id""",
    "agg_policy_events": """
        SELECT member_id, count(event_id) AS policy_change_count FROM good_policy GROUP BY member_id""",
    "agg_member_events": """
        SELECT member_id, count(event_id) AS member_update_count FROM good_member GROUP BY member_id""",
    "agg_all_facts": "SELECT * FROM activity",
    "agg_incremental": "SELECT * FROM activity",
    "agg_domain_tables": """
        SELECT member_id, lifetime_claim_amount, total_claim_count, lifetime_revenue, violation_count,
               coalesce(c.n, 0) AS streaming_claim_events, coalesce(b.n, 0) AS streaming_payment_events,
               policy_change_count, member_update_count
        FROM activity
        LEFT JOIN (SELECT member_id, count(DISTINCT event_id) AS n FROM good_claims GROUP BY ALL) c USING (member_id)
        LEFT JOIN (SELECT member_id, count(DISTINCT event_id) AS n FROM good_billing GROUP BY ALL) b USING (member_id)""",
    "agg_distinct_events": """
        SELECT member_id, count(DISTINCT event_id) AS streaming_claim_events FROM good_claims GROUP BY member_id""",
    "join_aggregates": """
        SELECT member_id, lifetime_claim_amount, total_claim_count, lifetime_revenue, violation_count
        FROM members_current
        LEFT JOIN sum_claims USING (member_id)
        LEFT JOIN sum_revenue USING (member_id)
        LEFT JOIN sum_violations USING (member_id)""",
    "dq_metrics": "\nUNION ALL ".join(
        f"SELECT '{d.upper()}' AS domain, '{outcome}' AS outcome, count(*) AS records FROM {table}_{d}"
        for d in ("claims", "billing", "policy", "member")
        for outcome, table in (("valid", "good"), ("bad", "bad"))
    ),
    "json_array_text": f"SELECT {_ENVELOPE}, {_LEAVES} FROM feed",
    "events_envelope_valid": f"SELECT {_ENVELOPE}, {_LEAVES} FROM accepted",
    "events_rejected": f"""
        SELECT {_ENVELOPE}, {_LEAVES},
               CASE WHEN event_id IS NULL THEN 'event_id_missing'
                    WHEN member_id IS NULL THEN 'member_id_missing'
                    WHEN NOT has_payload THEN 'payload_missing'
                    ELSE 'unknown_category_or_version' END AS reject_reason
        FROM feed
        WHERE event_id IS NULL OR member_id IS NULL OR NOT has_payload
           OR event_category = 'OTHER' OR schema_version = 'v3'""",
    "event_unknown_paths": """
        SELECT * FROM (WITH changed AS (
            SELECT event_category, schema_version, n_event,
                   CASE WHEN event_id IS NULL OR NOT has_payload OR NOT filled THEN '' ELSE right(event_id, 1) END AS last,
                   filled, has_payload
            FROM (SELECT *, event_category <> 'OTHER' AND (
                      event_category <> 'POLICY' OR n_event % 2 = 0 OR k % 7 <> 0) AS filled FROM feed)),
        added AS (
            SELECT event_category, schema_version, unnest(CASE
                WHEN last IN ('3', '4') THEN [{'p': 'channel', 't': 'object'}, {'p': 'channel.kind', 't': 'string'},
                    {'p': 'channel.tags', 't': 'array'}, {'p': 'channel.tags[]', 't': 'string'},
                    {'p': 'channel.tags[]', 't': 'string'}]
                WHEN last = '5' THEN [{'p': 'score', 't': 'bigint'}] END) AS x FROM changed),
        unread AS (
            SELECT event_category, schema_version, unnest(CASE event_category
                WHEN 'CLAIMS' THEN list_filter([CASE WHEN k % 11 <> 0 THEN 'claim_id' END, 'claim_amount',
                    CASE WHEN k % 13 <> 0 THEN 'provider_id' END], lambda x: x IS NOT NULL)
                WHEN 'BILLING' THEN ['payment_amount']
                WHEN 'POLICY' THEN list_filter([CASE WHEN k % 7 <> 0 THEN 'policy_id' END], lambda x: x IS NOT NULL)
                WHEN 'MEMBER' THEN list_filter([CASE WHEN k % 17 <> 0 THEN 'first_name' END,
                    CASE WHEN k % 19 <> 0 THEN 'last_name' END, 'email', 'city'], lambda x: x IS NOT NULL) END) AS p
            FROM feed WHERE has_payload AND schema_version = 'v3')
        SELECT event_category, schema_version, x.p AS path, x.t AS kind, count(*) AS occurrences
        FROM added WHERE x IS NOT NULL GROUP BY ALL
        UNION ALL
        SELECT event_category, schema_version, p, 'string', count(*) FROM unread GROUP BY ALL)""",
    "events_routed": """
        SELECT event_id, member_id, 'city' || k AS city FROM routed
        WHERE event_category = 'MEMBER' AND schema_version = 'v2'""",
    **{
        f"events_{d}{suffix}": f"SELECT * FROM {table}_{d}"
        for d in ("claims", "billing", "policy", "member")
        for suffix, table in (("", "ev"), ("_valid", "good"), ("_bad", "bad"))
    },
    "events_keep_empty": """
        SELECT * FROM ev_claims
        UNION ALL
        SELECT event_id, event_timestamp, member_id,
               CASE WHEN k % 11 <> 0 THEN 'C' || n_event END, amount,
               CASE WHEN k % 13 <> 0 THEN 'P' || k END, NULL
        FROM routed WHERE event_category = 'CLAIMS' AND schema_version = 'v2' AND k % 3 = 0""",
    "events_stream": "SELECT * FROM good_claims",
    "events_dedup_stream": "SELECT * FROM good_billing",
    "member_dimension": f"""SELECT {_text_days("dimension")} FROM dimension""",
    "claims_fact": f"""SELECT {_text_days("fact")} FROM fact""",
    "claims_fact_latest": f"""
        SELECT {_text_days("fact")} FROM (
            SELECT claim_id, member_id, claim_date, claim_amount, adjustment_id,
                   original_claim_amount, adjustment_amount, adjusted_final_amount, adjustment_date,
                   coalesce(adjusted_final_amount, claim_amount) AS final_claim_amount,
                   {_NOW} AS processing_timestamp, 'VALID' AS dq_flag, CAST(year(claim_date) AS INTEGER) AS claim_year
            FROM claims_good LEFT JOIN adjustments_newest USING (claim_id, member_id))""",
    "risk_churn": """
        WITH o AS (SELECT o_custkey AS member, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS claims
                   FROM orders GROUP BY o_custkey),
             e AS (SELECT user_id AS member, count(*) AS violations
                   FROM events WHERE event_type = 'error' GROUP BY user_id),
             m AS (SELECT c_custkey AS member, c_acctbal, coalesce(claims, 0) AS claims,
                          coalesce(violations, 0) AS violations
                   FROM customer LEFT JOIN o ON c_custkey = o.member LEFT JOIN e ON c_custkey = e.member)
        SELECT member,
               CASE WHEN violations > 12 OR claims > 4000000 THEN 'HIGH'
                    WHEN violations > 0 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier,
               CASE WHEN violations = 0 THEN 'HIGH_CHURN_RISK' ELSE 'STABLE' END AS churn_flag,
               CAST(CAST(c_acctbal AS DECIMAL(28,2)) - CAST(claims AS DECIMAL(28,2)) AS DOUBLE) AS lifetime_value,
               round(ln(violations + 1), 6) AS engagement_score
        FROM m""",
    "member_360": "SELECT * FROM gold",
    "member_360_from_files": "SELECT *, '2001-08-01' AS run_date FROM gold",
    "member_360_from_stream": "SELECT *, '2001-08-01' AS run_date FROM gold",
    "gold_backfill": f"""
        SELECT * FROM (WITH of_date AS (
            SELECT DATE '1998-01-01' AS run_date, DATE '1998-01-01' AS valid
            UNION ALL SELECT DATE '2000-05-05', DATE '1998-01-01'
            UNION ALL SELECT {_AS_OF}, {_AS_OF}),
        known AS (
            SELECT d.* EXCLUDE (age_band, active_flag, processing_date), run_date,
                   CASE WHEN year(valid) - birth_year BETWEEN 18 AND 24 THEN '18-24'
                        WHEN year(valid) - birth_year BETWEEN 25 AND 34 THEN '25-34'
                        WHEN year(valid) - birth_year BETWEEN 35 AND 44 THEN '35-44'
                        WHEN year(valid) - birth_year BETWEEN 45 AND 54 THEN '45-54'
                        ELSE '55+' END AS age_band
            FROM dimension d JOIN newest USING (legacy_member_id), of_date
            WHERE d.coverage_end_date IS NULL OR d.coverage_end_date > valid)
        SELECT g.member_id, g.member_key, k.age_band, g.state,
               CAST(date_diff('day', k.enrollment_date, run_date) AS INTEGER) AS tenure_days,
               g.* EXCLUDE (policy_id, migration_flag, active_flag, member_id, member_key, age_band, state, tenure_days), CAST(run_date AS VARCHAR) AS run_date
        FROM known k JOIN scored g ON g.policy_id = k.policy_id AND g.migration_flag = k.migration_flag)""",
    "run_balance": """
        SELECT 'member_dimension' AS job_name, 'history read' AS equation,
               (SELECT count(*) FROM historical) AS left_rows, (SELECT count(*) FROM historical) AS right_rows
        UNION ALL SELECT 'claims_fact', 'adjustments met', (SELECT count(*) FROM adjustments), (SELECT count(*) FROM adjustments)
        UNION ALL SELECT 'claims_fact', 'revenue split', (SELECT count(*) FROM revenue), (SELECT count(*) FROM revenue)
        UNION ALL SELECT 'claims_fact', 'adjustments used', (SELECT count(*) FROM adjustments_good), (SELECT count(*) FROM adjustments_good)""",
    "snapshot_clustered": """
        SELECT * EXCLUDE (c_mktsegment), c_mktsegment AS state, '2001-08-01' AS run_date
        FROM customer WHERE c_custkey BETWEEN 100 AND 220""",
    "run_log_of_all_runs": """
        SELECT 'member_dimension' AS job_name, (SELECT count(*) FROM history_valid) AS records_processed,
               (SELECT count(*) FROM history) - (SELECT count(*) FROM history_valid) AS records_failed,
               'SUCCESS' AS status
        UNION ALL
        SELECT 'claims_fact',
               (SELECT count(*) FROM claims_good) + (SELECT count(*) FROM adjustments_good)
               + (SELECT count(*) FROM revenue WHERE premium_collected >= 0)
               + (SELECT count(*) FROM violations),
               (SELECT count(*) FROM (SELECT * FROM claims EXCEPT SELECT * FROM claims_good))
               + (SELECT count(*) FROM adjustments WHERE adjustment_id IS NULL OR adjustment_id NOT IN (
                      SELECT adjustment_id FROM adjustments_good WHERE adjustment_id IS NOT NULL))
               + (SELECT count(*) FROM revenue WHERE NOT coalesce(premium_collected >= 0, false)),
               'SUCCESS'
        UNION ALL
        SELECT 'event_domains',
               (SELECT count(*) FROM good_claims) + (SELECT count(*) FROM good_billing)
               + (SELECT count(*) FROM good_policy) + (SELECT count(*) FROM good_member),
               (SELECT count(*) FROM bad_claims) + (SELECT count(*) FROM bad_billing)
               + (SELECT count(*) FROM bad_policy) + (SELECT count(*) FROM bad_member),
               'SUCCESS'
        UNION ALL
        SELECT 'member_360', (SELECT count(*) FROM gold), 0, 'SUCCESS'""",
}

ORACLES: dict[str, str] = {name: _with(body) for name, body in _BODIES.items()}
