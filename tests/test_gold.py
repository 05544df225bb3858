import datetime as dt

import pytest

from silverthread import constants as K, schemas
from silverthread.operators import aggregates as A, joins
from silverthread.plans import gold as G

AS_OF = dt.date(2025, 1, 31)
NOW = dt.datetime(2025, 1, 31)


@pytest.fixture
def dimension(spark):
    data = [
        ("k1", "M1", "18-24", "01", dt.date(2025, 1, 1), "Active"),
        ("k2", "M2", "55+", "S2", dt.date(2024, 1, 31), "Active"),
        ("k3", "M3", "55+", "S2", dt.date(2024, 1, 31), "Terminated"),
        ("k4", None, "55+", "S2", None, "Active"),
    ]
    return spark.createDataFrame(
        data,
        "member_key string, member_id string, age_band string, state string, "
        "enrollment_date date, active_flag string",
    )


@pytest.fixture
def facts(spark):
    events = [("M1", "E1", "CLAIMS", "valid")] * 2 + [
        ("M1", "E2", "BILLING", "valid"),
        ("M1", "E3", "POLICY", "valid"),
        ("M1", "E4", "MEMBER", "valid"),
        ("M1", "E5", "CLAIMS", "bad"),
        (None, "E6", "CLAIMS", "valid"),
    ]
    return G.Facts(
        spark.createDataFrame(
            [("C1", "M1", 60000.0), ("C1", "M1", 40000.01), ("C2", "M3", 5.0)],
            "claim_id string, member_id string, final_claim_amount double",
        ),
        spark.createDataFrame([("M1", 0.1), ("M1", 0.2), (None, 9.0)], schemas.REVENUE),
        spark.createDataFrame([("V1", "M1"), (None, "M1")], schemas.VIOLATIONS),
        spark.createDataFrame(
            events, "member_id string, event_id string, domain string, outcome string"
        ),
    )


def test_gold_rows(dimension, facts):
    gold = G.build_member_360(dimension, facts, AS_OF, NOW)
    assert gold.columns == K.MEMBER_360_COLUMNS
    rows = {r["member_key"]: r for r in gold.collect()}
    assert set(rows) == {"k1", "k2", "k4"}
    one = rows["k1"]
    assert one["lifetime_claim_amount"] == 100000.01 and one["total_claim_count"] == 2
    assert one["lifetime_revenue"] == 0.3 and one["lifetime_value"] == -99999.71
    assert one["violation_count"] == 1 and one["tenure_days"] == 30
    assert one["streaming_claim_events"] == 2 and one["streaming_payment_events"] == 1
    assert one["policy_change_count"] == one["member_update_count"] == 1
    assert (one["risk_tier"], one["churn_flag"]) == ("HIGH", "STABLE")
    two = rows["k2"]
    assert all(two[name] == 0 for name in K.ZERO_FILLED)
    assert (two["risk_tier"], two["churn_flag"]) == ("LOW", "HIGH_CHURN_RISK")
    assert rows["k4"]["lifetime_revenue"] == 0


def test_events_counted_once(dimension, facts):
    gold = G.build_member_360(dimension, facts, AS_OF, NOW, count_events_once=True)
    assert gold.filter("member_id = 'M1'").first()["streaming_claim_events"] == 1


def test_one_aggregate_equals_one_per_table(spark, facts):
    together = A.aggregate_facts(
        [(facts.claims, A.CLAIM_MEASURES), (facts.revenue, A.REVENUE_MEASURES)], "member_id"
    )
    members = spark.createDataFrame([("M1",), ("M2",), ("M3",)], "member_id string")
    apart = joins.join_aggregates(
        members,
        [
            A.aggregate_fact(facts.claims, "member_id", A.CLAIM_MEASURES),
            A.aggregate_fact(facts.revenue, "member_id", A.REVENUE_MEASURES),
        ],
        "member_id",
    )
    single = joins.join_aggregates(members, [together], "member_id")
    names = ["lifetime_claim_amount", "total_claim_count", "lifetime_revenue"]
    fill = lambda df: sorted(map(tuple, A.fill_zero(df, names).collect()))
    assert fill(apart) == fill(single)


def test_repeated_members(dimension):
    assert G.repeated_members(dimension).count() == 0
    both = dimension.unionAll(dimension.filter("member_id = 'M1'"))
    assert [tuple(r) for r in G.repeated_members(both).collect()] == [("M1", 2)]
