import datetime as dt

import pytest

from silverthread import schemas
from silverthread.plans import claims as C

NOW = dt.datetime(2025, 1, 1)
D = dt.date


@pytest.fixture
def members(spark):
    return spark.createDataFrame([("M1",), ("M1",), ("M2",), (None,)], schemas.MEMBERS_CURRENT)


def claims(spark, *data):
    return spark.createDataFrame(list(data), schemas.CLAIMS)


def adjustments(spark, *data):
    return spark.createDataFrame(list(data), schemas.CLAIMS_ADJUSTMENTS)


def test_claim_checks(spark, members, rows):
    day = D(2024, 3, 1)
    df = claims(
        spark,
        ("zero", "M1", day, 0.0),
        ("zero", "M1", day, 0.0),
        ("top", "M2", day, 75000.0),
        ("over", "M2", day, 75000.01),
        ("negative", "M1", day, -0.01),
        ("null amount", "M1", day, None),
        ("nan", "M1", day, float("nan")),
        ("stranger", "M9", day, 1.0),
        ("no member", None, day, 1.0),
        (None, "M1", day, 1.0),
        ("no day", "M1", None, 1.0),
    )
    split = C.quality.split_on_flag(C.check_claims(df, members), distinct_rejects=False)
    assert rows(split.valid, "claim_id") == [("top",), ("zero",)]
    assert split.valid.columns == split.rejected.columns == schemas.CLAIMS.names
    assert split.rejected.count() == 8


def test_adjustments(spark, members, rows):
    day = D(2024, 3, 1)
    fact, bad_claims, bad = C.build_claims_fact(
        members,
        claims(
            spark,
            ("C1", "M1", day, 100.0),
            ("C2", "M2", day, 50.0),
            ("C3", "M1", day, 10.0),
            ("C9", "M9", day, 10.0),
        ),
        adjustments(
            spark,
            ("cents", "C1", "M1", 0.1, 0.2, 0.3, day),
            ("second", "C1", "M1", 10.0, -4.0, 6.0, D(2024, 4, 1)),
            ("wrong sum", "C2", "M2", 1.0, 1.0, 3.0, day),
            ("early", "C2", "M2", 1.0, 1.0, 2.0, D(2024, 2, 29)),
            ("claim bad", "C9", "M9", 1.0, 1.0, 2.0, day),
            ("shared", "C3", "M2", 1.0, 1.0, 2.0, day),
            ("shared", "C3", "M2", 1.0, 1.0, 9.0, day),
            (None, "C3", "M1", 5.0, 0.0, 5.0, day),
        ),
        NOW,
    )
    assert rows(bad, "adjustment_id") == [("claim bad",), ("early",), ("wrong sum",), (None,)]
    assert rows(fact, "claim_id", "adjustment_id", "final_claim_amount", "claim_year") == [
        ("C1", "cents", 0.3, 2024),
        ("C1", "second", 6.0, 2024),
        ("C2", None, 50.0, 2024),
        ("C3", None, 5.0, 2024),
    ]
    assert rows(bad_claims, "claim_id") == [("C9",)]


def test_latest_adjustment_only(spark, members, rows):
    day = D(2024, 3, 1)
    fact, _, _ = C.build_claims_fact(
        members,
        claims(spark, ("C1", "M1", day, 100.0)),
        adjustments(
            spark,
            ("a", "C1", "M1", 10.0, 0.0, 10.0, day),
            ("b", "C1", "M1", 20.0, 0.0, 20.0, D(2024, 5, 1)),
        ),
        NOW,
        latest_only=True,
        staged=False,
    )
    assert rows(fact, "adjustment_id") == [("b",)]


def test_claim_ids_used_twice(spark, rows):
    valid = claims(spark, ("C1", "M1", D(2024, 1, 1), 1.0), ("C1", "M2", D(2024, 6, 1), 1.0))
    both = adjustments(
        spark,
        ("a", "C1", "M1", 1.0, 1.0, 2.0, D(2024, 7, 1)),
        ("b", "C1", "M1", 1.0, 1.0, 2.0, D(2024, 2, 1)),
    )
    every = C.valid_adjustments(both, valid)
    once = C.valid_adjustments(both, valid, one_date_per_claim=True)
    assert rows(every, "adjustment_id") == [("a",), ("a",), ("b",)]
    assert rows(once, "adjustment_id") == [("a",), ("b",)]


def test_revenue_and_violations(spark, rows):
    revenue = spark.createDataFrame(
        [("M1", -1.0), ("M2", 0.0), ("M3", None)], schemas.REVENUE
    )
    assert rows(C.clean_revenue(revenue, NOW), "member_id") == [("M2",)]
    assert rows(C.rejected_revenue(revenue), "member_id") == [("M1",), ("M3",)]
    violations = spark.createDataFrame(
        [("V1", "M1"), ("V1", "M1"), ("V2", "M1")], schemas.VIOLATIONS
    )
    assert rows(C.clean_violations(violations, NOW), "violation_id") == [("V1",), ("V2",)]


def by_joins(spark, valid, given, latest_only=False, one_date=False):
    """The same results by the plain joins."""
    good = C.valid_adjustments(given, valid, one_date)
    return {
        "fact": C.claims_fact(valid, good, NOW, latest_only),
        "valid": good,
        "rejected": C.rejected_adjustments(given, good),
        "unused": C.joins.unused_adjustments(good, valid),
    }


@pytest.mark.parametrize("shared", [False, True])
@pytest.mark.parametrize("latest_only, one_date", [(False, False), (True, False), (False, True)])
def test_reconcile_gives_what_the_joins_give(spark, tmp_path, rows, shared, latest_only, one_date):
    import itertools

    days = [D(2024, 1, 1), D(2024, 3, 1), D(2024, 6, 1)]
    known = [(f"C{k}", f"M{k % 3}", days[k % 3], 10.0 + k) for k in range(8)]
    if shared:
        known += [("C1", "M2", days[0], 5.0), ("C1", "M1", days[2], 6.0), ("C2", "M2", days[0], 7.0)]
    valid = claims(spark, *known).withColumn("note", C.F.lit("n"))
    data = []
    for n, (claim, member, total, day) in enumerate(
        itertools.product(["C0", "C1", "C2", "C5", "C9", None], ["M0", "M1", "M2", None], [3.0, 4.0], days)
    ):
        data.append((None if n % 13 == 0 else f"A{n % 50}", claim, member, 1.0, 2.0, total, day))
    given = adjustments(spark, *data, *data[:9]).withColumn("claim_date", C.F.lit(D(2020, 2, 2)))
    given = given.withColumn("note", C.F.lit("a"))
    met = C.reconcile(valid, given, str(tmp_path / "scratch"), one_date, latest_only)
    wanted = by_joins(spark, valid, given, latest_only, one_date)
    got = {"fact": C.fact_of(met, NOW), "valid": met.valid, "rejected": met.rejected, "unused": met.unused}
    for name, df in wanted.items():
        assert set(got[name].columns) == set(df.columns), name
        assert rows(got[name], *df.columns) == rows(df), name
    assert met.n_valid == wanted["valid"].count()


def test_reconcile_of_nothing(spark, tmp_path):
    some = claims(spark, ("C1", "M1", D(2024, 1, 1), 1.0))
    met = C.reconcile(some, adjustments(spark), str(tmp_path / "a"))
    assert C.fact_of(met, NOW).count() == 1 and met.n_valid == 0 and met.rejected.count() == 0
    met = C.reconcile(claims(spark), adjustments(spark, ("a", "C1", "M1", 1.0, 1.0, 2.0, D(2024, 1, 1))), str(tmp_path / "b"))
    assert C.fact_of(met, NOW).count() == 0 and met.rejected.count() == 1


def test_only_adjustments_that_fit_are_stored_with_their_claim(spark, tmp_path, rows):
    day = dt.date(2024, 1, 1)
    claims = spark.createDataFrame(
        [("C1", "M1", day, 10.0), ("C2", "M2", day, 5.0)],
        "claim_id string, member_id string, claim_date date, claim_amount double",
    )
    given = spark.createDataFrame(
        [("A1", "C1", "M1", 1.0, 2.0, 3.0, day), ("A2", "C1", "M1", 1.0, 2.0, 4.0, day), ("A3", "C9", "M1", 1.0, 2.0, 3.0, day)],
        schemas.CLAIMS_ADJUSTMENTS,
    )
    found = C.reconcile(claims, given, str(tmp_path))
    assert rows(found.judged, "adjustment_id", "__verdict", "__claim.claim_id") == [
        ("A1", "fits", "C1"), ("A2", "failed", None), ("A3", "free", None)
    ]
    assert rows(found.adjusted, "claim_id", "adjustment_id") == [("C1", "A1")]
    assert rows(found.rejected, "adjustment_id") == [("A2",), ("A3",)]
