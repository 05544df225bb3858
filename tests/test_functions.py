import datetime as dt
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from silverthread import schemas
from silverthread.functions import member, money, privacy, scoring

AS_OF = dt.date(2025, 6, 30)


@pytest.mark.parametrize(
    "age, label",
    [
        (17, "55+"),
        (18, "18-24"),
        (24, "18-24"),
        (25, "25-34"),
        (34, "25-34"),
        (35, "35-44"),
        (44, "35-44"),
        (45, "45-54"),
        (54, "45-54"),
        (55, "55+"),
        (None, "55+"),
    ],
)
def test_age_band(spark, age, label):
    df = spark.createDataFrame([(None if age is None else 2025 - age,)], "birth_year int")
    years = member.age("birth_year", AS_OF)
    assert tuple(df.select(years, member.band(years)).first()) == (age, label)


def test_active_flag_ends_on_the_day(spark):
    df = spark.createDataFrame(
        [(None,), (AS_OF,), (AS_OF + dt.timedelta(1),), (AS_OF - dt.timedelta(1),)], "d date"
    )
    found = [r[0] for r in df.select(member.active_flag("d", AS_OF)).collect()]
    assert found == ["Active", "Terminated", "Active", "Terminated"]


def test_as_of_takes_a_datetime(spark):
    df = spark.createDataFrame([(dt.date(2025, 6, 1),)], "d date")
    moment = dt.datetime(2025, 6, 30, 23, 59)
    assert df.select(member.tenure_days("d", moment)).first()[0] == 29


def test_hash_of_text_and_null(spark):
    df = spark.createDataFrame([("0123",), (None,)], "s string")
    found = df.select(privacy.hashed("s"), privacy.hashed("s", "x")).collect()
    assert tuple(found[0]) == (
        hashlib.sha256(b"0123").hexdigest(),
        hashlib.sha256(b"x0123").hexdigest(),
    )
    assert tuple(found[1]) == (None, None)


def test_masked_leaves_absent_columns_alone(spark):
    df = spark.createDataFrame([("a", 1)], "email string, n int")
    masked = privacy.masked(df, ["email", "city"])
    assert masked.columns == ["email", "n"]
    assert masked.first()["email"] == hashlib.sha256(b"a").hexdigest()


def test_money_is_exact_and_never_fails(spark):
    df = spark.createDataFrame(
        [(0.1, 0.2, 0.3), (float("nan"), 1.0, 1.0), (1e300, 0.0, 0.0)],
        "a double, b double, c double",
    )
    equal = money.money("a") + money.money("b") == money.money("c")
    assert [r[0] for r in df.select(equal).collect()] == [True, None, None]


def test_sum_money_has_no_rounding_noise(spark):
    df = spark.range(10).select(F.lit(0.1).alias("a"))
    assert df.agg(money.sum_money("a")).first()[0] == 1.0


def test_amount_from_text(spark):
    df = spark.createDataFrame([("12.5",), ("abc",), (None,), ("7",)], "t string")
    assert [r[0] for r in df.select(money.amount_from_text(F.col("t"))).collect()] == [
        12.5,
        None,
        None,
        7.0,
    ]


@pytest.mark.parametrize(
    "violations, amount, tier",
    [
        (0, 100000.0, "LOW"),
        (0, 100000.01, "HIGH"),
        (1, 0.0, "MEDIUM"),
        (5, 0.0, "MEDIUM"),
        (6, 0.0, "HIGH"),
    ],
)
def test_risk_tier(spark, violations, amount, tier):
    df = spark.createDataFrame([(violations, amount)], "v bigint, a double")
    assert df.select(scoring.risk_tier("v", "a")).first()[0] == tier


def test_engagement_and_churn(spark):
    df = spark.createDataFrame([(0, 0), (2, 3)], "a bigint, b bigint")
    found = df.select(scoring.engagement("a", "b"), scoring.churn_flag("a", "b")).collect()
    assert tuple(found[0]) == (0.0, "HIGH_CHURN_RISK")
    assert found[1][0] == pytest.approx(math.log(6)) and found[1][1] == "STABLE"


def test_schemas_have_a_place_for_unreadable_records():
    assert schemas.with_malformed(schemas.CLAIMS).names == [*schemas.CLAIMS.names, schemas.MALFORMED]


def test_large_amounts_are_money(spark):
    from silverthread.functions.money import money
    from silverthread.operators import aggregates as A

    df = spark.createDataFrame([(1, 1e17), (1, 2e20), (2, 1e27)], "k int, v double")
    held = {r.v: r.m for r in df.select("v", money("v").isNotNull().alias("m")).collect()}
    assert held == {1e17: True, 2e20: True, 1e27: False}
    summed = A.aggregate_fact(df.where("k = 1"), "k", [A.Measure("s", "v", "money")]).first().s
    assert summed == 1e17 + 2e20
