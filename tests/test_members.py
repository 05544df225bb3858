import datetime as dt
import hashlib

from silverthread import constants as K, schemas
from silverthread.plans import members as M

AS_OF = dt.date(2025, 6, 30)
NOW = dt.datetime(2025, 6, 30, 8)
D = dt.date


def history(spark, *changes):
    """Valid records with the given fields changed."""
    base = dict(
        legacy_member_id="L1",
        effective_date=D(2024, 1, 1),
        record_updated_ts=dt.datetime(2024, 1, 2),
        birth_year=1990,
        gender="F",
        coverage_start_date=D(2024, 1, 1),
        coverage_end_date=None,
        policy_id="P1",
        policy_type="HMO",
        state="01",
        enrollment_date=D(2023, 1, 1),
        member_segment="gold",
    )
    schema = schemas.HISTORICAL_MEMBER_POLICY
    data = [tuple({**base, **change}[name] for name in schema.names) for change in changes]
    return spark.createDataFrame(data, schema)


def migrated(spark, *pairs):
    data = [
        (legacy, member, ssn, "Ann", "Lee", "a@b", "1", "street", "city", "00123", "Y")
        for legacy, member, ssn in pairs
    ]
    return spark.createDataFrame(data, schemas.MIGRATED_MEMBERS)


def build(spark, historical, migration=(("L1", "M1", "123"),)):
    return M.build_member_dimension(historical, migrated(spark, *migration), AS_OF, NOW)


def test_rules_at_their_edges(spark, rows):
    cases = {
        "ok": {},
        "no id": {"legacy_member_id": None},
        "no date": {"effective_date": None},
        "no year": {"birth_year": None},
        "1899": {"birth_year": 1899},
        "1900": {"birth_year": 1900},
        "2025": {"birth_year": 2025},
        "2026": {"birth_year": 2026},
        "no gender": {"gender": None},
        "gender X": {"gender": "X"},
        "backwards": {"coverage_end_date": D(2023, 12, 31)},
        "same day": {"coverage_end_date": D(2024, 1, 1)},
        "no start": {"coverage_start_date": None, "coverage_end_date": D(2024, 1, 1)},
    }
    df = history(spark, *[{**change, "policy_id": name} for name, change in cases.items()])
    split = M.quality.split_on_flag(M.check_history(df))
    assert rows(split.valid, "policy_id") == [("1900",), ("2025",), ("ok",), ("same day",)]
    assert split.rejected.count() == len(cases) - 4


def test_rejected_copies_come_once(spark):
    split = build(spark, history(spark, *[{"gender": "X"}] * 3, {}))
    assert split.rejected.count() == 1 and split.valid.count() == 1


def test_latest_version_wins_however_late_it_arrives(spark, rows):
    df = history(
        spark,
        {"effective_date": D(2024, 5, 1), "policy_id": "new"},
        {"effective_date": D(2024, 1, 1), "policy_id": "old", "record_updated_ts": dt.datetime(2025, 1, 1)},
        {"effective_date": D(2024, 5, 1), "policy_id": "unstamped", "record_updated_ts": None},
    )
    assert rows(build(spark, df).valid, "policy_id") == [("new",)]


def test_full_ties_give_one_row_in_any_partitioning(spark):
    df = history(spark, *[{"policy_id": f"P{i}"} for i in range(20)])
    picks = {M.latest_members(df.repartition(n)).first()["policy_id"] for n in (1, 3, 7)}
    assert picks == {"P9"}


def test_unmatched_members_vanish_and_double_migrations_fan_out(spark, rows):
    df = history(spark, {}, {"legacy_member_id": "L2"}, {"legacy_member_id": "L3"})
    dimension = build(spark, df, [("L1", "M1", "1"), ("L2", "M2", None), ("L2", "M2b", "2")]).valid
    assert rows(dimension, "legacy_member_id", "member_id") == [
        ("L1", "M1"),
        ("L2", "M2"),
        ("L2", "M2b"),
    ]


def test_columns_masking_and_flags(spark):
    df = history(spark, {"coverage_end_date": AS_OF})
    dimension = build(spark, df).valid
    assert dimension.columns == K.DIMENSION_COLUMNS
    assert not set(K.PHI_COLUMNS) & set(dimension.columns)
    row = dimension.first()
    assert row["active_flag"] == "Terminated" and row["age_band"] == "35-44"
    assert row["masked_ssn"] == hashlib.sha256(b"123").hexdigest()
    assert row["member_key"] == hashlib.sha256(b"M1").hexdigest()
    assert row["processing_date"] == AS_OF and row["state"] == "01"
    assert (row["record_status"], row["dq_flag"]) == ("ACTIVE", "VALID")
