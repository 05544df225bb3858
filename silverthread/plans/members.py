"""Member dimension: validated history, latest version, migrated identity."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from .. import constants as K
from ..functions import member, privacy
from ..operators import joins, quality
from ..operators.latest import latest_per_key
from ..schemas import MALFORMED


def member_rules(birth_years: tuple[int, int] = K.BIRTH_YEAR_RANGE) -> list[quality.Rule]:
    """Quality rules of a historical member record."""
    return [
        *quality.not_null("legacy_member_id", "effective_date", "birth_year"),
        quality.in_range("birth_year", *birth_years),
        quality.one_of("gender", K.GENDERS),
        quality.interval_in_order("coverage_start_date", "coverage_end_date"),
    ]


def check_history(
    historical: DataFrame, birth_years: tuple[int, int] = K.BIRTH_YEAR_RANGE
) -> DataFrame:
    """Historical records with ``is_valid``.

    Copies are left in: the newest record of a member is the same with or without
    them, so only rejected records need a dedup and the history no shuffle.
    """
    return quality.flag(historical, [*quality.readable(historical), *member_rules(birth_years)])


def latest_members(valid: DataFrame) -> DataFrame:
    """Newest valid record of each legacy member, however late it arrived."""
    return latest_per_key(
        valid.drop(MALFORMED), ["legacy_member_id"], ["effective_date", "record_updated_ts"]
    )


def with_audit(df: DataFrame, processed_at: dt.datetime) -> DataFrame:
    """Add processing time and the constant status columns."""
    return df.withColumns(
        {
            "processing_timestamp": F.lit(processed_at),
            "record_status": F.lit(K.RECORD_STATUS),
            "dq_flag": F.lit(K.DQ_VALID),
        }
    )


def describe_members(
    joined: DataFrame,
    as_of: dt.date,
    processed_at: dt.datetime,
    salt: str | None = None,
) -> DataFrame:
    """Dimension columns of joined member records; personal data stays behind."""
    aged = joined.withColumns(
        {
            "age_band": member.band(member.age("birth_year", as_of)),
            "active_flag": member.active_flag("coverage_end_date", as_of),
            "masked_ssn": privacy.hashed("ssn_raw", salt),
            "member_key": privacy.hashed("member_id", salt),
            "processing_date": member.as_of_date(as_of),
        }
    )
    return with_audit(privacy.drop_phi(aged), processed_at).select(*K.DIMENSION_COLUMNS)


def dimension_from_valid(
    valid: DataFrame,
    migrated: DataFrame,
    as_of: dt.date,
    processed_at: dt.datetime,
    salt: str | None = None,
) -> DataFrame:
    """Dimension from records that passed the rules."""
    members = latest_members(valid)
    extra = [name for name in migrated.columns if name not in members.columns]
    joined = joins.join_migrated(members, migrated.select("legacy_member_id", *extra))
    return describe_members(joined, as_of, processed_at, salt)


def build_member_dimension(
    historical: DataFrame,
    migrated: DataFrame,
    as_of: dt.date,
    processed_at: dt.datetime,
    birth_years: tuple[int, int] = K.BIRTH_YEAR_RANGE,
    salt: str | None = None,
) -> quality.Split:
    """The dimension, and the historical records that broke a rule, once each."""
    split = quality.split_on_flag(check_history(historical, birth_years))
    dimension = dimension_from_valid(split.valid, migrated, as_of, processed_at, salt)
    return quality.Split(dimension, split.rejected)
