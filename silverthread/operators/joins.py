"""Joins that survive hot keys.

No join here carries a broadcast hint: Spark broadcasts a side only when its
size, from statistics or measured at run time, is under
``spark.sql.autoBroadcastJoinThreshold``. Larger sides are shuffled and AQE
splits the partitions that hot keys make large.

AQE can split only where both inputs of a join are plain shuffles. An input that
is already partitioned by the key (an aggregate or a window) would be joined in
place and not be split. One bit of the key's own hash prevents that: added to a
join or grouping key it changes no match and no group, but makes the partitioning
differ from what the next join asks for. The input that is then shuffled once
more is the reduced one, one row per key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

_BIT = "__key_bit"


def _bit(*keys: str | Column) -> Column:
    return F.hash(*keys).bitwiseAND(F.lit(1))


def hot_key_join(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str
) -> DataFrame:
    """Equi-join whose skewed partitions AQE can always split.

    The bit is taken from the keys in the type that both sides have in common, so
    keys of different types (int and bigint, say) match as in a plain join.
    """
    keys = [on] if isinstance(on, str) else list(on)
    common = left.select(*keys).union(right.select(*keys)).schema
    bit = _bit(*[F.col(f.name).cast(f.dataType) for f in common.fields])
    tagged = [df.withColumn(_BIT, bit) for df in (left, right)]
    return tagged[0].join(tagged[1], [*keys, _BIT], how).drop(_BIT)


def unique_keys(df: DataFrame, key: str) -> DataFrame:
    """Distinct non-null keys, not partitioned by the key. Copies collapse before
    the shuffle."""
    keys = df.select(key, _bit(key).alias(_BIT)).filter(F.col(key).isNotNull())
    return keys.distinct().drop(_BIT)


def flag_parent(df: DataFrame, parent: DataFrame, key: str, name: str) -> DataFrame:
    """Add whether ``key`` exists in ``parent``; keeps every row once."""
    known = unique_keys(parent, key).withColumn(name, F.lit(True))
    found = df.join(known, key, "left")
    return found.select(*df.columns, F.coalesce(name, F.lit(False)).alias(name))


def require_parent(df: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` exists in ``parent``, each once however often the
    parent lists it."""
    return df.join(unique_keys(parent, key), key, "left_semi").select(*df.columns)


def without_match(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` is null or not in ``other``, copies included."""
    return df.join(unique_keys(other, key), key, "left_anti").select(*df.columns)


def join_migrated(members: DataFrame, migrated: DataFrame) -> DataFrame:
    """Members with their migrated record; members without one drop out, and a
    legacy id that was migrated twice gives two rows."""
    return hot_key_join(members, migrated, "legacy_member_id", "inner")


def adjust_with_claim(adjustments: DataFrame, claims: DataFrame) -> DataFrame:
    """Adjustments with the date of the claim they belong to."""
    return hot_key_join(adjustments, claims.select("claim_id", "claim_date"), "claim_id", "inner")


def claims_with_adjustments(claims: DataFrame, adjustments: DataFrame) -> DataFrame:
    """Claims with their adjustments by claim and member; a claim adjusted twice
    gives two rows, a claim never adjusted one.

    An inner join, which AQE can split on both sides, and the claims without an
    adjustment: an outer join could be split on the left side only. A further column
    that both have comes from the adjustment as ``adjustment_<name>``.
    """
    keys = ["claim_id", "member_id"]
    both = [c for c in adjustments.columns if c in claims.columns and c not in keys]
    adjustments = adjustments.withColumnsRenamed({c: f"adjustment_{c}" for c in both})
    adjusted = hot_key_join(claims, adjustments, keys, "inner")
    known = adjustments.select(*keys).distinct()
    other = hot_key_join(claims, known, keys, "left_anti")
    return adjusted.unionByName(other, allowMissingColumns=True)


def unused_adjustments(adjustments: DataFrame, claims: DataFrame) -> DataFrame:
    """Adjustments that no claim takes up, as they name another member."""
    keys = ["claim_id", "member_id"]
    return hot_key_join(adjustments, claims.select(*keys).distinct(), keys, "left_anti").select(
        *adjustments.columns
    )


def join_aggregates(df: DataFrame, aggregates: Sequence[DataFrame], key: str) -> DataFrame:
    """``df`` with the columns of several frames that are unique on ``key``.

    The frames are merged first, then joined once, so ``df`` is shuffled once
    whatever their number.
    """
    if len(aggregates) == 1:
        return hot_key_join(df, aggregates[0], key, "left")
    wide = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), aggregates)
    values = [name for name in wide.columns if name != key]
    merged = wide.groupBy(key).agg(*[F.max(name).alias(name) for name in values])
    return hot_key_join(df, merged, key, "left")
