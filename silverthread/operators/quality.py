"""Declarative row rules and the valid / rejected split.

A rule that evaluates to null does not hold. The split therefore keys on one
never-null flag computed in a single pass, which also works on a stream, in
place of subtracting the valid rows from all rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.money import money
from ..schemas import MALFORMED


@dataclass(frozen=True)
class Rule:
    """A named condition a row must meet."""

    name: str
    holds: Column


class Split(NamedTuple):
    """Rows that meet every rule, and the rest."""

    valid: DataFrame
    rejected: DataFrame


def not_null(*columns: str) -> list[Rule]:
    return [Rule(f"{name}_missing", F.col(name).isNotNull()) for name in columns]


def in_range(column: str, low: float, high: float) -> Rule:
    """Inclusive on both ends."""
    return Rule(f"{column}_out_of_range", F.col(column).between(low, high))


def one_of(column: str, values: Sequence[str]) -> Rule:
    return Rule(f"{column}_unknown", F.col(column).isin(*values))


def positive(column: str) -> Rule:
    return Rule(f"{column}_not_positive", F.col(column) > 0)


def non_negative_money(column: str) -> Rule:
    """Zero or more, and an amount that exact cents can hold (NaN is not)."""
    held = (F.col(column) >= 0) & money(column).isNotNull()
    return Rule(f"{column}_negative_or_not_money", held)


def interval_in_order(start: str, end: str) -> Rule:
    """An open end is fine; a closed one needs a start on or before it."""
    return Rule(f"{end}_before_{start}", F.col(end).isNull() | (F.col(start) <= F.col(end)))


def adds_up(first: str, second: str, total: str) -> Rule:
    """Two amounts make the third, compared as exact cents."""
    return Rule(f"{total}_inconsistent", money(first) + money(second) == money(total))


def not_before(later: str, earlier: str) -> Rule:
    return Rule(f"{later}_before_{earlier}", F.col(later) >= F.col(earlier))


def readable(df: DataFrame) -> list[Rule]:
    """Reject records kept as unreadable text, where the read kept them."""
    return [Rule("malformed", F.col(MALFORMED).isNull())] if MALFORMED in df.columns else []


def all_hold(rules: Sequence[Rule]) -> Column:
    """True when every rule holds; false otherwise, never null."""
    return F.coalesce(reduce(lambda a, b: a & b, [rule.holds for rule in rules]), F.lit(False))


def broken_rules(rules: Sequence[Rule]) -> Column:
    """Names of the rules a row breaks."""
    names = [F.when(~F.coalesce(rule.holds, F.lit(False)), F.lit(rule.name)) for rule in rules]
    return F.array_compact(F.array(*names))


def flag(df: DataFrame, rules: Sequence[Rule], name: str = "is_valid") -> DataFrame:
    """Add the never-null verdict of ``rules``."""
    return df.withColumn(name, all_hold(rules))


def split_on_flag(df: DataFrame, name: str = "is_valid", distinct_rejects: bool = True) -> Split:
    """Split a flagged frame; see :func:`split_by_rules`."""
    rejected = df.filter(~F.col(name)).drop(name)
    return Split(
        df.filter(F.col(name)).drop(name),
        rejected.distinct() if distinct_rejects else rejected,
    )


def split_by_rules(
    df: DataFrame, rules: Sequence[Rule], distinct_rejects: bool = True
) -> Split:
    """Valid rows as they come, rejected rows once each.

    Pass ``distinct_rejects=False`` when ``df`` holds no copies already (saves
    the shuffle) or on a stream.
    """
    return split_on_flag(flag(df, rules), distinct_rejects=distinct_rejects)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Exact whole-row dedup. Copies collapse before the shuffle, and the rest
    spread by a hash of all columns, so hot copies stay cheap."""
    return df.dropDuplicates()


def distinct_row_count(df: DataFrame) -> DataFrame:
    """Number of distinct rows, as one row ``records``.

    Rows are compared by a 128-bit digest, so 16 bytes per row are shuffled in
    place of the row. Hashing skips nulls, so their places are part of it; nested
    columns go in as JSON text that spells their nulls out.
    """
    nested = (T.StructType, T.ArrayType, T.MapType)
    parts = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, nested):
            value = F.to_json(F.struct(value), {"ignoreNullFields": "false"})
        parts += [value, F.col(f"`{field.name}`").isNull()]
    digest = df.select(
        F.xxhash64(*parts).alias("low"), F.xxhash64(F.lit(1), *parts).alias("high")
    )
    return digest.distinct().agg(F.count(F.lit(1)).alias("records"))


def except_distinct(df: DataFrame, other: DataFrame) -> DataFrame:
    """Distinct rows of ``df`` that are not in ``other``, by column position and
    null-safe.

    One aggregate over both, so copies on either side collapse before the single
    shuffle. Where ``other`` is a filter of ``df``, a split needs one side only.
    """
    side = "__side"
    left = df.withColumn(side, F.lit(0))
    right = other.toDF(*df.columns).withColumn(side, F.lit(1))
    sides = left.union(right).groupBy(*df.columns).agg(F.max(side).alias(side))
    return sides.filter(F.col(side) == 0).drop(side)


def union_by_name(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, matched by column name; a column a frame lacks is
    null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
