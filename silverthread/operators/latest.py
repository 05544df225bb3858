"""Latest version of each entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F, types as T

_UNORDERED = (T.MapType, T.VariantType)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    newest_by: Sequence[str],
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the largest by ``newest_by``, nulls last.

    Ties are settled by ``tie_break``, by default all other columns, so that a
    recomputed task picks the same row. Spark keeps one row per key and task
    before the shuffle, so a hot key costs its reducer one row per task.
    """
    if tie_break is None:
        used = {*keys, *newest_by}
        tie_break = [
            field.name
            for field in df.schema.fields
            if field.name not in used and not isinstance(field.dataType, _UNORDERED)
        ]
    order = [F.col(name).desc_nulls_last() for name in (*newest_by, *tie_break)]
    position = "__position"
    ranked = df.withColumn(
        position, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.filter(F.col(position) == 1).drop(position)
