"""Masking of identifiers and removal of personal data."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as K


def hashed(column: Column | str, salt: str | None = None) -> Column:
    """SHA-256 hex of the text of a column, optionally salted; null stays null."""
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.sha2(text if salt is None else F.concat(F.lit(salt), text), 256)


def drop_phi(df: DataFrame, columns: Iterable[str] = tuple(K.PHI_COLUMNS)) -> DataFrame:
    """Drop the personal-data columns that ``df`` has."""
    return df.drop(*columns)


def masked(df: DataFrame, columns: Iterable[str], salt: str | None = None) -> DataFrame:
    """Replace the named columns that ``df`` has by their hashes."""
    present = [name for name in columns if name in df.columns]
    return df.withColumns({name: hashed(name, salt) for name in present}) if present else df
