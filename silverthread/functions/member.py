"""Member attributes derived from dates. ``as_of`` replaces the wall clock."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .. import constants as K


def as_of_date(as_of: dt.date) -> Column:
    """``as_of`` as a date literal (a datetime is cut to its day)."""
    return F.lit(as_of.date() if isinstance(as_of, dt.datetime) else as_of)


def age(birth_year: str, as_of: dt.date) -> Column:
    """Calendar-year difference; month and day play no part."""
    return (F.year(as_of_date(as_of)) - F.col(birth_year)).cast("int")


def band(
    value: Column | str,
    bands: Sequence[tuple[int, int, str]] = tuple(K.AGE_BANDS),
    otherwise: str = K.OTHER_AGE_BAND,
) -> Column:
    """Label of the first inclusive band holding ``value``; null and the rest
    get ``otherwise``."""
    column = F.col(value) if isinstance(value, str) else value
    labels = [F.when(column.between(low, high), F.lit(label)) for low, high, label in bands]
    return F.coalesce(*labels, F.lit(otherwise))


def active_flag(coverage_end: str, as_of: dt.date) -> Column:
    """Active while coverage is open-ended or ends after ``as_of``."""
    end = F.col(coverage_end)
    open_now = end.isNull() | (end > as_of_date(as_of))
    return F.when(open_now, F.lit(K.ACTIVE)).otherwise(F.lit(K.TERMINATED))


def tenure_days(enrolled: str, as_of: dt.date | Column) -> Column:
    """Days from enrollment to ``as_of``."""
    day = as_of if isinstance(as_of, Column) else as_of_date(as_of)
    return F.datediff(day, F.col(enrolled))
