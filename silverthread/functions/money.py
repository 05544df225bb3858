"""Money as exact decimals."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Holds amounts below 10^26, of which 10^10 add up without overflow.
MONEY_TYPE = "decimal(28,2)"


def money(amount: Column | str) -> Column:
    """Exact cents of an amount; NaN, infinity and overflow become null."""
    column = F.col(amount) if isinstance(amount, str) else amount
    return column.try_cast(MONEY_TYPE)


def sum_money(amount: Column | str) -> Column:
    """Order-independent sum of amounts, returned as double.

    The strict cast makes an amount that is not money fail the job rather than
    drop out of the total.
    """
    column = F.col(amount) if isinstance(amount, str) else amount
    return F.sum(column.cast(MONEY_TYPE)).cast("double")


def settled_amount(claimed: str, adjusted: str) -> Column:
    """Adjusted amount where there is one, else the claimed amount."""
    return F.coalesce(F.col(adjusted), F.col(claimed))


def amount_from_text(text: Column) -> Column:
    """Double from JSON text, null when the text is not a number."""
    return text.try_cast("double")
