"""Gold measures of one member row."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import constants as K


def lifetime_value(revenue: str, claims: str) -> Column:
    """Revenue minus claims, exact to the cent."""
    exact = "decimal(28,2)"
    return (F.col(revenue).cast(exact) - F.col(claims).cast(exact)).cast("double")


def engagement(*event_counts: str) -> Column:
    """Natural log of one plus the number of events."""
    total = F.lit(1)
    for name in event_counts:
        total = total + F.col(name)
    return F.log(total)


def risk_tier(
    violations: str,
    claim_amount: str,
    high_violations: float = K.HIGH_RISK_VIOLATIONS,
    high_amount: float = K.HIGH_RISK_CLAIM_AMOUNT,
) -> Column:
    """HIGH above either threshold, MEDIUM with any violation, else LOW."""
    count, amount = F.col(violations), F.col(claim_amount)
    return F.coalesce(
        F.when((count > high_violations) | (amount > high_amount), F.lit(K.RISK_HIGH)),
        F.when(count > 0, F.lit(K.RISK_MEDIUM)),
        F.lit(K.RISK_LOW),
    )


def churn_flag(*event_counts: str) -> Column:
    """High churn risk when every event count is zero."""
    silent = F.lit(True)
    for name in event_counts:
        silent = silent & (F.col(name) == 0)
    return F.when(silent, F.lit(K.CHURN_HIGH)).otherwise(F.lit(K.CHURN_STABLE))
