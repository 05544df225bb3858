"""Whether the rows of a run add up."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from ..sources import driver_rows

#: A name, the counts on its left and those on its right.
Equation = tuple[str, Sequence[str], Sequence[str]]


class Unbalanced(Exception):
    """Rows were lost or doubled between two points of a run."""


def check_balance(
    counts: Mapping[str, int],
    equations: Sequence[Equation],
    recount: Mapping[str, Callable[[], int]] | None = None,
) -> dict[str, tuple[int, int]]:
    """Sums of both sides of each equation; raises :class:`Unbalanced` if two differ.

    Counts that were observed while a stage ran may be too high where tasks were lost
    and run again. Before a difference counts as one, those that ``recount`` can count
    by a job of their own are counted anew.
    """
    recount = dict(recount or {})

    def sides(known: Mapping[str, int]) -> dict[str, tuple[int, int]]:
        return {
            name: (sum(known[n] for n in left), sum(known[n] for n in right))
            for name, left, right in equations
        }

    found = sides(counts)
    if any(a != b for a, b in found.values()) and recount:
        known = dict(counts)
        known.update({name: count() for name, count in recount.items()})
        found = sides(known)
    off = [f"{name}: {a} and {b}" for name, (a, b) in found.items() if a != b]
    if off:
        raise Unbalanced("; ".join(off))
    return found


def balance_rows(spark: SparkSession, run_id: str, job_name: str, found: Mapping[str, tuple[int, int]]) -> DataFrame:
    """What was compared, as rows of the balance table."""
    rows = [(run_id, job_name, name, a, b) for name, (a, b) in found.items()]
    return driver_rows(spark, rows, schemas.RUN_BALANCE)
