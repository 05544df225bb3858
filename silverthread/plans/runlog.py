"""Log of pipeline runs."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from .. import constants as K, schemas
from ..sinks import append_rows
from ..sources import driver_rows


def new_run_id(now: dt.datetime | None = None) -> str:
    """Run id from the time, with a suffix so that two runs never share one."""
    moment = now or dt.datetime.now()
    return f"run_{moment:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"


@dataclass
class Run:
    """What a run reports; a runner fills the counts as it goes."""

    job_name: str
    run_id: str
    start_time: dt.datetime
    processed: int = 0
    failed: int = 0
    counts: dict[str, int] = field(default_factory=dict)
    #: Rows at further points of the run, which its balance compares.
    points: dict[str, int] = field(default_factory=dict)


def log_row(
    spark: SparkSession, run: Run, status: str, end_time: dt.datetime
) -> DataFrame:
    """The log entry of a run, as one row."""
    row = (
        run.run_id,
        run.job_name,
        run.processed,
        run.failed,
        run.start_time,
        end_time,
        status,
    )
    return driver_rows(spark, [row], schemas.RUN_LOG)


@contextmanager
def logged_run(spark: SparkSession, job_name: str, log_path: str) -> Iterator[Run]:
    """Run a block and append its entry to the log, whether it ends or fails."""
    started = dt.datetime.now()
    run = Run(job_name, new_run_id(started), started)
    status = K.FAILED
    try:
        yield run
        status = K.SUCCESS
    finally:
        append_rows(log_row(spark, run, status, dt.datetime.now()), log_path)
