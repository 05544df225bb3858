"""Reading raw and curated tables."""

from .files import (
    active_members,
    driver_rows,
    dated_partition,
    latest_partition,
    parse_events,
    read_csv,
    read_events,
    read_table,
)

__all__ = [
    "active_members",
    "driver_rows",
    "dated_partition",
    "latest_partition",
    "parse_events",
    "read_csv",
    "read_events",
    "read_table",
]
