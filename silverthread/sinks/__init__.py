"""Writing tables."""

from .tables import (
    append_rows,
    cluster_for_write,
    rebalance_for_write,
    stage,
    write_counted,
    write_partitioned,
    write_snapshot,
    write_table,
    write_together,
)

__all__ = [
    "append_rows",
    "cluster_for_write",
    "rebalance_for_write",
    "stage",
    "write_counted",
    "write_partitioned",
    "write_snapshot",
    "write_table",
    "write_together",
]
