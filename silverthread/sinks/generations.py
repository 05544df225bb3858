"""Tables that grow by generations: what is committed, and what to merge.

A generation is a set of directories under one name, written by one batch or merged
from earlier ones. A manifest per batch lists the generations that are live after it.
Writing the manifest commits the batch: readers see the generations of the newest one,
so neither half-written directories nor replaced ones count, and a batch that runs
again starts from the manifest before it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import SparkSession


#: Generations of one order of size that are merged.
FAN = 8


class Generation(NamedTuple):
    name: str
    rows: int
    groups: int = 1


_SCHEMA = "name string, rows bigint, `groups` int"


def _fs(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, fs = _fs(spark, path)
    return fs.exists(place)


def delete(spark: SparkSession, pattern: str) -> None:
    """Remove the files and folders that a glob pattern names."""
    place, fs = _fs(spark, pattern)
    for found in fs.globStatus(place) or []:
        fs.delete(found.getPath(), True)


class Manifests:
    """Manifests of a table, one per batch, in a folder of their own."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def batches(self) -> list[int]:
        """Committed batches, ascending."""
        place, fs = _fs(self.spark, f"{self.path}/batch=*/_SUCCESS")
        found = fs.globStatus(place) or []
        return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)

    def _read(self, batch: int) -> list[Generation]:
        rows = self.spark.read.schema(_SCHEMA).parquet(f"{self.path}/batch={batch}").collect()
        return sorted(Generation(*r) for r in rows)

    def newest(self) -> list[Generation] | None:
        """Live generations; none if no batch was ever committed."""
        known = self.batches()
        return self._read(known[-1]) if known else None

    def before(self, batch: int) -> list[Generation] | None:
        """Live generations that a batch starts from."""
        known = [b for b in self.batches() if b < batch]
        return self._read(known[-1]) if known else None

    def commit(self, batch: int, live: Sequence[Generation]) -> None:
        rows = self.spark.createDataFrame([tuple(g) for g in live], _SCHEMA).coalesce(1)
        rows.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")

    def forget(self, batch: int, remove: Callable[[str], None]) -> None:
        """Remove what no batch can need again once ``batch`` has begun: generations
        that earlier manifests than the one it starts from name, and it does not."""
        known = [b for b in self.batches() if b < batch]
        if len(known) < 2:
            return
        needed = {g.name for g in self._read(known[-1])}
        for old in known[:-1]:
            for generation in self._read(old):
                if generation.name not in needed:
                    remove(generation.name)
            delete(self.spark, f"{self.path}/batch={old}")


def to_merge(live: Sequence[Generation], fan: int) -> list[Generation]:
    """Generations to merge into one: ``fan`` or more of one order of size, if any.

    So a row is written once per order of size, and there are fewer than ``fan``
    generations of each."""
    tiers: dict[int, list[Generation]] = {}
    for generation in live:
        tiers.setdefault(int(math.log(max(generation.rows, 1), fan) + 1e-9), []).append(generation)
    full = [tier for tier, found in tiers.items() if len(found) >= fan]
    return tiers[min(full)] if full else []
