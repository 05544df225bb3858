"""Results kept up to date day by day in place of being computed anew."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators import aggregates as A
from ..operators.latest import latest_per_key
from ..sinks.generations import Generation, Manifests, delete

#: Buckets of a table of newest rows: at least as many as a shuffle has partitions, or
#: Spark would rather shuffle both sides of the merge.
BUCKETS = 200


class NewestRows:
    """The newest row of every key, stored in buckets of the key and merged with each
    day's rows.

    The stored side of a merge is read bucket by bucket as it lies; only the newest row
    per key of the new day is shuffled. Every merge writes a version of its own and then
    commits it, so readers see whole versions and a merge that runs again starts from
    the one before it. Dates may come in any order: what decides is ``newest_by``, then
    ``tie_break`` (all other columns by default), as in :func:`latest_per_key`.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        newest_by: Sequence[str],
        tie_break: Sequence[str] | None = None,
        buckets: int = BUCKETS,
    ) -> None:
        self.spark, self.path, self.schema = spark, path, schema
        self.keys, self.newest_by, self.buckets = list(keys), list(newest_by), buckets
        others = [n for n in schema.names if n not in (*keys, *newest_by)]
        self.tie_break = others if tie_break is None else list(tie_break)
        self.manifests = Manifests(spark, f"{path}/manifests")

    def _table(self, name: str) -> str:
        """The session's name for a version; buckets are a property of a named table."""
        table = f"newest_{abs(hash((self.path, name))):x}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        keys = ", ".join(f"`{k}`" for k in self.keys)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
            f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.path}/version={name}'"
        )
        return table

    def _stored(self, live: list[Generation] | None) -> DataFrame:
        if not live:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.table(self._table(live[0].name))

    def read(self) -> DataFrame:
        """The newest rows of all days merged so far."""
        return self._stored(self.manifests.newest())

    def merged(self, stored: DataFrame, new: DataFrame) -> DataFrame:
        """The newest row of each key of both; keys may be null."""
        order = [*self.newest_by, *self.tie_break]
        rest = [n for n in self.schema.names if n not in self.keys and n not in order]
        # Structs compare field by field with nulls lowest, which is nulls last here.
        packed = F.struct(*order, *rest)
        newest = latest_per_key(new.select(*self.schema.names), self.keys, self.newest_by, self.tie_break)
        known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in self.keys])
        left = stored.where(known).select(*self.keys, packed.alias("__old"))
        right = newest.where(known).select(
            *[F.col(k).alias(f"__{k}") for k in self.keys], packed.alias("__new")
        )
        # Plain equality, by which the stored buckets can be joined as they lie.
        same = [F.col(k) == F.col(f"__{k}") for k in self.keys]
        both = left.join(right, same, "full_outer").select(
            *[F.coalesce(k, f"__{k}").alias(k) for k in self.keys],
            F.greatest("__old", "__new").alias("__row"),
        ).select(*self.keys, "__row.*").select(*self.schema.names)
        # Keys with a null meet apart; there is one row of each on either side.
        rest = stored.where(~known).unionByName(newest.where(~known))
        return both.unionByName(latest_per_key(rest, self.keys, self.newest_by, self.tie_break))

    def merge(self, new: DataFrame, day: int) -> None:
        """Merge the rows of a day, numbered in the order of merging, and commit."""

        def remove(name: str) -> None:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(name)}")
            delete(self.spark, f"{self.path}/version={name}")

        self.manifests.forget(day, remove)
        rows = self.merged(self._stored(self.manifests.before(day)), new)
        table = self._table(f"{day}")
        rows.write.insertInto(table, overwrite=True)
        self.spark.catalog.refreshTable(table)
        self.manifests.commit(day, [Generation(f"{day}", 0)])


class PartialSums:
    """Measures of fact tables as partial sums per day of loading and member.

    A day that is loaded again replaces its own partials, which takes back what it had
    added, maxima too; reading adds up one row per member and day, whatever the number
    of facts behind it.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, key_type: str, measures: Sequence[A.Measure]) -> None:
        self.spark, self.path, self.key, self.measures = spark, path, key, list(measures)
        schema = T.StructType().add(key, key_type)
        kinds = {"money": T.DecimalType(38, 2), "count": T.LongType(), "max": T.StringType()}
        for m in self.measures:
            schema = schema.add(m.name, kinds[m.how])
        self.schema = schema.add("day", "string")

    def load(self, facts: Sequence[tuple[DataFrame, Sequence[A.Measure]]], day: str) -> None:
        """Store the partials of the facts of one day, in place of those it had."""
        found = A.partial_facts(facts, self.key)
        kept = [m.name for m in self.measures]
        missing = {n: F.lit(None).cast(self.schema[n].dataType) for n in kept if n not in found.columns}
        rows = found.withColumns(missing).select(
            self.key, *[F.col(n).cast(self.schema[n].dataType).alias(n) for n in kept]
        )
        rows.write.mode("overwrite").parquet(f"{self.path}/day={day}")

    def read(self) -> DataFrame:
        """The measures of all days, one row per key."""
        stored = self.spark.read.schema(self.schema).parquet(self.path)
        return A.merged_facts(stored, self.key, self.measures)


