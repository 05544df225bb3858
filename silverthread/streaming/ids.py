"""Ids already seen, in hash buckets with a Bloom filter each.

A batch of ids is tested against the filters; only the buckets of ids that may be
stored are read, and these ids are compared exactly. Every batch adds a generation of
buckets, and generations of one order of size are merged, so a bucket holds a bounded
number of ids and a batch meets a number of generations that grows with the logarithm
of what is stored.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sinks import stage
from ..sinks.generations import FAN, Generation, Manifests, delete, to_merge

#: Ids of a bucket; a batch reads whole buckets.
IDS_PER_BUCKET = 1 << 18
#: Bits of a filter per id, and bits that an id sets: of ids never stored, about one in
#: ten thousand has them all set by others.
BITS_PER_ID, PROBES = 20, 10
#: Most rows of ids that a join may broadcast. The size of their files, by which Spark
#: decides, says little: compressed, they can take a hundredth of the hash table that the
#: driver builds of them.
BROADCAST_IDS = 100_000


def by_rows(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of ``rows`` rows at most, as a side of a join that broadcasts neither side
    if there are many, whatever size Spark takes them to have."""
    return df if rows <= BROADCAST_IDS else df.hint("merge")


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")


def _positions(bits: Column | int) -> list[Column]:
    """The bits that ``id`` sets in a filter of that size."""
    bits = F.lit(bits) if isinstance(bits, int) else bits
    start = F.shiftrightunsigned(F.xxhash64(F.lit(1), "id"), 33)
    step = F.shiftrightunsigned(F.xxhash64(F.lit(2), "id"), 33)
    return [(start + step * F.lit(k)) % bits for k in range(PROBES)]


class IdIndex:
    """A growing set of distinct ids below ``path``, which executors share."""

    def __init__(
        self, spark: SparkSession, path: str, ids_per_bucket: int = IDS_PER_BUCKET, fan: int = FAN
    ) -> None:
        self.spark, self.path = spark, path
        self.ids_per_bucket, self.fan = ids_per_bucket, fan
        self.manifests = Manifests(spark, f"{path}/manifests")
        #: Buckets and ids that the last :meth:`seen` has read, and ids that are stored.
        self.buckets_read = self.ids_read = self.ids_stored = 0

    def _ids(self, generations: Sequence[Generation]) -> DataFrame:
        return self._read("ids", [f"generation={g.name}" for g in generations], "id string, generation string, bucket int")

    def _read(self, kind: str, places: Sequence[str], schema: str) -> DataFrame:
        base = f"{self.path}/{kind}"
        reader = self.spark.read.schema(schema).option("basePath", base)
        return reader.parquet(*[f"{base}/{place}" for place in places])

    def seen(self, ids: DataFrame, batch: int, scratch: str, most: int | None = None) -> DataFrame:
        """Those of the distinct ``ids`` (a column ``id``) that batches before ``batch``
        have added. ``scratch`` is a folder that the result reads from; ``most`` says how
        many ids there are at most, and they are counted without it."""
        live = self.manifests.before(batch) or []
        self.buckets_read = self.ids_read = 0
        self.ids_stored = sum(g.rows for g in live)
        if not live:
            return ids.limit(0)
        most = ids.count() if most is None else most
        places = [
            F.struct(F.lit(g.name).alias("generation"), _bucket(g.groups).alias("bucket")) for g in live
        ]
        filters = self._read(
            "filters", [f"generation={g.name}" for g in live],
            "bucket int, n bigint, bits bigint, words array<bigint>, generation string",
        )
        placed = by_rows(ids.select("id", F.inline(F.array(*places))), most * len(live))
        tested = placed.join(filters, ["generation", "bucket"])
        word = lambda at: F.get("words", F.floor(at / 64).cast("int"))
        set_ = [F.getbit(word(at), (at % 64).cast("int")) == 1 for at in _positions(F.col("bits"))]
        maybe, _ = stage(
            tested.where(reduce(lambda a, b: a & b, set_)).select("id", "generation", "bucket", "n"),
            f"{scratch}/maybe",
        )
        # One row per bucket to read; there are as many as filters at most.
        hit = maybe.select("generation", "bucket", "n").distinct().collect()
        self.buckets_read, self.ids_read = len(hit), sum(r.n for r in hit)
        if not hit:
            return ids.limit(0)
        stored = self._read(
            "ids", [f"generation={r.generation}/bucket={r.bucket}" for r in hit],
            "id string, generation string, bucket int",
        )
        stored = by_rows(stored, self.ids_read)
        return maybe.join(stored, ["generation", "bucket", "id"], "left_semi").select("id").distinct()

    def add(self, ids: DataFrame, batch: int) -> None:
        """Add the distinct ``ids``, none of which is stored, and commit the batch."""
        self.manifests.forget(batch, self._remove)
        live = self.manifests.before(batch) or []
        rows = ids.count()
        if rows:
            live.append(self._write(ids.select("id"), f"{batch}", rows))
        merged = 0
        while found := to_merge(live, self.fan):
            rest = [g for g in live if g not in found]
            together = self._ids(found).select("id")
            live = [*rest, self._write(together, f"{batch}-{merged}", sum(g.rows for g in found))]
            merged += 1
        self.manifests.commit(batch, live)

    def _write(self, ids: DataFrame, name: str, rows: int) -> Generation:
        buckets = -(-rows // self.ids_per_bucket)
        words = -(-(-(-rows // buckets)) * BITS_PER_ID // 64)
        place = f"{self.path}/ids/generation={name}"
        (
            ids.withColumn("bucket", _bucket(buckets))
            .hint("rebalance", "bucket")
            .sortWithinPartitions("bucket", "id")
            .write.mode("overwrite").partitionBy("bucket").parquet(place)
        )
        made = Generation(name, rows, buckets)
        stored = self._ids([made])
        each = stored.select("bucket", F.explode(F.array(*_positions(words * 64))).alias("at"))
        marks = each.selectExpr("bucket", "at div 64 AS word", "shiftleft(1L, CAST(at % 64 AS INT)) AS mark")
        blank = self.spark.range(buckets * words).selectExpr(
            f"CAST(id div {words} AS INT) AS bucket", f"id % {words} AS word", "0L AS mark"
        )
        filled = marks.unionAll(blank).groupBy("bucket", "word").agg(F.bit_or("mark").alias("mark"))
        in_order = F.sort_array(F.collect_list(F.struct("word", "mark")))
        filters = filled.groupBy("bucket").agg(in_order["mark"].alias("words"))
        counts = stored.groupBy("bucket").agg(F.count("*").alias("n"))
        (
            filters.join(counts, "bucket")
            .select("bucket", "n", F.lit(words * 64).cast("bigint").alias("bits"), "words")
            .write.mode("overwrite").parquet(f"{self.path}/filters/generation={name}")
        )
        return made

    def _remove(self, name: str) -> None:
        for kind in ("ids", "filters"):
            delete(self.spark, f"{self.path}/{kind}/generation={name}")

