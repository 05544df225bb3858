"""Ids kept in buckets with Bloom filters, and generations that are merged."""

import pytest
from pyspark.sql import functions as F

from silverthread.sinks.generations import Generation, Manifests, exists, to_merge
from silverthread.streaming.ids import IdIndex


def ids_of(spark, numbers):
    return spark.createDataFrame([(f"E{n}",) for n in numbers], "id string")


def found(index, ids, batch, tmp_path):
    return sorted(int(r.id[1:]) for r in index.seen(ids, batch, f"{tmp_path}/scratch{batch}").collect())


def test_every_stored_id_is_found_and_no_other(spark, tmp_path):
    index = IdIndex(spark, f"{tmp_path}/ids", ids_per_bucket=50, fan=3)
    stored = set()
    for batch in range(5):
        new = set(range(batch * 200, batch * 200 + 150))
        probe = ids_of(spark, sorted(new | {n for n in stored if n % 7 == batch}))
        assert found(index, probe, batch, tmp_path) == sorted(n for n in stored if n % 7 == batch)
        index.add(ids_of(spark, sorted(new)), batch)
        stored |= new
    assert sum(g.rows for g in index.manifests.newest()) == len(stored)
    assert len(index.manifests.newest()) <= 4  # merged by three


def test_a_batch_that_runs_again_replaces_its_own(spark, tmp_path):
    index = IdIndex(spark, f"{tmp_path}/ids", ids_per_bucket=50, fan=2)
    index.add(ids_of(spark, range(100)), 0)
    for _ in range(2):  # the second time, its own ids must not count as seen
        assert found(index, ids_of(spark, range(90, 200)), 1, tmp_path) == list(range(90, 100))
        index.add(ids_of(spark, range(100, 200)), 1)
    assert sum(g.rows for g in index.manifests.newest()) == 200
    index.add(ids_of(spark, []), 2)
    assert found(index, ids_of(spark, [5, 150, 999]), 3, tmp_path) == [5, 150]


def test_a_late_batch_reads_a_small_share_of_the_ids(spark, tmp_path, conf):
    conf("spark.sql.shuffle.partitions", "2")
    index = IdIndex(spark, f"{tmp_path}/ids", ids_per_bucket=64)
    everything = spark.range(100_000).select(F.concat(F.lit("E"), F.col("id")).alias("id"))
    index.add(everything, 0)
    for batch in range(1, 100):  # as if 99 batches had been committed
        index.manifests.commit(batch, index.manifests.newest())
    fresh = spark.range(100_000, 100_500).select(F.concat(F.lit("E"), F.col("id")).alias("id"))
    assert index.seen(fresh, 100, f"{tmp_path}/a").count() == 0
    assert index.ids_stored == 100_000 and index.ids_read <= 0.02 * index.ids_stored
    again = fresh.unionAll(ids_of(spark, [7, 99_999]))
    assert index.seen(again, 100, f"{tmp_path}/b").count() == 2
    assert index.buckets_read >= 1 and index.ids_read <= 0.02 * index.ids_stored


def test_manifests_keep_what_a_repeated_batch_needs(spark, tmp_path):
    log = Manifests(spark, f"{tmp_path}/log")
    assert log.newest() is None and log.before(5) is None
    a, b, c = (Generation(name, 10) for name in "abc")
    log.commit(0, [a])
    log.commit(1, [a, b])
    log.commit(2, [c])
    removed = []
    log.forget(2, removed.append)  # batch 2 runs again: it starts from a and b
    assert removed == [] and log.before(2) == [a, b] and log.batches() == [1, 2]
    log.forget(3, removed.append)
    assert removed == ["a", "b"] and log.newest() == [c] and log.batches() == [2]
    log.commit(3, [])
    assert log.newest() == []


@pytest.mark.parametrize("sizes, merged", [([1, 1], []), ([1, 1, 1], [1, 1, 1]), ([9, 9, 1, 1], []), ([81, 81, 81, 9, 9, 9], [9, 9, 9])])
def test_generations_of_one_order_of_size_are_merged(sizes, merged):
    live = [Generation(f"g{k}", n) for k, n in enumerate(sizes)]
    assert [g.rows for g in to_merge(live, 3)] == merged


def test_removed_generations_leave_no_files(spark, tmp_path):
    index = IdIndex(spark, f"{tmp_path}/ids", fan=2)
    for batch in range(4):
        index.add(ids_of(spark, range(batch * 10, batch * 10 + 10)), batch)
    live = {g.name for g in index.manifests.newest()} | {g.name for g in index.manifests.before(3)}
    kept = [name for name in ("0", "1", "1-0", "2", "3", "3-0", "3-1") if exists(spark, f"{tmp_path}/ids/ids/generation={name}")]
    assert set(kept) >= live and "0" not in kept
