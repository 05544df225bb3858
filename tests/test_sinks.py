import datetime as dt
import glob
import os
from functools import partial

import pytest
from pyspark.sql import functions as F

from silverthread import schemas, session, sinks, sources
from silverthread.plans import runlog

ONE, TWO = dt.date(2025, 1, 1), dt.date(2025, 1, 2)


def test_touched_partitions_only_are_replaced(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    for day, n in ((ONE, 1), (TWO, 2), (TWO, 3)):
        df = spark.createDataFrame([(n, day)], "n int, day date")
        sinks.write_partitioned(df, path, ["day"])
    assert rows(sources.read_table(spark, path), "n") == [(1,), (3,)]
    assert rows(sources.latest_partition(sources.read_table(spark, path), "day"), "n") == [(3,)]
    sinks.write_partitioned(df, path, ["day"], replace="all")
    assert rows(sources.read_table(spark, path), "n") == [(3,)]


def test_snapshot_replaces_its_whole_date(spark, tmp_path, rows):
    path = str(tmp_path / "s")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, state string")
    sinks.write_snapshot(df, path, ONE, ["state"])
    sinks.write_snapshot(df, path, TWO, ["state"])
    sinks.write_snapshot(df.filter("state = 'a'"), path, TWO, ["state"])
    stored = sources.read_table(spark, path)
    assert rows(stored, "n", "run_date") == [(1, ONE), (1, TWO), (2, ONE)]
    sinks.write_snapshot(df, path, TWO, ["state"], idempotent=False)
    assert sources.read_table(spark, path).count() == 5


def test_partition_text_is_kept_with_a_schema(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([(1, "01")], "n int, state string")
    sinks.write_partitioned(df, path, ["state"])
    assert sources.read_table(spark, path).first()["state"] == 1
    assert sources.read_table(spark, path, df.schema).first()["state"] == "01"


def test_counts_come_with_the_write(spark, tmp_path):
    df = spark.range(100).withColumn("even", F.col("id") % 2 == 0)
    found = sinks.write_counted(
        df.filter("id < 51"),
        lambda out: sinks.write_table(out, str(tmp_path / "c")),
        rows=F.count(F.lit(1)),
        even=F.count_if("even"),
    )
    assert found == {"rows": 51, "even": 26}
    empty = sinks.write_counted(
        df.filter("id < 0"),
        lambda out: sinks.write_table(out, str(tmp_path / "e")),
        rows=F.count(F.lit(1)),
    )
    assert empty == {"rows": 0}


def test_stage_lives_in_the_checkpoint_folder(spark):
    df = spark.range(10).withColumn("odd", F.col("id") % 2 == 1)
    path = session.scratch_path(spark, "numbers")
    staged, counts = sinks.stage(df, path, ["odd"], odd=F.count_if("odd"))
    assert counts == {"odd": 5} and staged.filter("odd").count() == 5
    folder = spark.conf.get("spark.checkpoint.dir")
    assert all(folder in name for name in staged.inputFiles())
    assert staged.schema["odd"].dataType == df.schema["odd"].dataType


def test_scratch_folder_is_removed(spark):
    with pytest.raises(RuntimeError):
        with session.scratch_folder(spark) as folder:
            assert sinks.stage(spark.range(3), f"{folder}/t")[0].count() == 3
            assert os.path.isdir(folder)
            raise RuntimeError
    assert not os.path.exists(os.path.dirname(folder))
    assert os.path.isdir(spark.conf.get("spark.checkpoint.dir"))


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_scratch(Session())


def test_shuffles_start_from_enough_partitions(spark, conf):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    conf(key, "8")
    session.tune(spark, shuffle_bytes=10 << 40)
    assert spark.conf.get(key) == str(10 * (1 << 40) // (128 << 20))
    session.tune(spark, shuffle_bytes=1)
    assert spark.conf.get(key) == spark.conf.get("spark.sql.shuffle.partitions")


def test_hot_partition_is_written_by_many_tasks(spark, tmp_path, conf):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    df = spark.range(0, 200000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .otherwise(F.concat(F.lit("s"), (F.col("id") % 5)))
        .alias("state"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    path = str(tmp_path / "w")
    found = sinks.write_counted(
        sinks.rebalance_for_write(df, "state"),
        lambda out: sinks.write_partitioned(out, path, ["state"]),
        rows=F.count(F.lit(1)),
    )
    files = {
        name: len([f for f in os.listdir(f"{path}/{name}") if f.endswith(".parquet")])
        for name in os.listdir(path)
        if name.startswith("state=")
    }
    assert found == {"rows": 200000}
    assert files["state=hot"] > 4 and sources.read_table(spark, path).count() == 200000


def test_csv_flags_unreadable_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text("claim_id,amount\n007,1.5\nC2,x\nC3,\n")
    schema = schemas.struct(claim_id="string", amount="double")
    found = {
        r["claim_id"]: (r["amount"], r[schemas.MALFORMED])
        for r in sources.read_csv(spark, str(tmp_path), schema, keep_malformed=True).collect()
    }
    assert found == {"007": (1.5, None), "C2": (None, "C2,x"), "C3": (None, None)}
    inferred = sources.read_csv(spark, str(tmp_path))
    assert dict(inferred.dtypes) == {"claim_id": "string", "amount": "string"}


def test_csv_columns_are_found_by_name(spark, tmp_path):
    schema = schemas.struct(claim_id="string", amount="double", note="string")
    texts = {
        "a": "note,claim_id,amount\nfirst,C1,1.5\n",
        "b": "AMOUNT,claim_id,region\n2.5,C2,north\nx,C3,south\n",
    }
    for name, text in texts.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "part.csv").write_text(text)
    both = [str(tmp_path / name) for name in texts]
    df = sources.read_csv(spark, both, schema, keep_malformed=True, optional=["note"])
    assert df.columns == ["claim_id", "amount", "note", "region", schemas.MALFORMED]
    assert sorted(map(tuple, df.collect())) == [
        ("C1", 1.5, "first", None, None),
        ("C2", 2.5, None, "north", None),
        ("C3", None, None, "south", "x,C3,south"),
    ]
    assert [r["amount"] for r in sources.read_csv(spark, both[0], schema).select("amount").collect()] == [1.5]
    with pytest.raises(ValueError, match="note"):
        sources.read_csv(spark, both, schema)


def test_csv_files_of_one_folder_have_one_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("member_id,violation_id\nM1,V1\n")
    (tmp_path / "b.csv").write_text("violation_id,member_id\nV2,M2\n")
    df = sources.read_csv(spark, str(tmp_path), schemas.VIOLATIONS)
    for read in (df, df.select("member_id")):
        with pytest.raises(Exception, match="header"):
            read.collect()


def test_csv_without_lines(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "empty.csv").write_text("")
    (tmp_path / "b").mkdir()
    for name in ("a", "b"):
        df = sources.read_csv(spark, str(tmp_path / name), schemas.VIOLATIONS)
        assert df.collect() == [] and df.columns == ["violation_id", "member_id"]


def test_run_log_tells_success_and_failure(spark, tmp_path):
    path = str(tmp_path / "log")
    with runlog.logged_run(spark, "good", path) as run:
        run.processed, run.failed = 5, 1
    with pytest.raises(RuntimeError):
        with runlog.logged_run(spark, "bad", path):
            raise RuntimeError("boom")
    log = sources.read_table(spark, path)
    assert log.schema.names == schemas.RUN_LOG.names
    found = {r["job_name"]: r for r in log.collect()}
    assert found["good"]["status"] == "SUCCESS" and found["bad"]["status"] == "FAILED"
    assert (found["good"]["records_processed"], found["good"]["records_failed"]) == (5, 1)
    assert found["good"]["start_time"] <= found["good"]["end_time"]
    assert found["good"]["run_id"] != found["bad"]["run_id"]
    assert found["good"]["run_id"].startswith("run_2")


def test_lakes_are_written_by_zstd(spark, conf, tmp_path):
    conf("spark.sql.parquet.compression.codec", "snappy")
    sinks.write_table(session.tune_lake(spark).range(9), str(tmp_path / "t"))
    assert glob.glob(str(tmp_path / "t" / "*.zstd.parquet"))


def test_threads_append_to_one_table(spark, tmp_path, rows):
    path = str(tmp_path / "t")

    def append(n):
        sinks.append_rows(spark.range(n, n + 1), path)
        return n

    assert sinks.write_together(*[partial(append, n) for n in range(12)]) == list(range(12))
    assert sorted(rows(sources.read_table(spark, path))) == [(n,) for n in range(12)]
