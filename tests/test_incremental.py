"""Tables that follow new days, and checks of runs, against computing all anew."""

import datetime as dt
import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from catalog import queries as Q
from silverthread import constants as K, schemas, sinks, sources
from silverthread.operators import aggregates as A, drift
from silverthread.operators.latest import latest_per_key
from silverthread.plans import balance, gold as G, incremental, jobs

SCHEMA = "k string, day date, at int, note string, extra double"


def random_rows(n, seed):
    r = random.Random(seed)
    days = [dt.date(2024, 1, d) for d in range(1, 6)] + [None]
    return [(r.choice(["a", "b", "c", "d", None]), r.choice(days), r.choice([1, 2, None]), r.choice("xyz"), r.random()) for _ in range(n)]


def test_newest_rows_equal_the_full_run_after_every_day(spark, tmp_path, rows):
    kept = incremental.NewestRows(
        spark, str(tmp_path / "t"), spark.createDataFrame([], SCHEMA).schema, ["k"], ["day", "at"], buckets=4
    )
    assert kept.read().count() == 0
    every = None
    for day in range(3):
        new = spark.createDataFrame(random_rows(12, day), SCHEMA)
        every = new if every is None else every.unionAll(new)
        for _ in range(2 if day == 1 else 1):  # a merge that runs again changes nothing
            kept.merge(new, day)
        assert rows(kept.read()) == rows(latest_per_key(every, ["k"], ["day", "at"]))
    kept.merge(spark.createDataFrame([], SCHEMA), 3)
    assert rows(kept.read()) == rows(latest_per_key(every, ["k"], ["day", "at"]))


def test_the_stored_side_of_a_merge_is_not_shuffled(spark, tmp_path, conf):
    conf("spark.sql.shuffle.partitions", "4")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    schema = spark.createDataFrame([], SCHEMA).schema
    kept = incremental.NewestRows(spark, str(tmp_path / "t"), schema, ["k"], ["day", "at"], buckets=8)
    kept.merge(spark.createDataFrame(random_rows(50, 1), SCHEMA).where("k IS NOT NULL"), 0)
    plan = kept.merged(kept.read(), spark.createDataFrame(random_rows(9, 2), SCHEMA))._jdf.queryExecution().executedPlan().toString()
    join = plan[plan.index("SortMergeJoin") :]
    stored = join[: join.index("FileScan parquet")]
    assert "Bucketed: true" in join and "Exchange" not in stored


MEASURES = [A.Measure("money", "amount", "money"), A.Measure("n", "id", "count"), A.Measure("last", "id", "max")]
FACT = "m string, id string, amount double"


def test_partial_sums_follow_replaced_days(spark, tmp_path, rows):
    r = random.Random(2)
    day = lambda n, size: spark.createDataFrame(
        [(r.choice(["A", "B", None]), r.choice([f"E{n}{k}", None]), round(r.random(), 2)) for k in range(size)], FACT
    )
    sums = incremental.PartialSums(spark, str(tmp_path / "p"), "m", "string", MEASURES)
    first, wrong, second, third = day(1, 9), day(9, 30), day(2, 9), day(3, 1)
    for df, name in ((first, "2024-01-01"), (wrong, "2024-01-02"), (third, "2024-01-03"), (second, "2024-01-02")):
        sums.load([(df, MEASURES)], name)
    full = A.aggregate_fact(first.unionAll(second).unionAll(third), "m", MEASURES)
    assert rows(sums.read(), *full.columns) == rows(full)
    sums.load([(first.limit(0), MEASURES)], "2024-01-01")
    full = A.aggregate_fact(second.unionAll(third), "m", MEASURES)
    assert rows(sums.read(), *full.columns) == rows(full)


def test_a_planted_loss_is_found_and_a_doubled_count_is_not():
    equations = [("all", ["read"], ["good", "bad"])]
    assert balance.check_balance({"read": 5, "good": 3, "bad": 2}, equations) == {"all": (5, 5)}
    with pytest.raises(balance.Unbalanced, match="all: 5 and 4"):
        balance.check_balance({"read": 5, "good": 2, "bad": 2}, equations, {"read": lambda: 5})
    # A task that ran twice was counted twice; counting again settles it.
    assert balance.check_balance({"read": 9, "good": 3, "bad": 2}, equations, {"read": lambda: 5}) == {"all": (5, 5)}


def test_a_run_that_loses_rows_fails(spark, tmp_path, monkeypatch):
    layout = jobs.Layout(str(tmp_path / "lake"))
    history = spark.createDataFrame(
        [("L1", dt.date(2024, 1, 1), None, 1980, "M", None, None, "P1", "t", "S", None, "seg"),
         ("L2", dt.date(2024, 1, 1), None, 1980, "F", None, None, "P2", "t", "S", None, "seg")],
        schemas.HISTORICAL_MEMBER_POLICY,
    )
    history.write.option("header", True).csv(layout.raw("historical_member_policy"))
    spark.createDataFrame([], schemas.MIGRATED_MEMBERS).write.option("header", True).csv(layout.raw("migrated_members"))
    run = jobs.run_members(spark, layout, dt.date(2025, 1, 1))
    assert run.points["read"] == 2
    check = jobs.M.check_history
    monkeypatch.setattr(jobs.M, "check_history", lambda df: check(df).where("policy_id <> 'P2'"))
    with pytest.raises(balance.Unbalanced, match="history read: 2 and 1"):
        jobs.run_members(spark, layout, dt.date(2025, 1, 1))
    states = [r.status for r in sources.read_table(spark, layout.run_log).orderBy("start_time").collect()]
    assert states == ["SUCCESS", "FAILED"]


def test_files_of_several_headers_in_one_folder(spark, tmp_path, rows):
    folder = tmp_path / "csv"
    folder.mkdir()
    for name, text in {
        "1.csv": "id,name\n1,a\n", "2.csv": "NAME,id,more\nb,2,m\n", "3.csv": "id,name\n3,c\n",
        "4.csv": "", "5.csv": "id\n5\n", "6.csv": "﻿id,name\n6,f\n", "_hidden.csv": "x\n1\n",
    }.items():
        (folder / name).write_text(text, encoding="utf-8")
    schema = schemas.struct(id="bigint", name="string")
    df = sources.read_csv(spark, str(folder), schema, optional=["name"], mixed_headers=True)
    assert df.columns == ["id", "name", "more"]
    assert rows(df) == [(1, "a", None), (2, "b", "m"), (3, "c", None), (5, None, None), (6, "f", None)]
    with pytest.raises(ValueError, match="name"):
        sources.read_csv(spark, str(folder), schema, mixed_headers=True).count()
    empty = tmp_path / "none"
    empty.mkdir()
    assert sources.read_csv(spark, str(empty), schema, mixed_headers=True).count() == 0


def test_paths_of_payloads(spark, tmp_path):
    docs = [
        '{"event_category":"CLAIMS","schema_version":"v1","payload":{"claim_id":"C","new":[{"a":1},{"a":"x"},[]]}}',
        '{"event_category":"CLAIMS","schema_version":"v1","payload":{"claim_id":null}}',
        '{"event_category":"CLAIMS","schema_version":"v2","payload":{"claim":{"id":"C","diagnosis_codes":["D"]}}}',
        '{"event_category":"CLAIMS","schema_version":"v1"}', "not json", None,
    ]
    found = drift.unknown_paths(spark.createDataFrame([(d,) for d in docs], "doc string"), str(tmp_path / "a"))
    got = {(r.schema_version, r.path, r.kind): r.occurrences for r in found.collect()}
    assert got == {
        ("v1", "new", "array"): 1, ("v1", "new[]", "object"): 2, ("v1", "new[]", "array"): 1,
        ("v1", "new[].a", "bigint"): 1, ("v1", "new[].a", "string"): 1,
    }


def test_paths_of_no_payloads(spark, tmp_path):
    docs = spark.createDataFrame([("{}",), (None,)], "doc string")
    assert drift.unknown_paths(docs, str(tmp_path / "a")).count() == 0
    assert drift.unknown_paths(docs.limit(0), str(tmp_path / "b")).count() == 0


def test_the_version_of_a_date_is_the_newest_before_it():
    day = lambda n: dt.date(2024, 1, n)
    versions = [day(10), day(5), day(20)]
    assert G.versions_as_of(versions, [day(4), day(5), day(9), day(10), day(31), day(31)]) == [
        (day(5), day(5)), (day(9), day(5)), (day(10), day(10)), (day(31), day(20))
    ]


def test_a_look_up_opens_few_files(spark, tmp_path):
    people = spark.range(20_000).select(
        F.concat(F.lit("M"), F.lpad(F.xxhash64("id").cast("string"), 20, "0")).alias("member_id"),
        F.when(F.col("id") % 3 == 0, F.lit("S0")).otherwise(F.concat(F.lit("S"), F.col("id") % 20)).alias("state"),
    )
    path = str(tmp_path / "gold")
    sinks.write_snapshot(sinks.cluster_for_write(people, "member_id", ["state"], 60), path, dt.date(2024, 1, 1), ["state"])
    one = people.first().member_id
    files = glob.glob(f"{path}/**/*.parquet", recursive=True)
    held = 0
    for name in files:
        stats = pq.ParquetFile(name).metadata.row_group(0).column(0).statistics
        held += stats.min <= one <= stats.max
    assert len(files) >= 60 and held <= len(files) / 2
    in_state = glob.glob(f"{path}/run_date=2024-01-01/state=S0/*.parquet")
    near = sum(
        (s := pq.ParquetFile(n).metadata.row_group(0).column(0).statistics).min <= one <= s.max for n in in_state
    )
    assert len(in_state) >= 10 and near <= 2


def test_facts_of_several_loads_are_computed_once(spark, monkeypatch, rows):
    read = spark.sparkContext.accumulator(0)

    def counted(parts):
        for part in parts:
            read.add(len(part))
            yield part

    def fact(found, schema):
        given = spark.createDataFrame(found, schema)
        return given.mapInPandas(counted, given.schema)

    members = [None, *(f"M{n}" for n in range(9)), "M1"]
    facts = G.Facts(
        fact([(m, "C1", 0.1 * n) for n, m in enumerate(members)], "member_id string, claim_id string, final_claim_amount double"),
        fact([(m, 2.5) for m in members[3:]], "member_id string, premium_collected double"),
        fact([("M1", "V1"), ("M1", None), (None, "V1")], "member_id string, violation_id string"),
        fact(
            [(m, "E1", d, o) for m in members[:5] for d in G.EVENT_COUNTS for o in ("valid", "valid", "bad")],
            "member_id string, event_id string, domain string, outcome string",
        ),
    )
    expected = rows(A.fill_zero(G.member_activity(facts), K.ZERO_FILLED))
    before, given = read.value, sum(len(f.collect()) for f in facts)
    monkeypatch.setattr(Q, "_facts", lambda spark, sf_dir: facts)
    read_here = read.value
    assert rows(Q.QUERIES["agg_incremental"](spark, "")) == expected
    assert before == given and read.value - read_here == given
