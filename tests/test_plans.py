"""The plans, not the rows: pruning, pushdown, shuffles, and hot keys."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from silverthread import schemas, sources
from silverthread.operators import aggregates as A, events as E, joins, latest, quality
from silverthread.plans import claims as C, gold as G, members as M

NOW = dt.datetime(2025, 1, 1)


def plan(df, final=False):
    execution = df._jdf.queryExecution()
    if final:
        df.collect()
    text = execution.executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def shuffles(df):
    text = plan(df)
    return text.count("Exchange hashpartitioning") + text.count("Exchange SinglePartition")


@pytest.fixture
def big(conf):
    """No side is small enough to broadcast."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")


@pytest.fixture
def skewable(conf, big):
    """Sizes at which a test's hot key counts as skewed."""
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "50k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "50k")


def hot(spark, n=300000):
    """A third of the rows share one key."""
    return spark.range(0, n, 1, 16).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 5000))
        .alias("member_id"),
        F.col("id").alias("n"),
    )


def claims_of_hot(spark):
    return hot(spark).select(
        F.concat(F.lit("C"), "n").alias("claim_id"),
        "member_id",
        F.lit(dt.date(2024, 1, 1)).alias("claim_date"),
        F.col("n").cast("double").alias("claim_amount"),
    )


def keys(spark):
    return spark.range(0, 5000, 1, 4).select(
        F.concat(F.lit("k"), "id").alias("member_id"), (F.col("id") * 2).alias("v")
    ).unionAll(spark.sql("SELECT 'hot' AS member_id, 1L AS v"))


def touched(df):
    """Every column is needed, so that no join is optimized away."""
    return df.agg(*[F.max(name) for name in df.columns], F.count(F.lit(1)))


def test_hot_key_is_split_against_an_aggregate(spark, skewable):
    per_key = keys(spark).groupBy("member_id").agg(F.sum("v").alias("v"))
    joined = joins.hot_key_join(hot(spark), per_key, "member_id", "left")
    assert "SortMergeJoin(skew=true)" in plan(touched(joined), final=True)
    assert joined.count() == 300000


def test_hot_key_is_split_against_a_window(spark, skewable):
    one = latest.latest_per_key(keys(spark), ["member_id"], ["v"])
    joined = joins.hot_key_join(one, hot(spark), "member_id", "inner")
    text = plan(touched(joined), final=True)
    assert "SortMergeJoin(skew=true)" in text and "WindowGroupLimit" in text


@pytest.mark.parametrize("join", [joins.require_parent, joins.without_match])
def test_hot_key_is_split_in_existence_joins(spark, skewable, join):
    parent = hot(spark, 60000).select("member_id")
    assert "SortMergeJoin(skew=true)" in plan(touched(join(hot(spark), parent, "member_id")), final=True)


def test_hot_member_is_split_when_claims_are_checked(spark, skewable):
    checked = C.check_claims(claims_of_hot(spark), keys(spark).select("member_id"))
    assert "SortMergeJoin(skew=true)" in plan(touched(checked), final=True)
    assert checked.count() == 300000


def test_no_join_asks_for_a_broadcast(spark, big):
    joined = joins.require_parent(hot(spark), keys(spark), "member_id")
    assert "BroadcastHashJoin" not in plan(joined)


def test_claims_are_shuffled_once_for_join_and_dedup(spark, big):
    text = plan(C.check_claims(claims_of_hot(spark), keys(spark).select("member_id")))
    assert text.count("Exchange hashpartitioning") == 3  # claims once, parent keys twice
    assert "LeftAnti" not in text


def test_all_facts_take_one_shuffle(spark):
    facts = [
        (hot(spark), [A.Measure("a", "n", "money")]),
        (keys(spark), [A.Measure("b", "v", "count")]),
    ]
    assert shuffles(A.aggregate_facts(facts, "member_id")) == 1


def test_events_take_no_shuffle_and_one_parse(spark):
    documents = spark.range(10).select(F.to_json(F.struct("id")).alias("doc"))
    wide = E.normalize_all(sources.parse_events(documents, "doc"))
    text = plan(wide)
    # One call takes arrays of events apart, the other parses each event.
    assert "Exchange" not in text and text.count("from_json") == 2
    assert plan(E.bad_rows(wide, E.CLAIMS, distinct=False)).count("from_json") == 2


def test_split_needs_no_anti_join(spark):
    df = keys(spark)
    split = quality.split_by_rules(df, [quality.in_range("v", 10, 20)])
    assert "Join" not in plan(split.rejected) and shuffles(split.rejected) == 1
    assert shuffles(split.valid) == 0


def test_except_takes_one_shuffle_of_reduced_rows(spark):
    df = hot(spark)
    text = plan(quality.except_distinct(df, df.filter("n > 10")))
    assert text.count("Exchange") == 1 and "Join" not in text
    assert text.count("partial_max") == 1


def test_latest_keeps_one_row_per_task_before_the_shuffle(spark):
    text = plan(latest.latest_per_key(hot(spark), ["member_id"], ["n"]))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_history_is_not_shuffled_whole(spark, big):
    """The dimension shuffles one record per member and task, nothing before."""
    df = spark.createDataFrame([], schemas.HISTORICAL_MEMBER_POLICY)
    other = spark.createDataFrame([], schemas.MIGRATED_MEMBERS)
    checked = M.check_history(df)
    assert shuffles(checked) == 0
    dimension = M.dimension_from_valid(
        checked.filter("is_valid").drop("is_valid"), other, dt.date(2025, 1, 1), NOW
    )
    assert dimension.columns


def test_active_members_prune_files(spark, tmp_path):
    path = str(tmp_path / "dimension")
    df = spark.createDataFrame(
        [("M1", "Active"), ("M2", "Terminated")], "member_id string, active_flag string"
    )
    df.write.partitionBy("active_flag").parquet(path)
    scan = plan(sources.active_members(sources.read_table(spark, path)))
    assert "PartitionFilters: [isnotnull(active_flag" in scan


def test_gold_reads_the_needed_event_columns_only(spark, tmp_path):
    path = str(tmp_path / "events")
    documents = spark.range(10).select(F.lit("{}").alias("doc"))
    E.normalize_all(sources.parse_events(documents, "doc")).write.partitionBy(
        "outcome", "domain"
    ).parquet(path)
    stored = spark.read.schema(
        E.normalize_all(sources.parse_events(documents, "doc")).schema
    ).parquet(path)
    empty = spark.createDataFrame([], "member_id string, claim_id string, final_claim_amount double")
    facts = G.Facts(
        empty,
        spark.createDataFrame([], schemas.REVENUE),
        spark.createDataFrame([], schemas.VIOLATIONS),
        stored,
    )
    text = plan(G.member_activity(facts))
    assert "ReadSchema: struct<event_id:string,member_id:string>" in text
    assert "PartitionFilters: [isnotnull(outcome" in text


def test_hot_adjustments_are_split_when_claims_are_adjusted(spark, skewable):
    adjustments = hot(spark).select(
        F.col("member_id").alias("claim_id"), "member_id", F.col("n").alias("amount")
    )
    claims = adjustments.select("claim_id", "member_id").distinct().withColumn("x", F.rand(1))
    joined = joins.claims_with_adjustments(claims, adjustments)
    assert "SortMergeJoin(skew=true)" in plan(touched(joined), final=True)


def test_keys_of_different_types_match(spark):
    wide = spark.range(1000).withColumnRenamed("id", "k")
    narrow = wide.select(F.col("k").cast("int"))
    assert joins.hot_key_join(wide, narrow, "k", "inner").count() == 1000


def test_claims_keep_their_adjustments_and_the_others_stay(spark, rows):
    claims = spark.createDataFrame(
        [("c1", "m1", 5.0), ("c2", "m1", 6.0), (None, "m2", 7.0)], "claim_id string, member_id string, a double"
    )
    adjustments = spark.createDataFrame(
        [("c1", "m1", 1.0), ("c1", "m1", 2.0), ("c2", "m9", 3.0)], "claim_id string, member_id string, b double"
    )
    found = joins.claims_with_adjustments(claims, adjustments)
    expected = claims.join(adjustments, ["claim_id", "member_id"], "left")
    assert rows(found, *expected.columns) == rows(expected)
