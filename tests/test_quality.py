from collections import Counter

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from silverthread.operators import quality as Q

SCHEMA = "id string, n int, a int, b int"


def test_null_never_holds(spark, rows):
    df = spark.createDataFrame(
        [("1", 1, 1, 2), (None, 1, 1, 2), ("3", None, 1, 2), ("4", 9, 1, 2)], SCHEMA
    )
    split = Q.split_by_rules(df, [*Q.not_null("id"), Q.in_range("n", 1, 5)])
    assert rows(split.valid, "id") == [("1",)]
    assert rows(split.rejected, "id", "n") == [("3", None), ("4", 9), (None, 1)]


def test_interval_rule(spark, rows):
    df = spark.createDataFrame(
        [("open", 0, 1, None), ("equal", 0, 2, 2), ("late", 0, 3, 2), ("no start", 0, None, 2),
         ("empty", 0, None, None)],
        SCHEMA,
    )
    split = Q.split_by_rules(df, [Q.interval_in_order("a", "b")])
    assert rows(split.valid, "id") == [("empty",), ("equal",), ("open",)]
    assert rows(split.rejected, "id") == [("late",), ("no start",)]


def test_rejects_come_once_valid_rows_as_often_as_given(spark, rows):
    df = spark.createDataFrame([("x", 9, 0, 0)] * 3 + [("y", 1, 0, 0)] * 2, SCHEMA)
    split = Q.split_by_rules(df, [Q.in_range("n", 1, 5)])
    assert split.valid.count() == 2 and split.rejected.count() == 1
    assert Q.split_by_rules(df, [Q.in_range("n", 1, 5)], False).rejected.count() == 3


def test_broken_rules_are_named(spark):
    df = spark.createDataFrame([(None, None, 1, 1), ("1", 2, 1, 1)], SCHEMA)
    rules = [*Q.not_null("id"), Q.in_range("n", 1, 5)]
    found = [r[0] for r in df.select(Q.broken_rules(rules)).collect()]
    assert found == [["id_missing", "n_out_of_range"], []]


def test_union_by_name_types_the_missing_column(spark):
    left = spark.createDataFrame([("1", 2)], "id string, n int")
    both = Q.union_by_name(left, left.select("id"))
    assert dict(both.dtypes) == {"id": "string", "n": "int"}
    assert Counter(r["n"] for r in both.collect()) == {2: 1, None: 1}


def test_except_is_distinct_and_null_safe(spark, rows):
    df = spark.createDataFrame([("1", None), ("1", None), ("2", 1), ("2", 1)], "id string, n int")
    assert rows(Q.except_distinct(df, df.filter("n = 1"))) == [("1", None)]
    assert rows(Q.except_distinct(df, df)) == []


def test_digest_tells_nulls_apart_by_place(spark):
    df = spark.createDataFrame([(1, None), (None, 1), (None, 1), (None, None)], "a int, b int")
    assert Q.distinct_row_count(df).first()[0] == 3


_cell = st.one_of(st.none(), st.integers(0, 3))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(_cell, _cell), min_size=1, max_size=20))
def test_split_is_the_except_of_the_valid_rows(spark, data):
    df = spark.createDataFrame(data, "a int, b int")
    rules = [*Q.not_null("a"), Q.interval_in_order("a", "b")]
    split = Q.split_by_rules(df, rules)
    valid = [tuple(r) for r in split.valid.collect()]
    bad = [tuple(r) for r in split.rejected.collect()]
    assert set(bad) == set(data) - set(valid) and len(bad) == len(set(bad))
    assert Counter(valid) == Counter(r for r in data if r in set(valid))
    expected = df.subtract(df.filter(Q.all_hold(rules)))
    assert sorted(bad, key=repr) == sorted((tuple(r) for r in expected.collect()), key=repr)


def test_positive_and_non_negative(spark, rows):
    df = spark.createDataFrame(
        [(-1.0,), (0.0,), (0.01,), (None,), (float("nan"),)], "v double"
    )
    kept = lambda rule: [r[0] for r in df.filter(Q.all_hold([rule])).collect()]
    assert kept(Q.non_negative_money("v")) == [0.0, 0.01]
    assert kept(Q.positive("v"))[0] == 0.01
    assert kept(Q.Rule("all", F.lit(None).cast("boolean"))) == []


def test_rows_that_differ_in_a_nested_null_are_counted_apart(spark):
    df = spark.sql(
        "SELECT named_struct('a', 1, 'b', cast(null AS int)) AS s"
        " UNION ALL SELECT named_struct('a', cast(null AS int), 'b', 1)"
    )
    assert Q.distinct_row_count(df.unionAll(df)).first()["records"] == 2
