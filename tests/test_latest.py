from hypothesis import HealthCheck, given, settings, strategies as st

from silverthread.operators.latest import latest_per_key

_small = st.one_of(st.none(), st.integers(0, 2))


def newest(rows):
    """Brute force: the largest row per key, nulls below everything."""
    rank = lambda row: [(v is not None, v or 0) for v in row[1:]]
    best = {}
    for row in rows:
        if row[0] not in best or rank(row) > rank(best[row[0]]):
            best[row[0]] = row
    return set(best.values())


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), _small, _small, _small), min_size=1, max_size=30))
def test_latest_is_the_largest_row(spark, data):
    df = spark.createDataFrame(data, "k int, a int, b int, c int").repartition(4)
    found = [tuple(r) for r in latest_per_key(df, ["k"], ["a", "b"]).collect()]
    assert len(found) == len(set(found)) and set(found) == newest(data)


def test_given_tie_break_decides(spark):
    df = spark.createDataFrame([(1, 5, "x"), (1, 5, "y")], "k int, a int, t string")
    assert latest_per_key(df, ["k"], ["a"], ["t"]).first()["t"] == "y"


def test_columns_without_an_order_are_carried(spark):
    df = spark.sql("SELECT 1 AS k, id AS a, map('n', id) AS m FROM range(3)")
    assert latest_per_key(df, ["k"], ["a"]).first()["m"] == {"n": 2}
