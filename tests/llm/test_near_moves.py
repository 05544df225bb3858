"""What near-duplicate detection shuffles and stores: texts and shingles of few rows only."""

import random

import pytest
from pyspark.sql import functions as F

from silverthread.llm import common, near


def _word(r):
    return "".join(r.choice("abcdefgh") for _ in range(6))


@pytest.fixture
def staged(monkeypatch):
    """Tables by the name they are staged under."""
    seen, whole = {}, near.stage
    monkeypatch.setattr(near, "stage", lambda df, name: seen.setdefault(name, []).append(whole(df, name)) or seen[name][-1])
    return seen


def _classes(spark, docs):
    found = near.classes(spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string"))
    return {r.doc_id: r.class_id for r in found.collect()}


def test_shingles_move_only_of_nodes_that_are_to_be_compared(spark, staged):
    """Texts that are 0.4 alike share bands, but too few registers for a comparison."""
    r = random.Random(1)
    common_words = [_word(r) for _ in range(114)]
    docs = [" ".join(common_words + [_word(r) for _ in range(86)]) for _ in range(60)]
    assert _classes(spark, docs) == {i: i for i in range(60)}
    assert staged["near_mixed"][0].select("node").distinct().count() > 20
    assert sum(t.count() for t in staged.get("near_shingles", [])) == 0


def test_links_in_crowds_of_half_alike_texts_are_found(spark, staged, monkeypatch):
    """Chains within such a crowd: what is compared is found by registers, in parts."""
    monkeypatch.setattr(near, "TILE_SHINGLES", 2000)
    r = random.Random(2)
    common_words, docs = [_word(r) for _ in range(114)], []
    for _ in range(10):
        text = common_words + [_word(r) for _ in range(86)]
        for _ in range(5):
            text = list(text)
            text[114 + r.randrange(86)] = _word(r)
            text[114 + r.randrange(86)] = _word(r)
            docs.append(" ".join(text))
    assert _classes(spark, docs) == {i: i - i % 5 for i in range(50)}


def test_a_register_takes_one_byte(spark):
    made = near.sketch(spark.createDataFrame([(1, "one two three four five six")], "doc_id bigint, text string"))
    assert made.schema["sig"].dataType.simpleString() == "array<tinyint>"
    assert len(made.first().sig) == near.REGISTERS


@pytest.mark.parametrize("most", [1 << 26, 1 << 15])
def test_mostly_among_passes_all_wanted_rows_and_few_others(spark, monkeypatch, most):
    """A bitmap that is too small lets more rows pass and loses none."""
    monkeypatch.setattr(common, "MOST_BITS", most)
    rows = spark.range(0, 60_000).select("id", F.xxhash64("id").alias("key"), F.lit("b").alias("bitmap"))
    wanted = common.stage(rows.where("id % 6 = 0").select("key").unionAll(rows.where("id < 9").select("key")), "wanted")
    got = common.mostly_among(rows, "key", wanted)
    assert got.columns == rows.columns
    passed = [i for (i,) in got.select("id").collect()]
    assert len(passed) == len(set(passed)) and set(range(0, 60_000, 6)) <= set(passed) and set(range(9)) <= set(passed)
    if most > 1 << 15:
        assert len(passed) < 10_000 + 50_000 / 12
    nothing = common.stage(wanted.where("false"), "nothing")
    assert common.mostly_among(rows, "key", nothing).count() == 0
