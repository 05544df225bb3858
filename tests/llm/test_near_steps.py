"""How often near-duplicate detection writes and shuffles small tables, and what it links."""

import random

import numpy as np
import pytest

from silverthread.llm import near


@pytest.fixture
def staged(monkeypatch):
    """Names of the staged tables, and the tables."""
    seen, whole = [], near.stage
    monkeypatch.setattr(near, "stage", lambda df, name: seen.append((name, whole(df, name))) or seen[-1][1])
    return seen


def _edges(spark, pairs):
    rows = [(bytes([a // 256, a % 256]), bytes([b // 256, b % 256])) for a, b in pairs]
    return near.stage(spark.createDataFrame(rows, "a binary, b binary"), "edges")


def _roots(labels):
    return {int.from_bytes(r.node, "big"): int.from_bytes(r.root, "big") for r in labels.collect()}


def _brute(pairs):
    root = {n: n for pair in pairs for n in pair}
    while True:
        before = dict(root)
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
        if root == before:
            return root


def test_a_step_of_components_writes_one_table(spark, staged):
    """A star takes the first labels, one step, and one that changes nothing."""
    edges = _edges(spark, [(7, n) for n in range(1, 20) if n != 7])
    staged.clear()
    assert _roots(near.components(edges)) == {n: 1 for n in range(1, 20)}
    assert [name for name, _ in staged] == ["near_labels"] * 3


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    """Chains, trees, repeated and turned links, loops."""
    r = random.Random(seed)
    names = r.sample(range(600), 120)
    pairs = [(names[i], names[i + 1]) for i in range(11)]
    pairs += [(names[i], names[r.randrange(20, i)]) for i in range(21, 60)]
    pairs += [(r.choice(names[60:]), r.choice(names[60:])) for _ in range(45)]
    pairs += [(b, a) for a, b in pairs[::5]] + pairs[::7] + [(names[3], names[3])]
    assert _roots(near.components(_edges(spark, pairs))) == _brute(pairs)


def test_later_links_join_roots_only(spark, staged, monkeypatch):
    """Links that are found within bands come as roots, and their components are of these
    roots alone: the nodes of the first components are not gone through again."""
    monkeypatch.setattr(near, "_verified", lambda pairs, texts, least, whole=near._verified: whole(pairs, texts, least).where("hex(a) < 'C'"))
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    docs = []
    for _ in range(6):
        text = [word() for _ in range(200)]
        for _ in range(12):
            text = list(text)
            text[r.randrange(200)] = word()
            docs.append(" ".join(text))
    made = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    assert {r.doc_id: r.class_id for r in near.classes(made).collect()} == {i: i - i % 12 for i in range(72)}
    first, later = [t for name, t in staged if name == "near_edges"]
    roots = {r.root for r in [t for name, t in staged if name == "near_mixed"][0].collect()}
    assert first.count() and later.count() and {e for r in later.collect() for e in (r.a, r.b)} <= roots
    last = [t for name, t in staged if name == "near_labels"][-1]
    assert {r.node for r in last.collect()} <= roots


@pytest.mark.parametrize("uneven", [False, True])
def test_many_similarities_at_once_equal_single_ones(uneven):
    r = np.random.default_rng(5)
    pool, rows, sets = np.unique(r.integers(1, 1 << 60, 80).astype(np.uint64)), [], []
    weights = r.integers(5, 40, len(pool)).astype(float)
    for k in range(30):
        own = np.sort(r.choice(len(pool), r.integers(1, 70), replace=False))
        h, w = pool[own], weights[own] * (1 + k % 3 if uneven else 1)
        sets.append((h, w))
        rows.append({"sh": h.tobytes() + w.tobytes(), "sig": [0] * near.REGISTERS, "bands": [0] * near.BANDS, "root": b"%d" % k})
    alike = near._Tile(rows, 0.8, 0)._likeness()
    for a in range(30):
        others = np.array([b for b in range(30) if b % 2 == a % 2])
        wanted = [near.probability_jaccard(*sets[a], *sets[b]) for b in others]
        assert alike(a, others) == pytest.approx(wanted, abs=1e-12)


def test_crowds_are_cut_into_parts_by_nodes(spark, monkeypatch):
    """Links across parts of a crowd that share half of their words."""
    monkeypatch.setattr(near, "TILE_NODES", 7)
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    same, docs = [word() for _ in range(114)], []
    for _ in range(8):
        text = same + [word() for _ in range(86)]
        for _ in range(4):
            text = list(text)
            text[114 + r.randrange(86)] = word()
            docs.append(" ".join(text))
    made = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    assert {r.doc_id: r.class_id for r in near.classes(made).collect()} == {i: i - i % 4 for i in range(32)}
