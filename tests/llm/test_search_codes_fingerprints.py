"""Fingerprints, ranked search and vector codes against brute force, as registered
queries over small written tables and as operators on odd rows."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from silverthread.llm import search, simhash, vectors
from silverthread.llm.queries import QUERIES

#: Extra columns of names that the operators use inside or return.
DOCS = "doc_id bigint, text string, row string, bucket string, fingerprint string, score string, rank string, n_near int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "r", "b", "f", "s", "k", 7) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def texts():
    """Prose with copies, near copies, ties, odd texts and one long text."""
    r = random.Random(5)
    words = ["".join(r.choice("abcdefghijk") for _ in range(r.randint(1, 7))) for _ in range(300)]
    rows = []
    for i in range(260):
        if i % 5 == 4:
            copy = rows[-1][1].split(" ")
            if i % 10 == 4 and len(copy) > 1:
                copy[r.randrange(len(copy))] = "CHANGED"
            rows.append((i, " ".join(copy)))
        else:
            rows.append((i, " ".join(r.choice(words) for _ in range(r.randint(1, 120)))))
    rows += [(260, ""), (261, None), (262, "..."), (263, "é È a"), (264, "x " * 40_000), (265, "a\x00b\x7fc"), (266, "😀🎈 word")]
    return rows


@pytest.fixture(scope="module")
def odd(texts):
    """The same with null ids, repeated rows and ids with several texts."""
    return [*texts, (None, "no id here"), (None, None), (7, texts[7][1]), (7, texts[7][1]), (8, "another text of eight")]


def written(spark, path, **tables):
    for name, df in tables.items():
        df.write.parquet(f"{path}/{name}.parquet")
    return str(path)


# --- fingerprints ----------------------------------------------------------------


def test_fingerprints_of_texts_and_edits(spark, tmp_path, texts):
    sf_dir = written(spark, tmp_path, documents=docs_of(spark, texts).repartition(5))
    got = {r.doc_id: r for r in QUERIES["op11_fingerprints"](spark, sf_dir).collect()}
    assert len(got) == len(texts)
    order = sorted(texts, reverse=True)
    prints = {}
    for k, (doc, text) in enumerate(order):
        own, following = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(own) // 2
        changed = own[: len(own) - half] + following[:half]
        row = got[doc]
        assert row.n_chars == len(own)
        assert row.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        a, b, c = (plain_fingerprint(t) for t in (own, changed, following))
        assert (row.fingerprint, row.edited_fingerprint) == (f"{a:032x}", f"{b:032x}")
        near = lambda x: max(0.0, math.cos(math.pi * bin(a ^ x).count("1") / 128))
        assert row.near_edited == pytest.approx(near(b)) and row.near_next == pytest.approx(near(c))
        prints[doc] = a
    for doc, a in prints.items():
        close = sum(bin(a ^ b).count("1") <= simhash.RADIUS for other, b in prints.items() if other != doc)
        assert got[doc].n_near == close
    assert any(got[d].n_near for d in prints)


def plain_fingerprint(text):
    """Votes bit by bit."""
    found, weights = simhash.weighted_terms(text) if text else ([], [])
    with np.errstate(over="ignore"):
        hashes = [
            b"".join(int(simhash._mix(np.uint64(t) + np.uint64(h) * simhash._GOLDEN)).to_bytes(8, "little") for h in (1, 2))
            for t in found
        ]
    value = 0
    for bit in range(128):
        votes = sum(w if h[bit // 8] >> 7 - bit % 8 & 1 else -w for h, w in zip(hashes, weights))
        value = value << 1 | int(votes > 0)
    return value


def test_terms_are_words_and_pairs_with_damped_counts():
    found, weights = simhash.weighted_terms("A b a b a")
    assert sorted(weights) == sorted([math.floor(16 + 16 * math.log(n)) for n in (3, 2, 2, 2)])
    assert len(simhash.weighted_terms("")[0]) == 0 and len(simhash.weighted_terms("?!")[0]) == 1


def test_odd_documents_have_one_row_each(spark, odd):
    rows = simhash.with_near(simhash.fingerprint_edits(docs_of(spark, odd)), radius=3).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in odd)
    by_text = {}
    chars = Counter((i, len(t or "")) for i, t in odd)
    assert Counter((r.doc_id, r.n_chars) for r in rows) == chars
    for r in rows:
        by_text.setdefault((r.doc_id, r.n_chars), set()).add(r.fingerprint)
    assert all(len(f) == 1 for f in by_text.values())
    # The last document, without an id, is followed by the first.
    assert {r.near_next for r in rows if r.doc_id == 7} >= {1.0}  # its own copy follows
    nothing = simhash.fingerprint_edits(docs_of(spark, odd).limit(0))
    assert simhash.with_near(nothing).count() == 0
    one = simhash.fingerprint_edits(docs_of(spark, [(1, "ab cd")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"ab ab").hexdigest() and one.near_next == 1.0


@pytest.mark.parametrize("radius, agree", [(0, 1), (2, 2), (4, 1), (6, 2)])
def test_near_counts_equal_brute_force_in_hot_blocks(spark, monkeypatch, radius, agree):
    monkeypatch.setattr(simhash, "TILE", 32)  # so that hot blocks have many tiles
    r = random.Random(radius)
    centre = r.getrandbits(128)
    prints = {centre}
    while len(prints) < 300:  # most of them share most blocks
        x = centre
        for _ in range(r.randint(0, 5)):
            x ^= 1 << r.randrange(128)
        prints.add(x)
    prints = sorted(prints | {r.getrandbits(128) for _ in range(100)})
    docs = [r.randint(1, 4) for _ in prints]
    table = spark.createDataFrame([(bytearray(x.to_bytes(16, "big")), n) for x, n in zip(prints, docs)], "fp binary, docs bigint")
    got = {int.from_bytes(row.fp, "big"): row.near for row in simhash.near_counts(table, radius, agree).collect()}
    wanted = {
        x: n for x in prints
        if (n := sum(d for y, d in zip(prints, docs) if x != y and bin(x ^ y).count("1") <= radius))
    }
    assert got == wanted and (wanted or not radius)


# --- ranked search ---------------------------------------------------------------

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_search(docs, items, top=10):
    split = [(i, Counter(plain_terms(t))) for i, t in docs]
    split = [(i, c) for i, c in split if c]
    n_docs, length = len(split), sum(sum(c.values()) for _, c in split)
    df = Counter(t for _, c in split for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, counts in split:
            m = 25 + 75 * sum(counts.values()) * n_docs // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * (1_000_000_000 * counts[t] // (1000 * counts[t] + 8 * m))
                for t in plain_terms(text) if t in counts
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scored)[:top])]
    return out


ITEMS = "item_id bigint, text string, doc_id string"


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], ITEMS)


@pytest.fixture(scope="module")
def items(texts):
    r = random.Random(9)
    rows = []
    for i in range(40):
        split = (texts[r.randrange(250)][1] + " " + texts[r.randrange(250)][1]).split()
        begin = r.randrange(max(len(split) - 8, 1))
        rows.append((i, " ".join(split[begin : begin + r.randint(1, 12)]).title() + "?"))
    return [*rows, (40, None), (41, ""), (42, "nowhere"), (43, "x x x"), (44, "é word")]


@pytest.mark.parametrize("seed_docs", [65_536, 16])
def test_ranked_search_equals_brute_force(spark, tmp_path, monkeypatch, texts, items, seed_docs):
    monkeypatch.setattr(search, "SEED_DOCS", seed_docs)
    monkeypatch.setattr(search, "TREE_DOCS", 50)
    sf_dir = written(spark, tmp_path, documents=docs_of(spark, texts).repartition(3), benchmark=items_of(spark, items))
    got = [tuple(r) for r in QUERIES["op12_ranked_search"](spark, sf_dir).collect()]
    assert sorted(got) == sorted(plain_search(texts, items))


def test_ranked_search_in_blocks_of_items(spark, monkeypatch, odd, items):
    monkeypatch.setattr(search, "BLOCK_CHARS", 200)
    more = [*items, items[0], (None, items[1][1])]
    got = search.best_documents(docs_of(spark, odd), items_of(spark, more), top=3).collect()
    wanted = plain_search(odd, [*items, (None, items[1][1])], 3)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, wanted))


def test_ranked_search_of_nothing(spark, texts, items):
    none, some = docs_of(spark, texts).limit(0), docs_of(spark, [(1, None), (2, "?")])
    for docs, wanted in ((none, items), (some, items), (docs_of(spark, texts), []), (docs_of(spark, texts), [(1, None)])):
        assert search.best_documents(docs, items_of(spark, wanted)).collect() == []


def test_bounds_drop_pairs(texts, items):
    """The trees evaluate fewer pairs than there are, and find the same."""
    block = search.Items([(i, (t or "").encode()) for i, t in items])
    split = [(i, search.terms((t or "").encode())) for i, t in texts]
    split = [(i, c) for i, c in split if c]
    place = block.vocabulary
    df = Counter(place[t] for _, c in split for t in set(c) if t in place)
    block.weigh(len(split), sum(len(c) for _, c in split), df)
    found = search.Search(block, 1)
    seen = []
    keep = found._keep
    found._keep = lambda pairs, ids: keep((seen.append(len(p[1])) or p for p in pairs), ids)
    for _ in range(2):
        rows = [(k, place[t], n) for k, (_, c) in enumerate(split) for t, n in sorted(Counter(c).items()) if t in place]
        owner, term, tf = np.array(sorted(rows), np.int64).T
        found.add([i for i, _ in split], np.array([len(c) for _, c in split]), owner, term, tf)
        first, seen = (sum(seen), []) if not _ else (first, seen)
    assert sum(seen) < first / 3  # the second time the best are known
    assert [(i, 1, d, s) for i, d, s in [(block.ids[k], d, s) for k, d, s in found.results()]] and {
        (block.ids[k], d, s) for k, d, s in found.results()
    } == {(i, d, s) for i, _, d, s in plain_search(texts, items, 1)}


# --- vector codes ----------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, label int, ids string, code string, v int"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, k, "i", "c", 3) for i, v, k in rows], VECTORS)


def plain_codes(rows, parts=16, entries=64, rounds=2):
    kept = [(i, v, k) for i, v, k in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    whole = [[math.floor(256 * float(np.float32(x))) for x in v] for _, v, _ in kept]
    if not kept:
        return [], ""
    width = len(whole[0]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in whole]
    seeds = sorted(range(len(kept)), key=lambda k: kept[k][0])[:entries]
    books = [[list(cut[s][p]) for s in seeds] for p in range(parts)]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda part, book: min((square(part, e), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            chosen = {}
            for c in cut:
                chosen.setdefault(nearest(c[p], books[p])[1], []).append(c[p])
            for e, of in chosen.items():
                books[p][e] = [sum(x) // len(of) for x in zip(*of)]
    out, totals = [], Counter()
    for (i, _, label), c in zip(kept, cut):
        found = [nearest(c[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), label))
        totals[label] += out[-1][2]
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    return [(i, code, error, totals[label]) for i, code, error, label in out], hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("count, dims", [(400, 32), (30, 16)])
def test_vector_codes_equal_brute_force(spark, tmp_path, count, dims):
    r = random.Random(count)
    rows = [(i, [r.gauss(0, 0.5) for _ in range(dims)], r.choice([None, 1, 2])) for i in range(count)]
    rows += [(count, None, 1), (count + 1, [None] * dims, 1), (count + 2, [math.nan] * dims, 2), (count + 3, [math.inf] * dims, 2)]
    rows += [(count + 4, rows[3][1], 1), (count + 5, rows[3][1], 2), (-1, None, 1)]
    r.shuffle(rows)
    sf_dir = written(spark, tmp_path, embeddings=vectors_of(spark, rows).repartition(3))
    got = QUERIES["op13_vector_codes"](spark, sf_dir)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    wanted, digest = plain_codes(rows)
    assert sorted(tuple(x) for x in got.collect()) == sorted((*w, digest) for w in wanted)


def test_vector_codes_on_odd_rows(spark):
    r = random.Random(1)
    near = [[r.gauss(0, 1) for _ in range(16)] for _ in range(5)]
    rows = [(1, near[0], 1), (1, near[0], 1), (1, near[1], None), (None, near[2], None), (2, [], 1), (3, [0.5] * 17, 2), (0, [0.5] * 7, 2), (4, [3e38] * 16, 5)]
    made = vectors.compress(vectors_of(spark, rows))
    got = {}
    for row in made.rows.collect():
        got.setdefault(row.vec_id, []).append((row.code, row.error, row.label_error))
    assert [len(got[k]) for k in (1, None, 2, 3, 0, 4)] == [3, 1, 1, 1, 1, 1]
    assert got[2][0][:2] == got[3][0][:2] == got[0][0][:2] == (None, None)
    assert made.codebooks.shape == (16, 5, 1) and made.codebooks.max() == vectors.MOST
    # With an entry for every vector, each is its own code.
    assert {e for k in (1, None, 4) for _, e, _ in got[k]} == {0}
    code = got[None][0][0]
    assert vectors.decode(code, made.codebooks).tolist() == [math.floor(256 * float(np.float32(x))) for x in near[2]]
    for nothing in (vectors_of(spark, rows).limit(0), vectors_of(spark, [(1, None, 2), (2, [math.nan], 1)])):
        made = vectors.compress(nothing)
        assert made.rows.count() == 0 and vectors.describe(made.codebooks) == ""
    with pytest.raises(ValueError):
        vectors.compress(vectors_of(spark, rows), entries=300)


def test_equally_near_entries_go_to_the_lowest(spark):
    rows = [(k, [float(k // 2)] * 16, 1) for k in range(8)]
    got = vectors.compress(vectors_of(spark, rows), entries=8, rounds=1).rows.collect()
    assert {r.vec_id: r.code for r in got} == {k: f"{k // 2 * 2:02x}" * 16 for k in range(8)}
