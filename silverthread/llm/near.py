"""Near-duplicates: ProbMinHash signatures, banding, verification, components.

Texts with the same words are one node. Its five-word shingles weigh by their letters
and send points at the times of Poisson processes of these rates, so that the registers of two nodes agree with the chance that is their probability Jaccard
similarity, the measure by which links are defined. Nodes that share a band are linked
to its most central one if they are as similar as asked, linked nodes form components,
and bands that still hold several components are compared across these.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import BinaryType, DoubleType

from .common import content_id, in_slices, mostly_among, stage

WORDS = 5
MIN_SIMILARITY = 0.8
#: 24 bands of 5 registers: a pair at similarity 0.8 shares none with chance 7e-5.
BANDS, ROWS = 24, 5
REGISTERS = BANDS * ROWS
#: A pair as similar as asked has too few equal registers to be compared with less than
#: this chance.
MAX_MISS = 1e-7
#: The nodes of a band are dealt to so many tasks when they meet its central node.
SALTS = 8
#: Shingles whose arrivals are drawn at a time, and shingles of the nodes of a band, or
#: nodes by their registers, that are compared with each other at a time.
SHINGLES_AT_ONCE = 1_000_000
TILE_SHINGLES = 1_000_000
TILE_NODES = 4_000

_WORD = re.compile(r"\w+")
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def least_equal(similarity: float) -> int:
    """Pairs with fewer equal registers are not compared: at that similarity the count
    is binomial, and below this with less than :data:`MAX_MISS` chance (71 at 0.8)."""
    below = 0.0
    for count in range(REGISTERS + 1):
        below += math.comb(REGISTERS, count) * similarity**count * (1 - similarity) ** (REGISTERS - count)
        if below >= MAX_MISS:
            return count
    return REGISTERS


class _WordHashes(dict):
    """64-bit hashes of words; starts anew when it is full."""

    def __missing__(self, word: str) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= 300_000:
            self.clear()
        self[word] = value
        return value


_hashes = _WordHashes()


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def shingles(text_words: list[str]) -> np.ndarray:
    """64-bit hashes of all runs of five words; of all words if there are fewer."""
    n = len(text_words)
    h = np.fromiter(map(_hashes.__getitem__, text_words), np.uint64, n)
    if n == 0:
        return h
    run = min(WORDS, n)
    total = h[: n - run + 1].copy()
    for k in range(1, run):
        total = _mix(total + _GOLDEN) + h[k : n - run + 1 + k]
    return _mix(total + np.uint64(run))


def weighted_shingles(text_words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles, ascending, and their weights: the letters of their words. So a
    similarity is a share of the text, and a line counts once however often it stands."""
    n = len(text_words)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0)
    letters = np.cumsum([0, *map(len, text_words)])
    run = min(WORDS, n)
    found, first = np.unique(shingles(text_words), return_index=True)
    return found, (letters[run:] - letters[:-run])[first].astype(float)


def probability_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """The chance that two weighted sets agree in a register of :func:`signatures`: the
    sum over common elements d of 1 / sum over all e of max(wa[e] / wa[d], wb[e] / wb[d]).
    Plain Jaccard where all weights are equal. Elements are distinct and ascending.

    In order of wa / wb, the elements from d on count by wa, those before it by wb.
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    common, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    x, y = wa[ia], wb[ib]
    ratio = x / y
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    first = np.searchsorted(ratio, ratio)  # equal ratios count alike
    from_here = (wa.sum() - x.sum()) + np.append(np.cumsum(x[::-1])[::-1], 0.0)[first]
    before = (wb.sum() - y.sum()) + np.append(0.0, np.cumsum(y))[first]
    return float((1 / (from_here / x + before / y)).sum())


#: Sums of many quotients may fall short of the similarity they make by so much.
_ROUNDING = 1e-9


def signatures(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, owners: int) -> np.ndarray:
    """ProbMinHash registers of each owner's weighted elements.

    Element d of weight w sends points at the times of a Poisson process of rate w,
    each into a random register; a register keeps the element of its first point. So
    two owners agree in a register with the chance that is their probability Jaccard.
    An element stops once its time is past the last register's of its owner. Owners
    without elements have all registers 0.
    """
    first = np.full(owners * REGISTERS, np.inf)
    kept = np.zeros(owners * REGISTERS, np.uint64)
    latest = np.full(owners, np.inf)
    time = np.zeros(len(elements))
    step = np.uint64(0)
    with np.errstate(over="ignore"):
        while len(elements):
            step += np.uint64(1)
            draw = _mix(elements + step * _GOLDEN)
            uniform = ((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
            time = time - np.log(uniform) / weights
            alive = time < latest[owner]
            elements, weights, owner, time = elements[alive], weights[alive], owner[alive], time[alive]
            register = _mix(draw[alive] + _GOLDEN) % np.uint64(REGISTERS)
            at = owner * REGISTERS + register.astype(np.int64)
            np.minimum.at(first, at, time)
            won = first[at] == time
            kept[at[won]] = elements[won]
            touched = np.flatnonzero(np.bincount(owner, minlength=owners))
            latest[touched] = first.reshape(owners, REGISTERS)[touched].max(1)
    return kept.reshape(owners, REGISTERS)


def _describe(texts: list[str | None]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Digest of the words, number of distinct shingles and registers of each text."""
    digests, sizes, made = [], np.zeros(len(texts), np.int64), []
    elements, weights, owners, waiting, begun = [], [], [], 0, 0

    def finish(end: int) -> None:
        nonlocal waiting, begun
        made.append(
            signatures(
                np.concatenate(elements or [np.zeros(0, np.uint64)]),
                np.concatenate(weights or [np.zeros(0)]),
                np.concatenate(owners or [np.zeros(0, np.int64)]),
                end - begun,
            )
        )
        elements.clear(), weights.clear(), owners.clear()
        waiting, begun = 0, end

    for i, text in enumerate(texts):
        text_words = words(text)
        digests.append(xxhash.xxh3_128_digest("\x1f".join(text_words)))
        found, weight = weighted_shingles(text_words)
        sizes[i] = len(found)
        elements.append(found)
        weights.append(weight)
        owners.append(np.full(len(found), i - begun, np.int64))
        waiting += len(found)
        if waiting >= SHINGLES_AT_ONCE:
            finish(i + 1)
    finish(len(texts))
    return digests, sizes, np.concatenate(made)


def sketch(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row: ``doc``, ``row`` (hash of id and text), ``node`` (digest of the words),
    ``size`` (distinct shingles), ``sig`` (8 bits of each register, so that unequal ones
    are taken for equal at times, never the other way) and ``bands``."""
    source = docs.select(
        F.col(doc_id).alias("doc"), content_id(F.col(doc_id), F.col(text)).alias("row"),
        F.col(text).alias("text"),
    )
    kind = source.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in in_slices(whole, 2):
                digests, sizes, kept = _describe(batch.column(2).to_pylist())
                n = len(digests)
                with np.errstate(over="ignore"):
                    short = (_mix(kept) >> np.uint64(56)).astype(np.uint8).view(np.int8)
                    by_band = kept.reshape(n, BANDS, ROWS)
                    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (n, BANDS))
                    for k in range(ROWS):
                        key = _mix(key + _GOLDEN) + by_band[:, :, k]
                    key = _mix(key).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), batch.column(1), pa.array(digests, pa.binary()),
                        pa.array(sizes),
                        pa.FixedSizeListArray.from_arrays(pa.array(short.ravel()), REGISTERS).cast(pa.list_(pa.int8())),
                        pa.FixedSizeListArray.from_arrays(pa.array(key.ravel()), BANDS).cast(pa.list_(pa.int64())),
                    ],
                    ["doc", "row", "node", "size", "sig", "bands"],
                )

    return source.mapInArrow(
        run, f"doc {kind}, row bigint, node binary, size bigint, sig array<tinyint>, bands array<bigint>"
    )


def similarity(a: Column, b: Column) -> Column:
    """Probability Jaccard similarity of the weighted shingles of two texts, exactly."""

    @F.arrow_udf(DoubleType())
    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        known = lru_cache(maxsize=64)(lambda text: weighted_shingles(words(text)))
        pairs = zip(left, right)
        return pa.array([probability_jaccard(*known(x.as_py() or ""), *known(y.as_py() or "")) for x, y in pairs], pa.float64())

    return run(a, b)


_EQUAL = "aggregate(zip_with({}, {}, (x, y) -> if(x = y, 1, 0)), 0, (s, v) -> s + v)"


def _texts(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(node, text) of the nodes in ``wanted``; the texts are read once more, and only
    those, with a few others, are shuffled."""
    needed = stage(nodes.join(wanted, "node").select("node", "doc", "row"), "near_needed")
    texts = docs.select(
        F.col(doc_id).alias("__doc"),
        content_id(F.col(doc_id), F.col(text)).alias("__row"),
        F.col(text).alias("text"),
    )
    same = (F.col("__row") == F.col("row")) & F.col("__doc").eqNullSafe(F.col("doc"))
    found = mostly_among(texts, "__row", needed.select(F.col("row").alias("__row")))
    return found.join(needed, same).select("node", "text").dropDuplicates(["node"])


def _packed_shingles(text: Column) -> Column:
    """Shingles and weights of a text as one binary; see :func:`_unpacked`."""

    @F.arrow_udf(BinaryType())
    def run(texts: pa.Array) -> pa.Array:
        made = (weighted_shingles(words(t.as_py())) for t in texts)
        return pa.array([h.tobytes() + w.tobytes() for h, w in made], pa.binary())

    return run(text)


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    half = len(data) // 2
    return np.frombuffer(data, np.uint64, half // 8), np.frombuffer(data, np.float64, half // 8, half)


def _verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) of at least that similarity."""
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b"
    )
    return both.where(similarity(F.col("ta"), F.col("tb")) >= least - _ROUNDING).select("a", "b")


def _likely(pairs: DataFrame, nodes: DataFrame, least: int) -> DataFrame:
    """Pairs (a, b) with at least that many equal registers."""
    a = nodes.select(F.col("node").alias("a"), F.col("sig").alias("sa"))
    b = nodes.select(F.col("node").alias("b"), F.col("sig").alias("sb"))
    joined = pairs.join(a, "a").join(b, "b")
    return joined.where(F.expr(_EQUAL.format("sa", "sb")) >= least).select("a", "b")


class _Tile:
    """Nodes of one band, or of two parts of one, that are compared across roots."""

    def __init__(self, rows: list[dict], least: float, equal: int) -> None:
        self.rows, self.least, self.equal = rows, least, equal
        self.signs = np.array([r["sig"] for r in rows], np.int8)
        self.bands = np.array([r["bands"] for r in rows], np.int64)
        names = {root: k for k, root in enumerate(dict.fromkeys(r["root"] for r in rows))}
        self.root = np.array([names[r["root"]] for r in rows])
        self.parent = list(range(len(names)))

    def _find(self, root: int) -> int:
        while self.parent[root] != root:
            self.parent[root] = self.parent[self.parent[root]]
            root = self.parent[root]
        return root

    def _likeness(self) -> Callable[[int, np.ndarray], np.ndarray]:
        """Similarity of a row to each of others. Where a shingle weighs the same in all
        rows it is what both have as a share of what either has, for many rows at once."""
        held = [_unpacked(r["sh"]) for r in self.rows]
        found, flat = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
        ends = np.cumsum([len(h) for h, _ in held])
        weight = np.zeros(len(found))
        weight[flat] = weights = np.concatenate([w for _, w in held])
        if (weight[flat] != weights).any():
            return lambda a, others: np.array([probability_jaccard(*held[a], *held[b]) for b in others.tolist()])
        number = np.split(flat, ends[:-1])
        total = np.array([w.sum() for _, w in held])
        own = np.zeros(len(found))

        def run(a: int, others: np.ndarray) -> np.ndarray:
            theirs = [number[b] for b in others.tolist()]
            begins = np.cumsum([0, *map(len, theirs[:-1])])
            own[number[a]] = weight[number[a]]
            both = np.add.reduceat(own[np.concatenate(theirs)], begins)
            own[number[a]] = 0.0
            return both / (total[a] + total[others] - both)

        return run

    def _meetings(self, band: int, lo: int, hi: int) -> Iterator[tuple[int, np.ndarray]]:
        """Rows, each with those of other roots that it is to be compared with: a pair
        meets in the first band that holds both, if it has enough equal registers."""
        own = np.array([r["own"] for r in self.rows])
        left = np.flatnonzero(own == lo)
        right = left if lo == hi else np.flatnonzero(own == hi)
        place = (self.bands == band).argmax(1)
        for a in left.tolist():
            others = right[right > a] if lo == hi else right
            others = others[self.root[others] != self.root[a]]
            if not len(others):
                continue
            alike = (self.signs[others] == self.signs[a]).sum(1) >= self.equal
            others = others[alike]
            before = np.arange(BANDS) < place[a]
            met = ((self.bands[others] == self.bands[a]) & before).any(1)
            if not met.all():
                yield a, others[~met]

    def meeting(self, band: int, lo: int, hi: int) -> list[dict]:
        """Rows that are to be compared with any other."""
        marked = np.zeros(len(self.rows), bool)
        for a, others in self._meetings(band, lo, hi):
            marked[a] = marked[others] = True
            if marked.all():
                break
        return [self.rows[k] for k in np.flatnonzero(marked).tolist()]

    def links(self, band: int, lo: int, hi: int) -> Iterator[tuple[bytes, bytes]]:
        """Linked roots that are not yet connected by others of this tile; the shingles
        are compared in full."""
        alike = None
        for a, others in self._meetings(band, lo, hi):
            own = self._find(self.root[a])
            others = others[[self._find(root) != own for root in self.root[others].tolist()]]
            if not len(others):
                continue
            alike = alike or self._likeness()
            for b in others[alike(a, others) >= self.least - _ROUNDING].tolist():
                x, y = self._find(self.root[a]), self._find(self.root[b])
                if x != y:
                    self.parent[x] = y
                    yield self.rows[a]["root"], self.rows[b]["root"]


def _in_parts(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """``members`` (band, node, root) with the ``parts`` that their band is cut into by the
    shingles of its nodes."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    parts = (
        members.join(sizes, "node").groupBy("band")
        .agg(F.ceil(F.sum(F.col("size") + 1) / TILE_SHINGLES).cast("int").alias("parts"))
        .select("band", "parts", salts)
    )
    salt = F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")
    return members.withColumn("salt", salt).join(parts, ["band", "salt"]).drop("salt")


def _work(members: DataFrame, held: DataFrame) -> DataFrame:
    """The nodes of ``members`` (band, node, root, parts) with what ``held`` tells of them,
    laid out by work items: every two parts of a band are an item of bounded size. What
    ``held`` tells is shuffled by item once."""
    items = (
        members.withColumn("own", F.pmod(F.xxhash64(F.lit(1), "node"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "band", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
            "own", "node", "root",
        )
    )
    return (
        items.join(held, "node")
        .repartition("band", "lo", "hi")
        .sortWithinPartitions("band", "lo", "hi", "node")
    )


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int, int], list[dict]]]:
    """Work items (band, lo, hi) and their rows."""
    item, rows = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        own = {c: batch.column(c).flatten().to_numpy().reshape(batch.num_rows, -1) for c in ("sig", "bands")}
        at, rest = 0, batch.drop_columns(["sig", "bands"])
        sized = rest.schema.get_field_index("sh")
        for part in in_slices(rest, sized) if sized >= 0 else [rest]:
            for row in part.to_pylist():
                key = row["band"], row["lo"], row["hi"]
                if key != item:
                    if len(rows) > 1:
                        yield item, rows
                    item, rows = key, []
                rows.append(row | {c: made[at] for c, made in own.items()})
                at += 1
    if len(rows) > 1:
        yield item, rows


def _meeting(members: DataFrame, nodes: DataFrame, least: float, equal: int) -> DataFrame:
    """(band, node, root) of the ``members`` (band, node, root, crowd) whose nodes
    :func:`_residual` compares with any other of their band, told from the registers
    alone: no text or shingle moves for the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for item, rows in _items(batches):
            found = _Tile(rows, least, equal).meeting(*item)
            bands = pa.array([item[0]] * len(found), pa.int64())
            ends = [pa.array([row[c] for row in found], pa.binary()) for c in ("node", "root")]
            yield pa.RecordBatch.from_arrays([bands, *ends], ["band", "node", "root"])

    parts = F.ceil(F.col("crowd") / TILE_NODES).cast("int").alias("parts")
    work = _work(members.select("band", "node", "root", parts), nodes.select("node", "sig", "bands"))
    return work.mapInArrow(run, "band bigint, node binary, root binary").distinct()


def _residual(members: DataFrame, held: DataFrame, least: float, equal: int) -> DataFrame:
    """Different roots (a, b) of linked nodes of one band.

    ``members`` has band, node and root, ``held`` the size, registers, bands and shingles
    of each node. What comes out are links alone, at most one less than there are roots
    in a work item.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for item, rows in _items(batches):
            found = list(_Tile(rows, least, equal).links(*item))
            ends = [pa.array([pair[k] for pair in found], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(ends, ["a", "b"])

    work = _work(_in_parts(members, held.select("node", "size")), held.drop("size"))
    return work.mapInArrow(run, "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that is linked with each node of ``edges``
    (a, b), a written table. In each step a node asks its neighbours and its root for
    their roots and takes the smallest; each step is one written table, and the steps
    end when no root changes."""
    links = edges.select(F.col("a").alias("node"), F.col("b").alias("asked"))
    links = links.unionAll(edges.select("b", "a"))
    labels = stage(
        links.groupBy("node").agg(F.min("asked").alias("m")).select("node", F.least("node", "m").alias("root")),
        "near_labels",
    )
    while True:
        asks = links.withColumn("before", F.lit(None).cast("binary")).unionAll(
            labels.select("node", F.col("root").alias("asked"), F.col("root").alias("before"))
        )
        told = labels.select(F.col("node").alias("asked"), "root")
        labels = stage(
            asks.join(told, "asked").groupBy("node").agg(F.min("root").alias("root"), F.min("before").alias("before")),
            "near_labels",
        )
        if labels.where(F.col("root") != F.col("before")).isEmpty():
            return labels.select("node", "root")


def classes(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    min_similarity: float = MIN_SIMILARITY,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``class_id``, ``row`` (see :func:`sketch`) and
    ``root``, which tells classes apart where rows of one id are in several.

    Two texts are linked if the probability Jaccard similarity of their five-word
    shingles (words in lower case, without punctuation; fewer words are one shingle),
    weighted by their letters, is at least ``min_similarity``: the letters of the
    shingles that both have, as a share of those that either has; a class is what links connect, and its id the smallest
    document id in it. Texts of equal words are one class whatever their length;
    those without words (null, empty, punctuation) are one class of their own.
    A pair at 0.8 shares no band with chance 7e-5; at a lower ``min_similarity`` s that is
    (1 - s^5)^24.
    """
    equal = least_equal(min_similarity)
    sketched = stage(sketch(docs, text, doc_id), "near_sketch")
    one = [F.first(c).alias(c) for c in sketched.columns if c != "node"]
    nodes = stage(sketched.groupBy("node").agg(F.min("doc").alias("least"), *one), "near_nodes")
    banded = nodes.where("size > 0").select("node", F.explode("bands").alias("band"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    salt = F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")
    crowds = (
        banded.groupBy("band").agg(F.count("*").alias("crowd")).where("crowd > 1")
        .select("band", "crowd", salts)
    )
    # What the others were copied from shares bands with most of them.
    central = F.sum("crowd").over(Window.partitionBy("node")).alias("central")
    shared = stage(
        banded.withColumn("salt", salt).join(crowds, ["band", "salt"]).select("band", "node", "crowd", central),
        "near_bands",
    )
    firsts = (
        shared.groupBy("band")
        .agg(F.max(F.struct("central", "node")).alias("first"))
        .select("band", F.col("first.node").alias("first"), salts)
    )
    # By one end, as the registers of that end are joined next.
    star = (
        shared.withColumn("salt", salt)
        .join(firsts, ["band", "salt"])
        .where(F.col("node") != F.col("first"))
        .select(F.col("node").alias("a"), F.col("first").alias("b"))
        .repartition("a")
        .distinct()
    )
    likely = stage(_likely(star, nodes, equal), "near_pairs")
    ends = likely.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    texts = stage(_texts(ends, nodes, docs, text, doc_id), "near_texts")
    edges = stage(_verified(likely, texts, min_similarity), "near_edges")
    rooted = components(edges)

    # Bands that hold several components: links across them. Registers tell which nodes
    # are to be compared; of these alone the shingles move, and are compared as the pairs
    # meet, so that only links come out.
    placed = shared.join(rooted, "node", "left").select(
        "band", "node", "crowd", F.coalesce("root", "node").alias("root")
    )
    mixed = placed.groupBy("band").agg(F.min("root").alias("x"), F.max("root").alias("y")).where(
        F.col("x") != F.col("y")
    ).select("band")
    mixed = stage(placed.join(mixed, "band"), "near_mixed")
    members = stage(_meeting(mixed, nodes, min_similarity, equal), "near_meeting")
    named = nodes.join(rooted, "node", "left").select(
        "node", F.coalesce("root", "node").alias("root"), "least"
    )
    if not members.isEmpty():
        held = _texts(members.select("node").distinct(), nodes, docs, text, doc_id).select(
            "node", _packed_shingles(F.col("text")).alias("sh")
        )
        held = stage(held.join(nodes.select("node", "size", "sig", "bands"), "node"), "near_shingles")
        found = stage(_residual(members, held, min_similarity, equal), "near_edges")
        if not found.isEmpty():
            tops = components(found).select(F.col("node").alias("root"), F.col("root").alias("top"))
            named = named.join(tops, "root", "left").select(
                "node", F.coalesce("top", "root").alias("root"), "least"
            )

    ids = named.groupBy("root").agg(F.min("least").alias("class_id"))
    by_node = stage(named.join(ids, "root").select("node", "class_id", "root"), "near_classes")
    return sketched.select("doc", "row", "node").join(by_node, "node").select(
        F.col("doc").alias("doc_id"), "class_id", "row", "root"
    )
