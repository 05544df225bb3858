"""Ranked lexical search by dual trees: the best documents of every item, exactly.

A pass over the texts keeps, per document, its length and the counts of those terms
that any item has. Over these small vectors runs the search: a tree over the items and
one over each run of documents hold the largest value of each coordinate below a node.
The product of two nodes bounds the score of every item and document below them; pairs
of nodes whose bound is under the weakest k-th score of their items are dropped with
all they hold. At single items and documents the bound is the score itself.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import chain, repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import LongType, StructField, StructType

from .common import in_slices, stage

TOP = 10
#: Share of the length in a document's weight, in hundredths, and the factor of the
#: saturation of repeated terms.
LENGTH_SHARE = 75
SATURATION = 8
#: Characters of items that one pass over the documents serves; larger sets of items
#: go in several passes.
BLOCK_CHARS = 4_000_000
#: Documents whose best scores are the first bounds; all are searched after that.
SEED_DOCS = 65_536
#: Documents of one tree; children of a node of documents and of one of items.
TREE_DOCS, DOC_FAN, ITEM_FAN = 4096, 16, 8

#: Bytes of a text to terms and blanks: 0-9, a-z and all of other characters stay,
#: A-Z are lower-cased.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text."""
    return text.translate(_TABLE).split()


class Level(NamedTuple):
    """Coordinates of the nodes of one level: those of node i stand from ``starts[i]``
    to ``starts[i + 1]``."""

    starts: np.ndarray
    terms: np.ndarray
    values: np.ndarray

    def bounds(self, dense: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Products of ``dense`` with each of ``nodes``."""
        sizes = self.starts[nodes + 1] - self.starts[nodes]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[nodes] - ends + sizes, sizes)
        products = dense[self.terms[at]] * self.values[at]
        total = np.zeros(len(nodes), np.int64)
        some = sizes > 0
        if some.any():
            total[some] = np.add.reduceat(products, (ends - sizes)[some])
        return total


def hierarchy(owner: np.ndarray, term: np.ndarray, value: np.ndarray, count: int, fan: int) -> list[Level]:
    """Levels from single rows up to one root, each with the maxima of the one below.

    ``owner`` ascends from 0 to ``count`` - 1."""
    size = int(term.max()) + 1 if len(term) else 1
    levels = []
    while True:
        starts = np.searchsorted(owner, np.arange(count + 1))
        levels.append(Level(starts, term, value))
        if count <= 1:
            return levels
        owner, count = owner // fan, -(-count // fan)
        key = owner * size + term
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        value = np.maximum.reduceat(value[order], first) if len(first) else value
        owner, term = np.divmod(key[first], size)


class Items:
    """The items of one pass: their terms, and, once the corpus is counted, weights."""

    def __init__(self, rows: Sequence[tuple[object, bytes]]) -> None:
        counts = [Counter(terms(text)) for _, text in rows]
        self.ids = [i for i, _ in rows]
        self.vocabulary = {t: k for k, t in enumerate(sorted(set().union(*counts)))}
        self.coordinates = [
            sorted((self.vocabulary[t], n) for t, n in c.items()) for c in counts
        ]

    def weigh(self, docs: int, length: int, holding: dict[int, int]) -> None:
        """Take the number of documents, of their terms, and of documents per term."""
        self.docs, self.length = docs, length
        self.weight = np.array(
            [
                math.floor(1000 * math.log((2 * docs + 2) / (2 * holding.get(k, 0) + 1)))
                for k in range(len(self.vocabulary))
            ],
            np.int64,
        )
        # Items with the same rare terms become neighbours in the tree.
        weight = self.weight.tolist()
        rare = [sorted(((-weight[t] * n, t) for t, n in c))[:4] for c in self.coordinates]
        order = sorted(range(len(self.ids)), key=lambda i: [(t, w) for w, t in rare[i]])
        self.ids = [self.ids[i] for i in order]
        self.coordinates = [self.coordinates[i] for i in order]
        flat = [(i, t, n) for i, c in enumerate(self.coordinates) for t, n in c]
        owner, term, n = np.array(flat, np.int64).reshape(-1, 3).T
        self.levels = hierarchy(owner, term, self.weight[term] * n, len(self.ids), ITEM_FAN)
        self.at_least = np.zeros(len(self.ids), np.int64)

    def damped(self, sizes: Sequence[int]) -> np.ndarray:
        """What a document's length adds to the divisor of its terms' counts."""
        rest = 100 - LENGTH_SHARE
        # In Python's integers: the product may be beyond 64 bits.
        return np.array(
            [SATURATION * (rest + LENGTH_SHARE * n * self.docs // self.length) for n in sizes], np.int64
        )


class Search:
    """Best documents of each item among those given so far."""

    def __init__(self, items: Items, top: int) -> None:
        self.items, self.top = items, top
        self.best: list[list[tuple]] = [[] for _ in items.ids]
        self.weakest = items.at_least.copy()
        self.dense = np.zeros(max(len(items.vocabulary), 1), np.int64)

    def add(self, ids: Sequence, sizes: np.ndarray, owner: np.ndarray, term: np.ndarray, tf: np.ndarray) -> None:
        """Search one run of documents, given by their counts of the items' terms."""
        count = len(ids)
        if not len(term) or not len(self.items.ids):
            return
        value = 1_000_000_000 * tf // (1000 * tf + self.items.damped(sizes.tolist())[owner])
        # Documents with the same rare term become neighbours in the tree.
        gain = self.items.weight[term] * value
        order = np.lexsort((gain, owner))
        last = np.flatnonzero(np.diff(owner[order], append=count))
        heaviest = np.full(count, -1, np.int64)
        heaviest[owner[order][last]] = term[order][last]
        rank = np.argsort(heaviest, kind="stable")
        place = np.empty(count, np.int64)
        place[rank] = np.arange(count)
        order = np.lexsort((term, place[owner]))
        levels = hierarchy(place[owner][order], term[order], value[order], count, DOC_FAN)
        found = self._pairs(levels)
        self._keep(found, [ids[k] for k in rank.tolist()])

    def _pairs(self, levels: list[Level]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(item, documents, scores) of pairs that no bound has dropped."""
        own = self.items.levels
        weakest = [self.weakest]
        for _ in own[1:]:
            below = weakest[-1]
            weakest.append(np.minimum.reduceat(below, np.arange(0, len(below), ITEM_FAN)))
        a, b = len(own) - 1, len(levels) - 1
        pairs = {0: np.zeros(1, np.int64)}
        while True:
            alive = {}
            for node, docs in pairs.items():
                level = own[a]
                span = slice(level.starts[node], level.starts[node + 1])
                self.dense[level.terms[span]] = level.values[span]
                bound = levels[b].bounds(self.dense, docs)
                self.dense[level.terms[span]] = 0
                kept = (bound > 0) & (bound >= weakest[a][node])
                if not kept.any():
                    continue
                alive[node] = docs[kept]
                if a == b == 0:
                    yield node, docs[kept], bound[kept]
            if a == b == 0:
                return
            if b:
                n = len(levels[b - 1].starts) - 1
                for node, docs in alive.items():
                    wide = (docs[:, None] * DOC_FAN + np.arange(DOC_FAN)).ravel()
                    alive[node] = wide[wide < n]
                b -= 1
            if a:
                n = len(own[a - 1].starts) - 1
                alive = {
                    child: docs
                    for node, docs in alive.items()
                    for child in range(node * ITEM_FAN, min((node + 1) * ITEM_FAN, n))
                }
                a -= 1
            pairs = alive

    def _keep(self, found, ids: Sequence) -> None:
        for item, docs, scores in found:
            if len(scores) > self.top:
                least = np.partition(scores, -self.top)[-self.top]
                docs, scores = docs[scores >= least], scores[scores >= least]
            new = [
                (-score, ids[k] is None, ids[k]) if ids[k] is not None else (-score, True, 0)
                for k, score in zip(docs.tolist(), scores.tolist())
            ]
            best = heapq.nsmallest(self.top, self.best[item] + new)
            self.best[item] = best
            if len(best) == self.top:
                self.weakest[item] = max(self.weakest[item], -best[-1][0])

    def results(self) -> list[tuple[int, object, int]]:
        """(item, document, score), at most ``top`` of each item."""
        return [
            (item, None if none else doc, -score)
            for item, best in enumerate(self.best)
            for score, none, doc in best
        ]


def _vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Documents with a term: ``doc_id``, ``n`` (terms), ``terms`` and ``counts`` of
    those in ``vocabulary``."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)  # of one block of items
    size = max(len(vocabulary), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = known.value.get
        for batch in (part for whole in batches for part in in_slices(whole, 1)):
            split = [terms(t) if t else [] for t in batch.column(1).cast(pa.binary()).to_pylist()]
            sizes = np.array([len(s) for s in split], np.int64)
            found = np.fromiter(
                map(place, chain.from_iterable(split), repeat(-1)), np.int64, int(sizes.sum())
            )
            owner = np.repeat(np.arange(len(split)), sizes)
            key, count = np.unique((owner * size + found)[found >= 0], return_counts=True)
            owner, term = np.divmod(key, size)
            offsets = np.searchsorted(owner, np.arange(len(split) + 1)).astype(np.int32)
            lists = [
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.astype(np.int32)))
                for x in (term, count)
            ]
            made = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), *lists], ["doc_id", "n", "terms", "counts"]
            )
            yield made.filter(pa.array(sizes > 0))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, n bigint, terms array<int>, counts array<int>")


def _count(vectors: DataFrame, size: int) -> tuple[int, int, dict[int, int]]:
    """Documents, their terms, and documents per term; a row per term of the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 2, np.int64)  # the last two: documents, and terms
        for batch in batches:
            total[:size] += np.bincount(batch.column(1).flatten().to_numpy(), minlength=size)
            total[size] += batch.num_rows
            total[size + 1] += batch.column(0).to_numpy().sum()
        slots = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(slots, pa.int64()), pa.array(total[slots])], ["slot", "amount"]
        )

    sums = vectors.select("n", "terms").mapInArrow(run, "slot bigint, amount bigint")
    found = {r.slot: r.amount for r in sums.groupBy("slot").agg(F.sum("amount").alias("amount")).collect()}
    return found.pop(size, 0), found.pop(size + 1, 0), found


def _searched(vectors: DataFrame, items: Items, top: int) -> DataFrame:
    """(item, doc_id, score) of the best documents of every task."""
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(items)
    doc_type = vectors.schema["doc_id"].dataType
    kind = to_arrow_type(doc_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(shared.value, top)
        for whole in batches:
            for begin in range(0, whole.num_rows, TREE_DOCS):
                batch = whole.slice(begin, TREE_DOCS)
                each = np.diff(batch.column(2).offsets.to_numpy())
                search.add(
                    batch.column(0).to_pylist(), batch.column(1).to_numpy(),
                    np.repeat(np.arange(batch.num_rows), each),
                    batch.column(2).flatten().to_numpy().astype(np.int64),
                    batch.column(3).flatten().to_numpy().astype(np.int64),
                )
        item, doc, score = zip(*search.results()) if any(search.best) else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int64()), pa.array(doc, kind), pa.array(score, pa.int64())],
            ["item", "doc_id", "score"],
        )

    schema = StructType(
        [StructField("item", LongType()), StructField("doc_id", doc_type), StructField("score", LongType())]
    )
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = vectors.mapInArrow(run, schema).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= top)


def _blocks(items: DataFrame) -> Iterator[Items]:
    """Distinct items with a text, in blocks of about :data:`BLOCK_CHARS` characters:
    what the driver and the workers hold at a time does not grow with the items."""
    known = items.where("text is not null").distinct()
    chars = known.agg(F.sum(F.length("text")).alias("n")).first().n or 0
    blocks = -(-chars // BLOCK_CHARS)
    dealt = known.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1))))
    for k in range(blocks):
        rows = dealt.where(F.col("block") == k).orderBy("item_id", "text").collect()
        if rows:
            yield Items([(r.item_id, r.text.encode()) for r in rows])


def best_documents(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
) -> DataFrame:
    """The ``top`` documents of every item: ``item_id``, ``rank``, ``doc_id``, ``score``.

    Terms are runs of 0-9, A-Z, a-z and characters beyond ASCII, A-Z in lower case.
    With N documents that have a term, L terms in all, n in a document, a term that is
    in df documents and tf times in this one weighs w = floor(1000 ln((2N+2)/(2df+1)))
    and adds w * (10^9 tf div (1000 tf + 8 m)), m = 25 + 75 n N div L, for each time
    it stands in the item. Scores are 64-bit integers; ranks run from 1 without gaps,
    equal scores by ascending ``doc_id`` (null last). Only scores above 0 count, so
    an item may have fewer rows, or none if its text is null, empty or unmatched.

    A repeated document row is a document of its own. A repeated item counts once; an
    id with several texts is ranked for each of them. Other columns are not used.
    Every document is read whole; the bounds only save products.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    wanted = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
    spark = docs.sparkSession
    id_type = wanted.schema["item_id"].dataType
    schema = StructType(
        [StructField("item", LongType()), StructField("item_id", id_type)]
    )
    made = []
    for block in _blocks(wanted):
        vectors = stage(_vectors(source, block.vocabulary), "search_vectors")
        n, length, holding = _count(vectors, len(block.vocabulary))
        if not n:
            continue
        block.weigh(n, length, holding)
        if n > SEED_DOCS:
            # The k-th score among some documents bounds the k-th among all.
            some = vectors.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(-(-n // SEED_DOCS))) == 0)
            least = _searched(some, block, top).where(F.col("rank") == top).select("item", "score")
            for row in least.collect():  # at most one row per item of the block
                block.at_least[row.item] = row.score
        names = spark.createDataFrame(list(enumerate(block.ids)), schema)
        made.append(
            _searched(vectors, block, top).join(names, "item").select("item_id", "rank", "doc_id", "score")
        )
    if not made:
        schema = StructType(
            [
                StructField("item_id", id_type), StructField("rank", LongType()),
                StructField("doc_id", source.schema["doc_id"].dataType), StructField("score", LongType()),
            ]
        )
        return spark.createDataFrame([], schema).withColumn("rank", F.col("rank").cast("int"))
    out = made[0]
    for more in made[1:]:
        out = out.unionAll(more)
    return out
