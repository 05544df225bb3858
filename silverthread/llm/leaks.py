"""Benchmark decontamination: BM25 search of every passage for benchmark items.

The test items form an inverted index of posting lists with block maxima. All passages
of all texts are queries; WAND's pivots and the block maxima tell which blocks of items
can reach the threshold, these are scored in full, and what passes is verified word by
word.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from .common import free_name, in_slices

#: A passage is a hit if it scores at least this share of the item's own score.
MIN_SCORE = 0.6
#: Least share of an item that a passage must hold, and of its question and of its
#: answer. A share is that of its five-word shingles or of its words in order, whichever
#: is more: an edit of one word breaks five shingles, a moved sentence the order.
MIN_OVERLAP = 0.8
MIN_PART_OVERLAP = 0.5
SHINGLE = 5
#: Items of fewer words identify nothing and match nothing; those of fewer than
#: MIN_EDITED_WORDS must stand by their shingles, since a few words with one changed are
#: a phrase of its own.
MIN_ITEM_WORDS = SHINGLE
MIN_EDITED_WORDS = 8
#: Items in one index, and most words of an item that are indexed as one entry; longer
#: items are cut into parts of near-equal size.
MAX_ITEMS = 5_000
MAX_ENTRY_WORDS = 256
#: Entries that share one block maximum.
BLOCK = 8
#: (passage, term) rows, and (passage, block) cells, that are summed at a time.
ROWS_AT_ONCE, CELLS_AT_ONCE = 200_000, 2_000_000

_WORD = re.compile(r"\w+")
_SENTENCE_END = re.compile(r"(?<=[.?!])\s+|\n+")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """Words of an item without its last sentence, and of that sentence.

    An item of one sentence is all question.
    """
    parts = [w for w in map(words, _SENTENCE_END.split(text)) if w]
    if len(parts) < 2:
        return words(text), []
    return [w for part in parts[:-1] for w in part], parts[-1]


def _shingles(text_words: Sequence[str]) -> set[tuple[str, ...]]:
    n = min(SHINGLE, len(text_words))
    return set(zip(*(text_words[k:] for k in range(n)))) if n else set()


def _share(part: Sequence[str], passage: Sequence[str], held: set[tuple[str, ...]]) -> float:
    own = _shingles(part)
    if not own:
        return 1.0
    if len(part) < SHINGLE:
        held = set(zip(*(passage[k:] for k in range(len(part)))))
    return len(own & held) / len(own)


class _Aligner:
    """Share of a text's words that stand in a passage in order: one less the least word
    edits to any run of the passage, by bit-parallel rows."""

    def __init__(self, text_words: Sequence[str]) -> None:
        self.size = len(text_words)
        self.places: dict[str, int] = {}
        for k, word in enumerate(text_words):
            self.places[word] = self.places.get(word, 0) | 1 << k

    def share(self, passage: Sequence[str]) -> float:
        if not self.size:
            return 1.0
        full, last = (1 << self.size) - 1, 1 << self.size - 1
        up, down, edits = full, 0, self.size
        least = edits
        for word in passage:
            equal = self.places.get(word, 0)
            level = (((equal & up) + up) ^ up) | equal
            rise = down | (full & ~(level | up))
            fall = up & level
            if rise & last:
                edits += 1
            elif fall & last:
                edits -= 1
                least = min(least, edits)
            level = equal | down
            rise, fall = rise << 1 & full, fall << 1 & full
            up, down = fall | (full & ~(level | rise)), rise & level
        return 1 - least / self.size


class _Item:
    """What a passage must hold: the whole item, its question and its answer."""

    def __init__(self, text: str) -> None:
        self.words = words(text)
        self.counts = Counter(self.words)
        self.parts = question_and_answer(text)
        self.aligners = [_Aligner(w) for w in (self.words, *self.parts)]

    def overlap(self, passage: Sequence[str]) -> float | None:
        """The share of the item in the passage, or None if the item, its question or
        its answer is not there."""
        held = _shingles(passage)
        shares = [_share(w, passage, held) for w in (self.words, *self.parts)]
        if len(self.words) >= MIN_EDITED_WORDS:
            present = set(passage)
            common = sum(n for word, n in self.counts.items() if word in present)
            if common >= MIN_OVERLAP * len(self.words):
                shares = [max(s, a.share(passage)) for s, a in zip(shares, self.aligners)]
        fine = shares[0] >= MIN_OVERLAP and min(shares[1:]) >= MIN_PART_OVERLAP
        return shares[0] if fine else None


class ItemIndex:
    """BM25 index of items; scores are shares of an item's score for itself."""

    def __init__(self, items: Sequence[tuple[object, str]], k1: float = 1.2, b: float = 0.75) -> None:
        self.items: list[object] = []
        self.wholes: list[_Item] = []
        self.entries: list[list[str]] = []
        #: Of each entry, the place of its item and its first word there.
        self.origins: list[tuple[int, int]] = []
        for item, text in items:
            whole = _Item(text)
            size = len(whole.words)
            if size < MIN_ITEM_WORDS:
                continue
            parts = -(-size // MAX_ENTRY_WORDS)
            for k in range(parts):
                start = size * k // parts
                self.entries.append(whole.words[start : size * (k + 1) // parts])
                self.origins.append((len(self.items), start))
            self.items.append(item)
            self.wholes.append(whole)
        self.stride = max(map(len, self.entries), default=1)
        self.vocabulary: dict[str, int] = {}
        n = len(self.entries)
        blocks = -(-n // BLOCK)
        rows, columns, counts = [], [], []
        for i, entry in enumerate(self.entries):
            for word in sorted(set(entry)):
                rows.append(self.vocabulary.setdefault(word, len(self.vocabulary)))
                columns.append(i)
                counts.append(entry.count(word))
        rows, columns, tf = np.array(rows, int), np.array(columns, int), np.array(counts, float)
        lengths = np.array([len(e) for e in self.entries], float)
        df = np.bincount(rows, minlength=len(self.vocabulary)) if n else np.zeros(0)
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        if n:
            scale = k1 * (1 - b + b * lengths[columns] / lengths.mean())
            gain = idf[rows] * tf * (k1 + 1) / (tf + scale)
            gain /= np.bincount(columns, gain, n)[columns]
        else:
            gain = np.zeros(0)
        # Terms are numbered by their largest gain, the order in which pivots are found.
        largest = np.zeros(len(self.vocabulary))
        np.maximum.at(largest, rows, gain)
        rank = np.empty(len(largest), int)
        rank[np.argsort(largest, kind="stable")] = np.arange(len(largest))
        rows = rank[rows]
        self.vocabulary = {word: int(rank[k]) for word, k in self.vocabulary.items()}
        # Posting lists: for each term its entries in ascending order, in stretches of one
        # block each, with the largest gain of the stretch and of the list.
        order = np.lexsort((columns, rows))
        term, entry, gain = rows[order], columns[order], gain[order].astype(np.float32)
        cut = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (entry[1:] // BLOCK != entry[:-1] // BLOCK)))
        cut = cut[: len(term)]
        self.entry_of, self.gain_of = entry, gain
        self.stretch_ends = np.append(cut, len(term))
        self.stretch_block = entry[cut] // BLOCK
        self.stretch_max = np.maximum.reduceat(gain, cut) if len(cut) else gain
        self.list_starts = np.searchsorted(term[cut], np.arange(len(self.vocabulary) + 1))
        first = self.list_starts[:-1]
        self.term_max = np.append(np.maximum.reduceat(self.stretch_max, first) if len(first) else [], 0.0).astype(np.float32)
        self.blocks = blocks

    def search(self, texts: Sequence[str | None], min_score: float) -> list[tuple[int, int, float, float]]:
        """(text, item, score, overlap) of the verified hits by their best passages.

        An item in several parts is searched by each and verified as a whole, around the
        passage of the part."""
        if not self.entries:
            return []
        vocabulary, stride = self.vocabulary.get, self.stride
        split = [words(t) for t in texts]
        # Passages are two strides long and start at each stride, so wherever an item
        # stands, one passage holds it whole.
        first = np.cumsum([0, *(len(w) // stride + 1 for w in split)])
        keys, size = [], len(self.vocabulary)
        for i, text_words in enumerate(split):
            terms = np.fromiter(map(vocabulary, text_words, repeat(-1)), np.int64, len(text_words))
            at = np.flatnonzero(terms >= 0)
            found, passage = terms[at], first[i] + at // stride
            keys.append(passage * size + found)
            later = at >= stride
            keys.append((passage[later] - 1) * size + found[later])
        keys = np.unique(np.concatenate(keys))
        passage, term = np.divmod(keys, size)
        best: dict[tuple[int, int], tuple[float, float]] = {}
        for p, entry, score in self._scored(passage, term, min_score):
            i = int(np.searchsorted(first, p, side="right")) - 1
            item, offset = self.origins[entry]
            whole = self.wholes[item]
            # Words put in between may push an item's end out of the passage.
            size, slack = len(whole.words), -(-len(whole.words) // 4)
            start = (p - int(first[i])) * stride
            end = start + 2 * stride + size - offset - len(self.entries[entry]) + slack
            overlap = whole.overlap(split[i][max(0, start - offset - slack) : end])
            if overlap is not None:
                best[i, item] = max(best.get((i, item), (0.0, 0.0)), (score, overlap))
        return [(i, item, *best[i, item]) for i, item in sorted(best)]

    def _scored(self, passage, term, least) -> Iterator[tuple[int, int, float]]:
        """(passage, entry, score) of at least ``least``, some passages at a time."""
        least = np.float32(least - 1e-4)
        starts = np.flatnonzero(np.append(True, passage[1:] != passage[:-1])) if len(passage) else []
        starts = np.append(starts, len(passage)).astype(int)
        most = max(CELLS_AT_ONCE // max(self.blocks, 1), 1)
        begin = 0
        while begin < len(starts) - 1:
            end = int(np.searchsorted(starts, starts[begin] + ROWS_AT_ONCE, side="right")) - 1
            end = min(max(end, begin + 1), begin + most)
            rows = slice(starts[begin], starts[end])
            names = passage[starts[begin:end]]
            own = np.repeat(np.arange(end - begin), np.diff(starts[begin : end + 1]))
            for which, entry, score in zip(*self._wand(own, term[rows], end - begin, least)):
                yield int(names[which]), entry, score
            begin = end

    def _wand(self, own: np.ndarray, term: np.ndarray, count: int, least: np.float32):
        """Hits of ``count`` passages, given as ascending (passage, term) rows.

        In the order of their lists' maxima, the terms of a passage ahead of its pivot
        cannot reach the threshold together; an entry that does is on a list from the
        pivot on. Of the blocks that such lists touch, those whose maxima over all lists
        stay under the threshold are skipped, and the rest are scored in full.
        """
        reach = np.cumsum(self.term_max[term], dtype=np.float64)
        first = np.searchsorted(own, np.arange(count))
        ahead = np.append(0.0, reach)[first]
        pivot = reach - ahead[own] >= least
        sizes = self.list_starts[term + 1] - self.list_starts[term]
        row, stretch = _spread(self.list_starts[term], sizes)
        cell = own[row] * self.blocks + self.stretch_block[stretch]
        touched = np.zeros(count * self.blocks, bool)
        touched[cell[pivot[row]]] = True
        bound = np.bincount(cell, self.stretch_max[stretch], count * self.blocks)
        alive = touched & (bound >= least)
        kept = alive[cell]
        cell, stretch = cell[kept], stretch[kept]
        sizes = self.stretch_ends[stretch + 1] - self.stretch_ends[stretch]
        row, place = _spread(self.stretch_ends[stretch], sizes)
        number = np.cumsum(alive) - 1
        key = number[cell[row]] * BLOCK + self.entry_of[place] % BLOCK
        scores = np.bincount(key, self.gain_of[place], int(alive.sum()) * BLOCK)
        hits = np.flatnonzero(scores >= least)
        found = np.flatnonzero(alive)[hits // BLOCK]
        entry = found % self.blocks * BLOCK + hits % BLOCK
        return (found // self.blocks).tolist(), entry.tolist(), scores[hits].tolist()


def _spread(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row as often as its size says, with the places from its start on."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[row]


def _indexes(benchmark: DataFrame, item_id: str, text: str) -> list:
    """Broadcast indexes of at most about :data:`MAX_ITEMS` items each.

    One is fetched and sent out at a time; the number of blocks, and so of passes
    over the documents, grows with the benchmark, the size of each does not.
    """
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(item_id).alias("i"), F.col(text).alias("t")).where("t is not null")
    entries = F.greatest(F.lit(1), F.length("t") / (4 * MAX_ENTRY_WORDS))
    total = items.agg(F.sum(entries).alias("n")).first()["n"] or 0
    blocks = max(1, -int(-total // MAX_ITEMS))
    dealt = items.withColumn("b", F.pmod(F.xxhash64("i", "t"), F.lit(blocks)))
    made = []
    for k in range(blocks):
        rows = dealt.where(F.col("b") == k).orderBy("i", "t").select("i", "t").collect()
        if rows:
            made.append(spark.sparkContext.broadcast(ItemIndex([(r.i, r.t) for r in rows])))
    return made


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    item_text: str = "text",
    min_score: float = MIN_SCORE,
) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds.

    Returns ``doc_id``, ``item_id``, ``score`` (BM25 as a share of the item's score
    for itself) and ``overlap`` (share of its five-word shingles or of its words in order
    in the passage, whichever is more), one row per document row and item; an item longer
    than 256 words is searched by parts of near-equal size, its score is that of the best
    part, and it is verified as a whole. Items of fewer than five words match nothing,
    those of five to seven only by their shingles. Words are compared in lower case, without
    punctuation. Null and empty texts and items match nothing; null ids come out as
    nulls; repeated rows come out as often as given; other columns are not used.
    """
    id_type = benchmark.schema[item_id].dataType
    schema = StructType(
        [
            StructField("doc_id", docs.schema[doc_id].dataType),
            StructField("item_id", id_type),
            StructField("score", DoubleType()),
            StructField("overlap", DoubleType()),
        ]
    )
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    arrow_type = to_arrow_type(id_type)

    def searched(index) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in (part for whole in batches for part in in_slices(whole, 1)):
                hits: dict[tuple[int, object], tuple[float, float]] = {}
                for i, item, *found in index.value.search(batch.column(1).to_pylist(), min_score):
                    key = i, index.value.items[item]
                    hits[key] = max(hits.get(key, (0.0, 0.0)), tuple(found))
                if not hits:
                    continue
                at = pa.array([i for i, _ in hits], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(at),
                        pa.array([item for _, item in hits], arrow_type),
                        pa.array([s for s, _ in hits.values()], pa.float64()),
                        pa.array([o for _, o in hits.values()], pa.float64()),
                    ],
                    ["doc_id", "item_id", "score", "overlap"],
                )

        return source.mapInArrow(run, schema)

    found = [searched(index) for index in _indexes(benchmark, item_id, item_text)]
    if not found:
        return docs.sparkSession.createDataFrame([], schema)
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionAll(more)
    return pairs


def without_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    min_score: float = MIN_SCORE,
) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; see :func:`find_leaks`."""
    flag = free_name(docs.columns, "leaked")
    for index in _indexes(benchmark, item_id, item_text):
        docs = docs.withColumn(flag, _leaked(index, min_score)(F.col(text)))
        docs = docs.where(~F.col(flag)).drop(flag)
    return docs


def _leaked(index, min_score: float):
    @F.arrow_udf(BooleanType())
    def run(texts: pa.Array) -> pa.Array:
        flags = []
        for part in in_slices(pa.RecordBatch.from_arrays([texts], ["text"]), 0):
            found = {i for i, *_ in index.value.search(part.column(0).to_pylist(), min_score)}
            flags.extend(i in found for i in range(part.num_rows))
        return pa.array(flags, pa.bool_())

    return run
