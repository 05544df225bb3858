"""Toxicity: a learned lexicon, searched with Levenshtein automata, and contexts.

Terms and word beginnings that mark toxic documents form a trie. The automaton that
accepts all words within the allowed edits of a term is intersected with the trie; its
sets of states are made once each, so a word costs a table look-up per character.
Each find is scored in its window: a quoted or reported term weighs less than one
thrown at somebody. Boosted trees turn the sums of a document into its score.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType

from . import trees

#: At most so many labelled documents are learned from: those with the lowest hashes.
MAX_LABELLED = 16_000
#: At most so many terms are kept: those with the largest evidence.
MAX_TERMS = 3_000
#: A term marks toxic documents if it is in so many of them, and that much (natural
#: logarithm of the ratio) more often than in others.
MIN_TOXIC_DOCS = 3
MIN_EVIDENCE = 1.5
#: Lengths of word beginnings that can be terms.
PREFIXES = (4, 5, 6, 7)
#: Terms of at least so many characters may be misspelled with 1 and with 2 edits.
ONE_EDIT, TWO_EDITS = 5, 9
#: Only terms of that evidence are searched with edits.
FUZZY_EVIDENCE = 3.0
WINDOW = 8
THRESHOLD = 0.7

FEATURES: dict[str, int] = {
    "exact_sum": 1,
    "fuzzy_sum": 1,
    "prefix_sum": 1,
    "best_window": 1,
    "strong_terms": 1,
    "density": 1,
    "log_words": 0,
}

_WORD = re.compile(r"\w(?:[\w@$*]*\w)?")
_JAVA_WORD = r"[\p{L}\p{N}_](?:[\p{L}\p{N}_@$*]*[\p{L}\p{N}_])?"
_OPEN, _CLOSE = "\"“„«‘", "\"”“»’"
_REPORTING = frozenset(
    "said says say called calls call word words term quote quoted wrote writes reported".split()
)
_ADDRESS = frozenset("you your youre u du dein ihr tu toi vous ton votre te usted eres tú".split())

#: (term, evidence); a term that ends with an asterisk is a word beginning.
Lexicon = list[tuple[str, float]]


class Automaton:
    """The trie of a lexicon and the automaton of its misspellings, made on demand."""

    MAX_STATES = 200_000

    def __init__(self, lexicon: Lexicon) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.word: list[float] = [0.0]  # evidence of the term that ends here
        self.prefix: list[float] = [0.0]
        self.edits: list[int] = [0]  # allowed for the term that ends here
        self.reach: list[int] = [0]  # most edits allowed for any term below
        for term, evidence in lexicon:
            stem = term.removesuffix("*")
            edits = 0
            if stem == term and evidence >= FUZZY_EVIDENCE:
                edits = (len(stem) >= ONE_EDIT) + (len(stem) >= TWO_EDITS)
            node = 0
            self.reach[0] = max(self.reach[0], edits)
            for c in stem:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    for values in (self.word, self.prefix, self.edits, self.reach):
                        values.append(0)
                node = self.children[node][c]
                self.reach[node] = max(self.reach[node], edits)
            if stem == term:
                self.word[node] = max(self.word[node], evidence)
                self.edits[node] = max(self.edits[node], edits)
            else:
                self.prefix[node] = max(self.prefix[node], evidence)
        self.start = self._closed({0: 0})
        self._reset()

    def _reset(self) -> None:
        self.steps: dict[tuple[int, str], int] = {}
        self.number: dict[frozenset, int] = {}
        self.sets: list[dict[int, int]] = []
        self.found: list[tuple[float, float, float]] = []  # exact, fuzzy, prefix
        self.first = self._state(self.start)

    def _closed(self, nodes: dict[int, int]) -> dict[int, int]:
        """Add the nodes reached by leaving out letters of terms."""
        queue = list(nodes.items())
        while queue:
            node, e = queue.pop()
            if nodes[node] < e:
                continue
            for child in self.children[node].values():
                if e + 1 <= self.reach[child] and nodes.get(child, 9) > e + 1:
                    nodes[child] = e + 1
                    queue.append((child, e + 1))
        return nodes

    def _state(self, nodes: dict[int, int]) -> int:
        key = frozenset(nodes.items())
        if key not in self.number:
            self.number[key] = len(self.sets)
            self.sets.append(nodes)
            exact = max((self.word[n] for n, e in nodes.items() if e == 0), default=0.0)
            fuzzy = max(
                (self.word[n] for n, e in nodes.items() if 0 < e <= self.edits[n]), default=0.0
            )
            prefix = max((self.prefix[n] for n, e in nodes.items() if e == 0), default=0.0)
            self.found.append((exact, fuzzy, prefix))
        return self.number[key]

    def _step(self, state: int, c: str) -> int:
        """The state after one more character; -1 if no term is in reach."""
        after: dict[int, int] = {}

        def put(node: int, e: int) -> None:
            if e <= self.reach[node] or e == 0:
                after[node] = min(after.get(node, 9), e)

        for node, e in self.sets[state].items():
            put(node, e + 1)  # a letter too many
            for letter, child in self.children[node].items():
                put(child, e if letter == c else e + 1)
        after = {n: e for n, e in after.items() if e <= self.reach[n] or e == 0}
        next_state = self._state(self._closed(after)) if after else -1
        self.steps[state, c] = next_state
        return next_state

    def match(self, word: str) -> tuple[float, float, float]:
        """Evidence of the best exact term, misspelled term and beginning of ``word``."""
        if len(self.sets) > self.MAX_STATES:
            self._reset()
        state, steps, prefix = self.first, self.steps, 0.0
        for c in word:
            next_state = steps.get((state, c))
            if next_state is None:
                next_state = self._step(state, c)
            if next_state < 0:
                return 0.0, 0.0, prefix
            state = next_state
            prefix = max(prefix, self.found[state][2])
        exact, fuzzy, _ = self.found[state]
        return exact, (0.0 if exact else fuzzy), prefix


class Scorer:
    """Features of texts: what a lexicon finds, weighed by context."""

    MAX_WORDS = 300_000

    def __init__(self, lexicon: Lexicon) -> None:
        self.automaton = Automaton(lexicon)
        self.seen: dict[str, tuple[float, float, float] | None] = {}

    def _find(self, word: str) -> tuple[float, float, float] | None:
        found = self.automaton.match(word)
        value = found if any(found) else None
        if len(self.seen) >= self.MAX_WORDS:
            self.seen.clear()
        self.seen[word] = value
        return value

    def features(self, text: str | None) -> list[float]:
        """Values of :data:`FEATURES`; zeros for a text without words."""
        low = (text or "").lower()
        words = _WORD.findall(low)
        seen, finds = self.seen, {}
        for word in set(words):
            value = seen[word] if word in seen else self._find(word)
            if value is not None:
                finds[word] = value
        if not finds:
            return [0.0] * (len(FEATURES) - 1) + [float(np.log1p(len(words)))]
        sums, scored, best = [0.0, 0.0, 0.0], [], 0.0
        for at, match in enumerate(_WORD.finditer(low)):
            value = finds.get(match[0])
            if value is None:
                continue
            weight = self._context(low, match, words[max(0, at - WINDOW) : at + WINDOW + 1])
            kind = 0 if value[0] else 1 if value[1] else 2
            score = weight * max(value)
            sums[kind] += score
            scored.append((at, score))
        ahead = 0.0
        first = 0
        for at, score in scored:
            ahead += score
            while scored[first][0] < at - WINDOW:
                ahead -= scored[first][1]
                first += 1
            best = max(best, ahead)
        strong = sum(max(v) >= FUZZY_EVIDENCE for v in finds.values())
        return [*sums, best, strong, 100 * sum(sums) / len(words), float(np.log1p(len(words)))]

    @staticmethod
    def _context(low: str, match: re.Match, window: list[str]) -> float:
        """How much a find counts: less in quotation marks and beside a reporting
        word, more beside a word that addresses somebody."""
        before, after = low[max(0, match.start() - 1) : match.start()], low[match.end() : match.end() + 1]
        line = low.rfind("\n", 0, match.start()) + 1
        quoted = bool(before and after and before in _OPEN and after in _CLOSE)
        if not quoted:
            inside = low[max(line, match.start() - 200) : match.start()].count('"') % 2 == 1
            quoted = inside and '"' in low[match.end() : match.end() + 200].split("\n", 1)[0]
        weight = 0.3 if quoted else 1.0
        if not _REPORTING.isdisjoint(window):
            weight *= 0.6
        if not _ADDRESS.isdisjoint(window):
            weight *= 1.3
        return weight


class Model:
    def __init__(self, lexicon: Lexicon, forest: trees.Forest) -> None:
        self.lexicon, self.forest = lexicon, forest
        self._scorer: Scorer | None = None

    def __getstate__(self):
        return {"lexicon": self.lexicon, "forest": self.forest, "_scorer": None}

    @property
    def scorer(self) -> Scorer:
        if self._scorer is None:
            self._scorer = Scorer(self.lexicon)
        return self._scorer

    def features(self, texts: Iterable[str | None]) -> np.ndarray:
        return np.array([self.scorer.features(t) for t in texts], float).reshape(-1, len(FEATURES))

    def score(self, texts: Iterable[str | None]) -> np.ndarray:
        return self.forest.score(self.features(texts))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    label: str = "toxic",
    max_labelled: int = MAX_LABELLED,
) -> Model:
    """Learn a lexicon and a forest from labelled documents (1 toxic, 0 not).

    At most ``max_labelled`` labels are used, those with the lowest hash of their id.
    Two thirds of their documents give the lexicon, by counts that Spark makes; all
    others fit the trees, so that terms are weighed on texts they were not chosen on.
    Labels that are null, contradictory or without a document are left out. With no
    toxic label every text gets the same low score. Hand in only the labels that may
    be learned from.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("__id"))
        .agg(F.min(label).alias("__y"), F.max(label).alias("__high"))
        .where(F.col("__y") == F.col("__high"))
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(max_labelled)
        .select("__id", "__y")
    )
    # The chosen labels are at most max_labelled pairs of numbers, and each has one row
    # however often its document comes.
    texts = (
        docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text"))
        .join(F.broadcast(known), "__id")
        .groupBy("__id", "__y")
        .agg(F.min("__text").alias("__text"))
    )
    for_terms = F.pmod(F.xxhash64(F.lit("terms"), "__id"), F.lit(3)) < 2
    lexicon = _lexicon(texts.where(for_terms))
    model = Model(lexicon, trees.constant(0.0))
    features = _features(model)
    table = texts.where(~for_terms).select("__id", "__y", features(F.col("__text")).alias("f")).toPandas()
    table = table.sort_values("__id", kind="stable")
    x = np.array(table["f"].tolist(), float).reshape(-1, len(FEATURES))
    y = table["__y"].to_numpy(float)
    if len(y) and y.max() == 0:
        return Model(lexicon, trees.constant(0.01))
    forest = trees.fit(x, y, np.array(list(FEATURES.values())), trees=60, depth=3, rate=0.2)
    return Model(lexicon, forest)


def _lexicon(texts: DataFrame) -> Lexicon:
    words = texts.select(
        "__y", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("__text"), F.lit(_JAVA_WORD), F.lit(0)))).alias("w"), "__id"
    )
    totals = texts.agg(F.sum("__y").alias("bad"), F.count("*").alias("n")).first()
    bad, good = float(totals["bad"] or 0), float((totals["n"] or 0) - (totals["bad"] or 0))
    if not bad:
        return []
    terms = words.select(
        "__y",
        F.explode(
            F.array(
                F.col("w"),
                *[
                    F.when(F.length("w") > n, F.concat(F.substring("w", 1, n), F.lit("*")))
                    for n in PREFIXES
                ],
            )
        ).alias("term"),
        "__id",
    ).where("term is not null")
    # A beginning may stand in several words of a document, and then counts once.
    counted = (
        terms.distinct()
        .groupBy("term")
        .agg(F.sum("__y").alias("in_bad"), F.sum(1 - F.col("__y")).alias("in_good"))
    )
    evidence = F.log((F.col("in_bad") + 0.5) / (bad + 1)) - F.log((F.col("in_good") + 0.5) / (good + 1))
    best = (
        counted.where(F.col("in_bad") >= MIN_TOXIC_DOCS)
        .withColumn("evidence", evidence)
        .where(F.col("evidence") >= MIN_EVIDENCE)
        .orderBy((F.col("evidence") * F.sqrt("in_bad")).desc(), "term")
        .limit(MAX_TERMS)
    )
    return [(r.term, float(r.evidence)) for r in best.collect()]


def _features(model: Model):
    @F.pandas_udf("array<double>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(list(model.features(texts)), dtype=object)

    return run


def score(text: Column, model: Model) -> Column:
    """Score of a text from 0 to 1; null and empty texts get that of no finds."""
    shared = model

    @F.pandas_udf(DoubleType())
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.score(texts), dtype=float)

    return run(text)
