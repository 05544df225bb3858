"""Quality rules: fixed limits on document statistics, then boosted trees on them.

One pass over the texts yields the statistics; a forest fitted to labelled documents
scores them in numpy, batch by batch.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from . import trees
from .common import BLANKS

#: At most so many labelled documents are fitted to: those with the lowest hashes.
MAX_LABELLED = 20_000
#: A document is kept if the forest gives it at least this chance to be good.
MIN_SCORE = 0.5

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

#: Statistics of a text; the first five are counts, the others shares or means.
#: The sign says how a score may move as the statistic grows: -1 never up.
FEATURES: dict[str, int] = {
    "n_words": 0,
    "word_chars": 0,
    "n_symbols": 0,
    "n_dup_lines": 0,
    "n_repeat_words": 0,
    "symbols_per_word": -1,
    "repeat_share": -1,
    "dup_line_share": -1,
    "mean_word_chars": 0,
    "mean_line_words": 0,
    "upper_share": -1,
    "digit_share": -1,
    "distinct_share": 0,
    "top_word_share": -1,
    "end_mark_share": 0,
    "short_line_share": 0,
    "bar_share": -1,
    "bang_share": -1,
    "replacement_share": -1,
}
COUNTS = list(FEATURES)[:5]

_SYMBOLS = b"#*$%&|<>"
_BLANK_BYTES = BLANKS.encode()
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGITS = b"0123456789"


def _repeated(words: list[bytes]) -> int:
    """Words that lie in a window of five words found at least twice."""
    windows = list(zip(*(words[k:] for k in range(WINDOW))))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    hit = np.fromiter((counts[w] > 1 for w in windows), bool, len(windows))
    edge = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(hit)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    return int((np.cumsum(edge) > 0).sum())


def statistics(text: str | None) -> list[float]:
    """Values of :data:`FEATURES` for one whole text; null counts as empty."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()  # bytes are split at ASCII white space only
    n = len(words)
    gone = len(data) - len(data.translate(None, _BLANK_BYTES))
    word_chars = len(text or "") - gone
    symbols = len(data) - len(data.translate(None, _SYMBOLS))
    lines = [x for x in data.split(b"\n") if x.strip(_BLANK_BYTES)]
    dup_lines = len(lines) - len(set(lines))
    repeats = _repeated(words)
    some, letters, n_lines = max(n, 1), max(word_chars, 1), max(len(lines), 1)
    counts = Counter(words)
    ends = data.count(b".") + data.count(b"?")
    return [
        n, word_chars, symbols, dup_lines, repeats,
        symbols / some,
        repeats / some,
        dup_lines / n_lines,
        word_chars / some,
        n / n_lines,
        (len(data) - len(data.translate(None, _UPPER))) / letters,
        (len(data) - len(data.translate(None, _DIGITS))) / letters,
        len(counts) / some,
        max(counts.values(), default=0) / some,
        ends / some,
        sum(len(x) < 20 for x in lines) / n_lines,
        data.count(b"|") / some,
        data.count(b"!") / some,
        data.count(b"\xef\xbf\xbd") / letters,
    ]


_STATS = StructType([StructField(name, DoubleType()) for name in FEATURES])


def document_statistics(text: Column) -> Column:
    """Struct of :data:`FEATURES` of a text."""

    @F.pandas_udf(_STATS)
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = [statistics(t) for t in texts]
        return pd.DataFrame(np.array(rows, float).reshape(-1, len(FEATURES)), columns=list(FEATURES))

    return run(text)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    label: str = "quality",
    max_labelled: int = MAX_LABELLED,
) -> trees.Forest:
    """Fit the forest to labelled documents (1 good, 0 bad).

    At most ``max_labelled`` labels are used, those with the lowest hash of their
    document's id, so the choice does not depend on the order of rows. Labels that
    are null, or neither 0 nor 1, or without a document, are left out; repeated
    labels of one document count once if they agree, and not at all if they do not.
    The statistics are computed by Spark; only they and the labels reach the driver.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("__id"))
        .agg(F.min(label).alias("__low"), F.max(label).alias("__high"))
        .where(F.col("__low") == F.col("__high"))
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(max_labelled)
        .select("__id", F.col("__low").alias("__y"))
    )
    texts = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text"))
    # The chosen labels are at most max_labelled pairs of numbers, and each has one row
    # however often its document comes.
    table = (
        texts.join(F.broadcast(known), "__id")
        .select("__id", "__y", document_statistics(F.col("__text")).alias("s"))
        .groupBy("__id", "__y")
        .agg(F.min("s").alias("s"))
        .select("__id", "__y", "s.*")
        .toPandas()
    )
    table = table.sort_values("__id", kind="stable")
    x = table[list(FEATURES)].to_numpy(float)
    return trees.fit(x, table["__y"].to_numpy(float), np.array(list(FEATURES.values())))


def judge(
    docs: DataFrame,
    forest: trees.Forest,
    text: str = "text",
    out: str = "quality",
    min_score: float = MIN_SCORE,
    keep: Sequence[str] = COUNTS,
) -> DataFrame:
    """Add a struct ``out``: the counts, ``base_failed``, ``score`` and ``kept``.

    ``base_failed``: fewer than ten words, or over a fifth of the words in repeated
    five-word windows. ``kept`` is false for those, and for a score below
    ``min_score``. Null and empty texts have no words and fail. A column called
    ``out`` is replaced; all others are kept, and every row comes out once.
    """
    fields = [StructField(name, DoubleType()) for name in keep]
    schema = StructType([*fields, StructField("score", DoubleType())])
    at = [list(FEATURES).index(name) for name in keep]

    @F.pandas_udf(schema)
    def run(texts: pd.Series) -> pd.DataFrame:
        x = np.array([statistics(t) for t in texts], float).reshape(-1, len(FEATURES))
        made = pd.DataFrame(x[:, at], columns=list(keep))
        made["score"] = forest.score(x)
        return made

    made = docs.withColumn(out, run(F.col(text)))
    s = F.col(out)
    failed = (s["n_words"] < MIN_WORDS) | (
        100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"]
    )
    return made.withColumn(
        out,
        F.struct(
            *[s[name].cast("long").alias(name) for name in keep],
            failed.alias("base_failed"),
            s["score"].alias("score"),
            (~failed & (s["score"] >= min_score)).alias("kept"),
        ),
    )
