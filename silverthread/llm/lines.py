"""Line dedup: drop every line that many documents share.

Lines are keyed by their trimmed, lower-cased form; the hashes of all keys are
counted over distinct documents, and the frequent ones lose all their lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import BLANKS, ascii_lower, content_id, free_name

#: Lines of one key are dealt to so many tasks when they meet the frequent keys.
SALTS = 8


def line_key(line: Column) -> Column:
    """The line without ASCII white space at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def drop_frequent_lines(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    min_docs: int = 10,
    min_chars: int = 1,
    n_lines: str = "n_lines",
    n_dropped: str = "n_dropped",
) -> DataFrame:
    """Return ``docs`` with the kept lines as ``text``, and two counts per row.

    A key of at least ``min_chars`` characters found in at least ``min_docs``
    documents loses all its lines. Documents are told apart by ``doc_id``; rows
    without one count as one document per text. Every row comes out once, repeated
    rows as often as given. Null and empty texts are one empty line and come out
    empty. A text of which nothing is kept comes out empty. Columns called like
    the counts are replaced; all others are kept.

    Only 16-byte hashes of the keys and positions are shuffled, first partly
    counted; the texts move once, to meet the positions of their dropped lines.
    Keys are dealt by hash and salt, so that a line in every third document is
    spread over several tasks, which adaptive execution can split further.
    """
    row = content_id(F.col(doc_id), F.col(text))
    occurrences = (
        docs.select(
            F.col(doc_id).alias("__doc"),
            row.alias("__row"),
            F.posexplode(_lines(F.col(text))).alias("__at", "__line"),
        )
        .withColumn("__key", line_key(F.col("__line")))
        .where(F.length("__key") >= max(min_chars, 1))
        .select(
            "__doc",
            "__row",
            "__at",
            F.xxhash64("__key").alias("__h1"),
            F.xxhash64(F.lit("second"), "__key").alias("__h2"),
        )
    )
    who = F.when(F.col("__doc").isNull(), F.col("__row")).otherwise(F.xxhash64("__doc"))
    frequent = (
        occurrences.groupBy("__h1", "__h2")
        .agg(F.count_distinct(who).alias("__docs"))
        .where(F.col("__docs") >= min_docs)
        .select("__h1", "__h2", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt"))
    )
    dropped = (
        occurrences.withColumn("__salt", F.pmod(F.col("__row"), F.lit(SALTS)).cast("int"))
        .join(frequent, ["__h1", "__h2", "__salt"])
        .groupBy("__doc", "__row")
        .agg(F.sort_array(F.collect_set("__at")).alias("__dropped"))
    )
    # No column of the caller's is taken for one of these, whatever its name.
    own, doc, other, gone, every, cuts = (
        free_name([*docs.columns, n_lines, n_dropped], n)
        for n in ("__own", "__doc", "__row", "__dropped", "__all", "__cuts")
    )
    marked = docs.withColumn(own, row)
    dropped = dropped.toDF(doc, other, gone)
    joined = marked.join(
        dropped, marked[own].eqNullSafe(dropped[other]) & marked[doc_id].eqNullSafe(dropped[doc]), "left"
    )
    lines = _lines(F.col(text))
    # The kept lines are the stretches between the dropped ones.
    kept = F.expr(
        f"array_join(flatten(transform(sequence(0, size({gone})), i -> slice({every},"
        f" {cuts}[i] + 2, {cuts}[i + 1] - {cuts}[i] - 1))), '\\n')"
    )
    return (
        joined.withColumn(every, lines)
        .withColumn(cuts, F.concat(F.array(F.lit(-1)), F.col(gone), F.array(F.size(every))))
        .withColumn(
            text, F.when(F.col(gone).isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(kept)
        )
        .withColumn(n_lines, F.size(every).cast("long"))
        .withColumn(n_dropped, F.coalesce(F.size(gone), F.lit(0)).cast("long"))
        .drop(doc, other, own, gone, every, cuts)
    )
