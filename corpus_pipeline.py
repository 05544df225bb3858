"""From raw documents to token-ready ones, stage by stage.

Each stage reads what its predecessor has written and returns the columns of
``documents``; only the last adds the token ids. Decisions take effect: rejected
documents, frequent lines, near copies and leaked benchmark items are gone for all
stages that follow.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from silverthread import session, sinks
from silverthread.llm import bpe, leaks, lines, near, quality
from silverthread.llm.common import content_id, free_name, table
from silverthread.llm.queries import BPE_RANKS


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that pass the limits and the boosted trees."""
    session.tune(spark)
    forest = quality.fit(docs, table(spark, sf_dir, "labels"))
    verdict = free_name(docs.columns, "verdict")
    judged = quality.judge(docs, forest, out=verdict)
    return judged.where(F.col(verdict)["kept"]).drop(verdict)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines of at least ten documents; documents left without text stay."""
    session.tune(spark)
    counts = [free_name(docs.columns, name) for name in ("n_lines", "n_dropped")]
    kept = lines.drop_frequent_lines(docs, n_lines=counts[0], n_dropped=counts[1])
    return kept.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class: that of the smallest id, and of rows with that
    id the one of the lowest content hash; of repeated rows one."""
    session.tune(spark)
    classes = near.classes(docs.select("doc_id", "text"))
    first = (
        classes.groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"))
        .select(F.col("first.doc_id").alias("first_id"), F.col("first.row").alias("first_row"))
    )
    names = [free_name(docs.columns, name) for name in ("own_row", "first_id", "first_row")]
    first = first.toDF(*names[1:])
    rows = docs.withColumn(names[0], content_id(F.col("doc_id"), F.col("text")))
    same = (rows[names[0]] == first[names[2]]) & rows["doc_id"].eqNullSafe(first[names[1]])
    kept = rows.join(first, same, "left_semi")
    return kept.dropDuplicates(["doc_id", names[0]]).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    session.tune(spark)
    return leaks.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode the texts, decode the ids, and keep what comes back whole.

    Adds ``n_tokens``, ``ids`` (little-endian unsigned 32-bit integers) and
    ``round_trip``; a column of such a name moves aside to ``name_1``.
    """
    session.tune(spark)
    pattern = public_tokenizers.PATTERN
    held = {c: free_name([*docs.columns, "n_tokens", "ids", "round_trip"], c) for c in docs.columns if c.lower() in ("n_tokens", "ids", "round_trip")}
    renamed = docs.withColumnsRenamed(held)
    made = free_name([*renamed.columns, "n_tokens", "ids", "round_trip"], "made")
    coded = renamed.withColumn(made, bpe.round_trip(F.col("text"), BPE_RANKS, pattern))
    ids, decoded = F.col(made)["ids"], F.col(made)["decoded"]
    whole = decoded == F.encode(F.coalesce(F.col("text"), F.lit("")), "utf-8")
    return coded.select(
        *renamed.columns, ids.alias("ids"), (F.length(ids) / 4).cast("long").alias("n_tokens"),
        whole.alias("round_trip"),
    )


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("byte-level BPE", byte_bpe),
]

#: Trees and signatures have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each is a written table before the next."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        path = session.scratch_path(spark, f"stage_{number}")
        docs, _ = sinks.stage(made, path)
    return docs
