"""What events carry that no domain reads: a census of payload paths."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sinks import stage
from .events import DOMAINS, Domain

#: Levels of a payload that are told apart; what lies deeper counts as its parent.
DEPTH = 8


def _kind(value: Column) -> Column:
    """The type of a variant, of objects and arrays the outermost only."""
    return F.lower(F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0))


def payload_paths(docs: DataFrame, scratch: str, text: str = "doc", depth: int = DEPTH) -> DataFrame:
    """``event_category``, ``schema_version``, ``path``, ``kind`` and how often it occurs
    (``occurrences``), for every path of the payloads.

    Each document is parsed once, into a variant, and taken apart level by level, each
    written once below the folder ``scratch``, until nothing is nested; a path ends in
    ``[]`` for the elements of an array. What is counted is shuffled as one row per path
    and task. Documents that are no JSON, and events without a payload, have no
    paths; elements of an array count each.
    """
    spark = docs.sparkSession
    named, nested = ["event_category", "schema_version"], F.col("kind").isin("object", "array")
    level = docs.select(F.try_parse_json(F.col(text)).alias("v")).select(
        F.try_variant_get("v", "$.event_category", "string").alias("event_category"),
        F.try_variant_get("v", "$.schema_version", "string").alias("schema_version"),
        F.lit("").alias("path"),
        F.try_variant_get("v", "$.payload", "variant").alias("value"),
    )
    level = level.where("value IS NOT NULL")
    levels = []
    for number in range(depth):
        # Written, so that no level is made again for those below it; the last column
        # holds only what there is still to take apart.
        inner = _inner(spark, level).withColumn("kind", _kind(F.col("value")))
        inner = inner.withColumn("value", F.when(nested, F.col("value")))
        inner, found = stage(inner, f"{scratch}/level_{number}", nested=F.count_if(nested))
        levels.append(inner.drop("value"))
        if not found["nested"]:
            break
        level = inner.where(nested)
    every = reduce(lambda a, b: a.unionAll(b), levels)
    return every.groupBy(*named, "path", "kind").agg(F.count(F.lit(1)).alias("occurrences"))


def _inner(spark: SparkSession, level: DataFrame) -> DataFrame:
    """The members of all objects, and elements of all arrays, of a level."""
    found = level.lateralJoin(spark.tvf.variant_explode(F.col("value").outer()).toDF("pos", "key", "member"))
    step = F.when(F.col("key").isNull(), F.lit("[]")).otherwise(
        F.concat(F.when(F.col("path") == "", F.lit("")).otherwise(F.lit(".")), "key")
    )
    return found.select(
        "event_category", "schema_version",
        F.concat("path", step).alias("path"), F.col("member").alias("value"),
    )


def known_paths(domains: Sequence[Domain] = DOMAINS) -> list[tuple[str, str, str]]:
    """(category, version, path) that the domains read, with all that lies above."""
    found = set()
    for domain in domains:
        for version, paths in domain.shapes.items():
            for path in paths.values():
                parts = path.removesuffix("[]").split(".")
                found |= {(domain.category, version, ".".join(parts[: n + 1])) for n in range(len(parts))}
                if path.endswith("[]"):
                    found.add((domain.category, version, path))
    return sorted(found)


def unknown_paths(
    docs: DataFrame, scratch: str, text: str = "doc", domains: Sequence[Domain] = DOMAINS
) -> DataFrame:
    """The rows of :func:`payload_paths` that no domain reads: fields that producers have
    added, renamed or moved, by category and version."""
    keys = ["event_category", "schema_version", "path"]
    known = docs.sparkSession.createDataFrame(known_paths(domains), ", ".join(f"{k} string" for k in keys))
    return payload_paths(docs, scratch, text).join(known, keys, "left_anti")
