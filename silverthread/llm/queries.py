"""The corpus operators as queries over the driver's test tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from silverthread import session

from . import bpe, counts, idfiles, leaks, licenses, lines, near, pii, quality, search, simhash, toxicity, vectors
from .common import stage, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

ORACLES: dict[str, str] = {}

BPE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1


def query(function: Query) -> Query:
    """Register a query under its function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(session.tune(spark), sf_dir)

    QUERIES[function.__name__] = run
    return run


@query
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_personal_data(docs)
    everything = F.sort_array(F.concat("base", "added"))
    return found.select(
        "doc_id",
        *[pii.count(F.col("base"), kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(pii.describe(F.col("base")), 256).alias("base_sha256"),
        pii.describe(everything).alias("spans"),
        pii.count(F.col("added"), "secret").alias("n_secret"),
        F.size("added").cast("long").alias("n_added"),
        F.size(everything).cast("long").alias("n_spans"),
    )


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = lines.drop_frequent_lines(docs, min_docs=10, min_chars=1)
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256")
    )


@query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pattern = public_tokenizers.PATTERN
    coded = docs.select("doc_id", bpe.round_trip(F.col("text"), BPE_RANKS, pattern).alias("c"))
    return coded.select(
        "doc_id",
        (F.length("c.ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("c.ids", 256).alias("ids_sha256"),
        F.sha2("c.decoded", 256).alias("decoded_sha256"),
    )


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scan_licenses(docs, licenses.known_licenses(spark))
    return found.select(
        "doc_id", "license", F.array_join("licenses", ",").alias("licenses"), F.array_join("full", ",").alias("full")
    )


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return leaks.find_leaks(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each text with three edits: its source is inserted after the first quarter, the
    middle 40 characters go, and its language takes the place of the 20 characters
    before the end.

    A first pass stores every document with its tree; a second reads them, and encodes
    only what the edits touch."""
    ranks, pattern = BPE_RANKS, public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    stored = stage(docs.withColumn("tree", counts.tree(F.col("text"), ranks, pattern)), "token_trees")
    size = F.coalesce(F.length("text"), F.lit(0))
    half = F.floor(size / 2).cast("int")
    edit = lambda start, end, new: F.struct(
        start.alias("start"), end.alias("end"), new.alias("replacement")
    )
    edits = F.array(
        edit(F.floor(size / 4).cast("int"), F.floor(size / 4).cast("int"), F.concat(F.lit(" "), "source", F.lit(": "))),
        edit(half, half + 40, F.lit("")),
        edit(F.greatest(size - 20, half + 40), size, F.concat(F.lit("\n["), "lang", F.lit("]"))),
    )
    edited = counts.edit_stored(F.col("text"), F.col("tree"), edits, ranks, pattern)
    counted = stored.select("doc_id", edited.alias("c"))
    return counted.select("doc_id", *[f"c.{n}" for n in ("n_tokens", "n_tokens_edited", "n_pretokens", "n_reencoded")])


@query
def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near.classes(docs).select("doc_id", "class_id")


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels.where(~held_out))
    return docs.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        toxicity.score(F.col("text"), model).alias("score"),
    ).withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


@query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = session.scratch_path(spark, "token_ids")
    idfiles.write_ids(docs, path, WORD_BPE, END_ID)
    return idfiles.read_ids(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    forest = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, forest, out="q").select(
        "doc_id", *[f"q.{name}" for name in quality.COUNTS], "q.base_failed", "q.kept", "q.score"
    )


@query
def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, and how many other documents
    lie within the radius; see :mod:`.simhash`."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = stage(simhash.fingerprint_edits(docs), "simhash_rows")
    return simhash.with_near(made)


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item; see :mod:`.search`."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return search.best_documents(docs, items)


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors with their errors; see :mod:`.vectors`."""
    made = vectors.compress(table(spark, sf_dir, "embeddings"))
    return made.rows.select(
        "vec_id", "code", "error", "label_error",
        F.lit(vectors.digest(made.codebooks)).alias("codebooks_sha256"),
    )


#: The trimmed key of a line in DuckDB; A-Z only in lower case.
_KEY = (
    "translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),"
    " 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

#: The lines of a table ``{docs}`` and those that stay, for one query or one stage.
LINES_SQL = f"""
all_lines AS (
  SELECT doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos,
    unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM {{docs}}),
keyed AS (SELECT doc_id, pos, line, {_KEY} AS key FROM all_lines),
frequent AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT k.*, f.key IS NOT NULL AS gone FROM keyed k LEFT JOIN frequent f USING (key)),
deduped AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text
  FROM marked GROUP BY doc_id)"""

ORACLES["op2_line_dedup"] = f"""
WITH {LINES_SQL.format(docs="documents")}
SELECT doc_id, n_lines, n_dropped, sha256(text) AS kept_sha256 FROM deduped"""

ORACLES["op12_ranked_search"] = r"""
WITH split AS MATERIALIZED (
  SELECT row_number() OVER () AS row_id, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
docs AS MATERIALIZED (SELECT row_id, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM split WHERE len(terms) > 0),
corpus AS MATERIALIZED (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM docs),
tf AS MATERIALIZED (
  SELECT row_id, term, CAST(count(*) AS BIGINT) AS tf
  FROM (SELECT row_id, unnest(terms) AS term FROM docs) GROUP BY row_id, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
wanted AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
items AS (SELECT item_id, term, CAST(count(*) AS BIGINT) AS times FROM wanted GROUP BY item_id, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM df, corpus),
scored AS (
  SELECT i.item_id, d.row_id, d.doc_id,
    sum(i.times * w.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (100 - 75 + (75 * d.n * c.n_docs) // c.n_terms)))) AS score
  FROM items i JOIN weights w USING (term) JOIN tf t USING (term) JOIN docs d USING (row_id), corpus c
  GROUP BY i.item_id, d.row_id, d.doc_id),
ranked AS (
  SELECT item_id, doc_id, score,
    row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 10"""


def _nearest_sql(books: str) -> str:
    """Each part with the nearest entry of a codebook table (p, e, x1..x4)."""
    square = " + ".join(f"(v.x{k} - b.x{k}) * (v.x{k} - b.x{k})" for k in range(1, 5))
    return f"""
  SELECT v.p, v.vec_id, any_value(v.x1) AS x1, any_value(v.x2) AS x2, any_value(v.x3) AS x3, any_value(v.x4) AS x4,
    min(({square}) * 64 + b.e) AS best
  FROM parts v JOIN {books} b USING (p) GROUP BY v.p, v.vec_id"""


def _moved_sql(books: str, chosen: str) -> str:
    """That codebook with every used entry at the floor of the mean of its parts."""
    means = ", ".join(f"CAST(floor(CAST(sum(x{k}) AS DOUBLE) / count(*)) AS BIGINT) AS m{k}" for k in range(1, 5))
    taken = ", ".join(f"coalesce(m{k}, b.x{k}) AS x{k}" for k in range(1, 5))
    return f"""
  SELECT b.p, b.e, {taken} FROM {books} b LEFT JOIN (
    SELECT p, best % 64 AS e, {means} FROM {chosen} GROUP BY p, best % 64) m ON m.p = b.p AND m.e = b.e"""


#: For vectors of 64 dimensions and distinct ids, as the test tables have them.
ORACLES["op13_vector_codes"] = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT p, vec_id, v[4 * p + 1] AS x1, v[4 * p + 2] AS x2, v[4 * p + 3] AS x3, v[4 * p + 4] AS x4
  FROM kept, (SELECT unnest(range(16)) AS p)),
books0 AS MATERIALIZED (
  SELECT p, e, x1, x2, x3, x4 FROM (
    SELECT *, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM parts) WHERE e < 64),
chosen0 AS MATERIALIZED ({_nearest_sql("books0")}),
books1 AS MATERIALIZED ({_moved_sql("books0", "chosen0")}),
chosen1 AS MATERIALIZED ({_nearest_sql("books1")}),
books2 AS MATERIALIZED ({_moved_sql("books1", "chosen1")}),
chosen2 AS MATERIALIZED ({_nearest_sql("books2")}),
coded AS (
  SELECT vec_id, string_agg(printf('%02x', best % 64), '' ORDER BY p) AS code, CAST(sum(best // 64) AS BIGINT) AS error
  FROM chosen2 GROUP BY vec_id),
errors AS (SELECT vec_id, label, code, error FROM coded JOIN kept USING (vec_id)),
totals AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM errors GROUP BY label),
books AS (SELECT sha256(string_agg(concat_ws(',', x1, x2, x3, x4), ',' ORDER BY p, e)) AS codebooks_sha256 FROM books2)
SELECT e.vec_id, e.code, e.error, t.label_error, b.codebooks_sha256
FROM errors e JOIN totals t ON e.label IS NOT DISTINCT FROM t.label, books b"""
