"""Document fingerprints: SimHash over weighted words and pairs of words.

Every term's 128-bit hash votes with the term's weight on each bit of its document's
fingerprint. Fingerprints within a Hamming radius are found by tables in which the bits
are permuted so that some blocks stand first: with one block more than the radius, two
fingerprints that close agree in a whole block, and meet in its table.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from silverthread.operators.joins import hot_key_join

from .common import content_id, in_slices, stage

BITS = 128
#: Bits in which near fingerprints differ at most, and blocks that they agree in at least.
RADIUS, AGREE = 4, 1
#: Fingerprints of one block's value that are compared with each other at a time.
TILE = 1024
#: The rows of a hot block meet its count in so many tasks.
SALTS = 8
#: Keys sampled per bucket to cut the documents in order into buckets.
SAMPLED = 20

_WORD = re.compile(r"\w+")
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Votes of the eight bits of each byte, the highest bit first.
_VOTES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1) * 2.0 - 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    """64-bit hashes of words; starts anew when it is full."""

    def __missing__(self, word: str) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= 200_000:
            self.clear()
        if len(word) <= 64:
            self[word] = value
        return value


_hashes = _WordHashes()


def weighted_terms(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and weights of a text's words and pairs of words, in lower case.

    A term that stands n times weighs floor(16 + 16 ln n): whole numbers, so that votes
    add up the same in any order. A text of other characters only is one term, an
    empty one has none.
    """
    split = _WORD.findall(text.lower())
    if not split and text:
        return np.array([xxhash.xxh3_64_intdigest(text)], np.uint64), np.array([16.0])
    words = np.fromiter(map(_hashes.__getitem__, split), np.uint64, len(split))
    pairs = _mix(words[:-1] + _GOLDEN) + words[1:]
    found, counts = np.unique(np.concatenate([_mix(words), _mix(pairs)]), return_counts=True)
    return found, np.floor(16 + 16 * np.log(counts))


def fingerprints(texts: Sequence[str]) -> np.ndarray:
    """Fingerprints as rows of 16 bytes; a bit is 1 if its votes are above 0."""
    with np.errstate(over="ignore"):
        made = [weighted_terms(t) for t in texts]
        if not made:
            return np.zeros((0, BITS // 8), np.uint8)
        found = np.concatenate([t for t, _ in made])
        weights = np.concatenate([w for _, w in made])
        owner = np.repeat(np.arange(len(made)), [len(t) for t, _ in made])
        out = np.zeros((len(made), BITS // 8), np.uint8)
        for half in range(BITS // 64):
            hashed = _mix(found + np.uint64(half + 1) * _GOLDEN).astype("<u8").view(np.uint8).reshape(-1, 8)
            for k in range(8):
                # All terms of one byte value vote alike.
                heard = np.bincount(owner * 256 + hashed[:, k], weights, len(made) * 256)
                votes = heard.reshape(-1, 256) @ _VOTES
                out[:, half * 8 + k] = np.packbits(votes > 0, axis=1)[:, 0]
    return out


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which rows of 16 bytes differ."""
    return np.bitwise_count((a ^ b).view(np.uint64)).sum(-1, dtype=np.int64)


def likeness(apart: np.ndarray) -> np.ndarray:
    """Cosine of the angle that a Hamming distance stands for, 0 beyond a right angle."""
    return np.maximum(0.0, np.cos(np.pi * apart / BITS))


# --- the order of the documents -----------------------------------------------


def _in_order(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows of ``docs`` (doc_id, text) with ``bucket``, ``guest``, ``row``, ``size`` and
    the packed ``text``: buckets hold runs of the documents in order, and as a guest the
    first document that follows, so each can be read on its own.

    Buckets end at keys sampled from the table; the sample only sets their sizes.
    """
    keys = stage(
        docs.select("doc_id", content_id(F.col("doc_id"), F.col("text")).alias("row")), "simhash_keys"
    )
    key = F.struct(F.col("doc_id").isNotNull().alias("some"), "doc_id", "row").alias("key")
    found = keys.agg(F.count("*").alias("n"), F.max(key).alias("last")).first()
    share = min(1.0, SAMPLED * buckets / max(found.n, 1))
    sample = keys.sample(share, seed=11).select(key).collect()  # some rows per bucket
    drawn = sorted({_comparable(k) for k in [*(r.key for r in sample), found.last] if k})
    # Each end is a row's own key, the highest one among them.
    ends = drawn[:: -max(1, len(drawn) // buckets)][::-1]
    n = len(ends)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in in_slices(whole, 1)):
            own = list(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()))
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            packed = [pa.compress(t, codec="zstd", asbytes=True) for t in texts]
            at, buckets_of, guest = [], [], []
            for i, (doc, row) in enumerate(own):
                k = _comparable((doc is not None, doc, row))
                bucket = bisect_left(ends, k)
                at.append(i), buckets_of.append(bucket), guest.append(False)
                if ends[bucket] == k:
                    at.append(i), buckets_of.append((bucket + 1) % n), guest.append(True)
            taken = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(taken), batch.column(2).take(taken),
                    pa.array(buckets_of, pa.int32()), pa.array(guest),
                    pa.array([len(texts[i]) for i in at], pa.int64()),
                    pa.array([packed[i] for i in at], pa.binary()),
                ],
                ["doc_id", "row", "bucket", "guest", "size", "packed"],
            )

    schema = StructType([docs.schema["doc_id"]])
    for name, kind in (("row", "long"), ("bucket", "integer"), ("guest", "boolean"), ("size", "long"), ("packed", "binary")):
        schema = schema.add(name, kind)
    source = docs.select("doc_id", "text", content_id(F.col("doc_id"), F.col("text")).alias("row"))
    dealt = source.mapInArrow(run, schema).repartitionById(max(n, 1), F.col("bucket"))
    down = [F.col("doc_id").desc_nulls_last(), F.col("row").desc()]
    return dealt.sortWithinPartitions("bucket", "guest", *down)


def _comparable(key: tuple) -> tuple:
    some, doc, row = key
    return (some, doc, row) if some else (some, 0, row)


def _with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Lists of (doc_id, text, text of the document that follows)."""
    held = None
    for batch in (part for whole in batches for part in in_slices(whole, 4)):
        out = []
        ids, buckets, guests = (batch.column(k).to_pylist() for k in (0, 2, 3))
        for i, size in enumerate(batch.column(4).to_pylist()):
            text = pa.decompress(batch.column(5)[i].as_buffer(), size, codec="zstd", asbytes=True) if size else b""
            text = text.decode("utf-8")
            if held is not None and held[2] == buckets[i] and not held[3]:
                out.append((held[0], held[1], text))
            held = (ids[i], text, buckets[i], guests[i])
        yield out


def edited(text: str, following: str) -> str:
    """``text`` with the last half of its characters replaced by the first as many of
    ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprint_edits(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Fingerprints of every document and of its text with the last half taken from
    the next one, by descending id; after the last comes the first.

    Returns ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited`` and ``near_next`` (likeness to the edited
    text and to the next document). A null text is empty. Rows of one id follow each
    other by a hash of their texts, null ids come last; repeated rows come out as often
    as given, each the next of the one before. Other columns are not used. Texts move
    once, packed.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = source.schema["doc_id"].dataType
    id_type = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _with_next(batches):
            if not rows:
                continue
            changed = [edited(own, following) for _, own, following in rows]
            own = fingerprints([r[1] for r in rows])
            other = fingerprints(changed)
            after = fingerprints([r[2] for r in rows[-1:]])
            # The next document is the next row, but where a bucket or a slice ends.
            next_own = np.concatenate([own[1:], after])
            for k in range(len(rows) - 1):
                if rows[k][2] is not rows[k + 1][1]:
                    next_own[k] = fingerprints([rows[k][2]])[0]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], id_type),
                    pa.array([len(r[1]) for r in rows], pa.int64()),
                    pa.array([hashlib.sha256(t.encode("utf-8")).hexdigest() for t in changed]),
                    pa.array([f.tobytes().hex() for f in own]),
                    pa.array([f.tobytes().hex() for f in other]),
                    pa.array(likeness(distance(own, other))),
                    pa.array(likeness(distance(own, next_own))),
                ],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    schema = StructType([StructField("doc_id", kind)]).add("n_chars", "long")
    for name, of in (
        ("edited_sha256", "string"), ("fingerprint", "string"), ("edited_fingerprint", "string"),
        ("near_edited", "double"), ("near_next", "double"),
    ):
        schema = schema.add(name, of)
    return _in_order(source, buckets).mapInArrow(run, schema)


# --- near fingerprints ---------------------------------------------------------


class Tables:
    """Which bits stand first in each permuted table: all choices of ``agree`` blocks
    out of ``radius + agree``."""

    def __init__(self, radius: int, agree: int) -> None:
        if not (radius >= 0 and agree >= 1 and radius + agree <= 16):
            raise ValueError("at least one block, and at most 16, are needed")
        self.radius = radius
        blocks = np.array_split(np.arange(BITS), radius + agree)
        self.choices = list(itertools.combinations(range(len(blocks)), agree))
        self.blocks = np.stack([self._mask(b) for b in blocks])
        self.masks = np.stack([self._mask(np.concatenate([blocks[b] for b in c])) for c in self.choices])
        # First table in which two fingerprints meet, by the blocks that agree.
        self.first = np.full(1 << len(blocks), len(self.choices), np.int64)
        for agreeing in range(1 << len(blocks)):
            for k, choice in enumerate(self.choices):
                if all(agreeing >> b & 1 for b in choice):
                    self.first[agreeing] = k
                    break

    @staticmethod
    def _mask(bits: np.ndarray) -> np.ndarray:
        on = np.zeros(BITS, np.uint8)
        on[bits] = 1
        return np.packbits(on)

    def keys(self, fingerprint: np.ndarray) -> np.ndarray:
        """A row's key in each table: a hash of the table and of the bits that stand
        first in it."""
        out = np.zeros((len(fingerprint), len(self.masks)), np.uint64)
        with np.errstate(over="ignore"):
            for k, mask in enumerate(self.masks):
                low, high = (fingerprint & mask).view("<u8").T
                out[:, k] = _mix(_mix(low + np.uint64(k + 1) * _GOLDEN) + high)
        return out.view(np.int64)

    def linked(self, a: np.ndarray, b: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Whether rows of ``a`` and ``b`` are within the radius, differ, and meet in no
        earlier table."""
        apart = a ^ b
        bits = np.bitwise_count(apart.view(np.uint64)).sum(-1, dtype=np.int64)
        found = (bits > 0) & (bits <= self.radius)
        if found.any():
            at = np.nonzero(found)
            agreeing = np.zeros(len(at[0]), np.int64)
            for k, mask in enumerate(self.blocks):
                agreeing |= (~(apart[at] & mask).any(-1)).astype(np.int64) << k
            found[at] = self.first[agreeing] == np.broadcast_to(table, found.shape)[at]
        return found


def _near_of(tile: dict[str, np.ndarray], tables: Tables) -> np.ndarray:
    """Documents near each row of one run of tiles (arrays sorted by work item)."""
    key, lo, hi, own, table, docs, prints = (tile[c] for c in ("key", "lo", "hi", "own", "table", "docs", "prints"))
    n = len(key)
    near = np.zeros(n, np.int64)
    starts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])))
    sizes = np.diff(np.append(starts, n))
    group = np.repeat(np.arange(len(starts)), sizes)
    small = sizes <= 8
    for shift in range(1, min(8, int(sizes[small].max(initial=1)))):
        i = np.flatnonzero((group[shift:] == group[:-shift]) & small[group[shift:]])
        j = i + shift
        hit = tables.linked(prints[i], prints[j], table[i]) & ((lo[i] == hi[i]) | (own[i] != own[j]))
        near[i[hit]] += docs[j[hit]]
        near[j[hit]] += docs[i[hit]]
    for start, size in zip(starts[~small].tolist(), sizes[~small].tolist()):
        rows = slice(start, start + size)
        one = lo[start] == hi[start]
        left = np.flatnonzero(own[rows] == lo[start]) + start
        right = left if one else np.flatnonzero(own[rows] == hi[start]) + start
        for begin in range(0, len(left), 128):
            some = left[begin : begin + 128]
            hit = tables.linked(prints[some][:, None, :], prints[right][None, :, :], table[start])
            near[some] += hit @ docs[right]
            if not one:
                near[right] += docs[some] @ hit
    return near


def near_counts(prints: DataFrame, radius: int = RADIUS, agree: int = AGREE) -> DataFrame:
    """Of a table ``fp`` (binary, distinct) and ``docs`` (documents that have it):
    ``fp`` and ``near``, the documents of other fingerprints within ``radius``; none
    for those without. Hot values of a block are compared tile by tile; pairs are
    counted where they meet, in the first table that has both, and never written."""
    tables = Tables(radius, agree)
    each = len(tables.masks)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            found = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(rows, -1)
            at = pa.array(np.repeat(np.arange(rows), each))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(tables.keys(found).ravel()),
                    pa.array(np.tile(np.arange(each, dtype=np.int8), rows)),
                    batch.column(0).take(at), batch.column(1).take(at),
                ],
                ["key", "table", "fp", "docs"],
            )

    dealt = prints.select("fp", "docs").mapInArrow(deal, "key bigint, table tinyint, fp binary, docs bigint")
    crowds = (
        dealt.groupBy("key").agg(F.count("*").alias("crowd")).where("crowd > 1")
        .select("key", "crowd", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    salted = dealt.withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(SALTS)).cast("int"))
    parts = F.ceil(F.col("crowd") / TILE).cast("int")
    work = (
        salted.join(crowds, ["key", "salt"])
        .withColumn("own", F.pmod(F.xxhash64(F.lit(1), "fp"), parts).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
        .select(
            "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
            "own", "table", "fp", "docs",
        )
        .repartition("key", "lo", "hi")
        .sortWithinPartitions("key", "lo", "hi")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None

        def finished(tile: dict[str, np.ndarray]) -> pa.RecordBatch:
            near = _near_of(tile, tables)
            some = np.flatnonzero(near)
            data = [tile["prints"][i].tobytes() for i in some.tolist()]
            return pa.RecordBatch.from_arrays([pa.array(data, pa.binary()), pa.array(near[some])], ["fp", "near"])

        for batch in batches:
            if not batch.num_rows:
                continue
            tile = {c: batch.column(c).to_numpy() for c in ("key", "lo", "hi", "own", "table", "docs")}
            tile["prints"] = np.frombuffer(b"".join(batch.column("fp").to_pylist()), np.uint8).reshape(-1, BITS // 8)
            if held is not None:
                tile = {c: np.concatenate([held[c], tile[c]]) for c in tile}
            # The last work item may go on in the next batch.
            last = (tile["key"] == tile["key"][-1]) & (tile["lo"] == tile["lo"][-1]) & (tile["hi"] == tile["hi"][-1])
            cut = len(last) - int(last.sum())
            if cut:
                yield finished({c: v[:cut] for c, v in tile.items()})
            held = {c: v[cut:] for c, v in tile.items()}
        if held is not None:
            yield finished(held)

    found = work.mapInArrow(count, "fp binary, near bigint")
    return found.groupBy("fp").agg(F.sum("near").alias("near"))


def with_near(
    rows: DataFrame, fingerprint: str = "fingerprint", out: str = "n_near",
    radius: int = RADIUS, agree: int = AGREE,
) -> DataFrame:
    """``rows`` with the number of other rows whose ``fingerprint`` (hex) is within
    ``radius`` bits, those of the same fingerprint included."""
    own = rows.groupBy(fingerprint).agg(F.count("*").alias("docs"))
    prints = stage(own.select(F.unhex(fingerprint).alias("fp"), "docs"), "simhash_prints")
    near = near_counts(prints, radius, agree)
    total = prints.join(near, "fp", "left").select(
        F.lower(F.hex("fp")).alias(fingerprint),
        (F.col("docs") - 1 + F.coalesce("near", F.lit(0))).alias(out),
    )
    found = hot_key_join(rows, total.where(F.col(out) > 0), fingerprint, "left")
    return found.select(*rows.columns, F.coalesce(out, F.lit(0)).cast("long").alias(out))

