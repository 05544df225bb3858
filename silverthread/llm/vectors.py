"""Vector codes: product quantization of integer vectors by value dictionaries.

Vectors become integers once and are kept in blocks: per dimension a dictionary of
the distinct integers of the block, and for each vector its places in them. A pass
over the blocks tabulates, per dimension, the squared differences of every distinct
integer to all codebook entries; the distances of a part are then gathers from these
tables and sums over its dimensions, exactly, in 64-bit integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from .common import stage

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Vectors of a block.
BLOCK_ROWS = 1024
#: Integers are held within this bound, so that the error of a vector of up to 128
#: dimensions fits 64 bits; floats below 2^19 in size are not touched by it.
MOST = 1 << 27


class Compressed(NamedTuple):
    """``rows``: vec_id, label, code, error, label_error; ``codebooks``: integers by
    part, entry and position, the same for all rows."""

    rows: DataFrame
    codebooks: np.ndarray


def describe(codebooks: np.ndarray) -> str:
    """All components of all entries as decimal integers, comma-joined."""
    return ",".join(map(str, codebooks.ravel().tolist()))


def digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(describe(codebooks).encode()).hexdigest()


def whole(vector: Column) -> Column:
    """Whether a vector is there, with no null and no non-finite component."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce(finite, F.lit(False))


def to_integers(values: np.ndarray, scale: int) -> np.ndarray:
    return np.clip(np.floor(values * scale), -MOST, MOST).astype(np.int64)


class Block(NamedTuple):
    """Vectors of one block: ``places[d]`` are their places in dimension d's
    dictionary, which is ``values[starts[d]:starts[d + 1]]``."""

    places: np.ndarray
    values: np.ndarray
    starts: np.ndarray

    def tables(self, codebook: np.ndarray, part: int) -> list[np.ndarray]:
        """Squared differences of the distinct integers to all entries, one table for
        each dimension of the part."""
        width = codebook.shape[1]
        made = []
        for k in range(width):
            d = part * width + k
            known = self.values[self.starts[d] : self.starts[d + 1]]
            made.append((known[:, None] - codebook[None, :, k]) ** 2)
        return made

    def nearest(self, codebooks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry of each part (of equally near ones the lowest), and the sum of the
        squared distances, of each vector."""
        parts, _, width = codebooks.shape
        rows = self.places.shape[1]
        chosen, error = np.zeros((rows, parts), np.int64), np.zeros(rows, np.int64)
        index = np.arange(rows)
        for part in range(parts):
            tables = self.tables(codebooks[part], part)
            distance = tables[0][self.places[part * width]]
            for k in range(1, width):
                distance += tables[k][self.places[part * width + k]]
            chosen[:, part] = distance.argmin(1)
            error += distance[index, chosen[:, part]]
        return chosen, error

    def component(self, d: int) -> np.ndarray:
        return self.values[self.starts[d] : self.starts[d + 1]][self.places[d]]


def _blocks(batch: pa.RecordBatch, dims: int, scale: int) -> Iterator[pa.RecordBatch]:
    """Blocks of a batch of (id, label, fits, vector); vectors that do not fit make
    blocks without integers."""
    fits = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
    for fit in (True, False):
        rows = batch.filter(pa.array(fits == fit))
        for begin in range(0, rows.num_rows, BLOCK_ROWS):
            part = rows.slice(begin, BLOCK_ROWS)
            n = part.num_rows
            places, values, starts = b"", np.zeros(0, np.int64), np.zeros(0, np.int64)
            if fit:
                flat = part.column(3).flatten().to_numpy(zero_copy_only=False)
                integers = to_integers(flat.reshape(n, dims), scale)
                known = [np.unique(integers[:, d], return_inverse=True) for d in range(dims)]
                values = np.concatenate([v for v, _ in known])
                starts = np.cumsum([0, *(len(v) for v, _ in known)])
                places = np.stack([at for _, at in known]).astype("<u2").tobytes()
            one = [0, n]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays(pa.array(one, pa.int32()), part.column(0)),
                    pa.ListArray.from_arrays(pa.array(one, pa.int32()), part.column(1)),
                    pa.array([places], pa.binary()),
                    pa.array([values], pa.list_(pa.int64())),
                    pa.array([starts], pa.list_(pa.int64())),
                ],
                ["ids", "labels", "places", "known", "starts"],
            )


def _read(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, pa.Array, Block | None]]:
    for k in range(batch.num_rows):
        ids, labels = batch.column(0)[k].values, batch.column(1)[k].values
        starts = batch.column(4)[k].values.to_numpy()
        if not len(starts):
            yield ids, labels, None
            continue
        places = np.frombuffer(batch.column(2)[k].as_py(), "<u2").reshape(len(starts) - 1, len(ids))
        yield ids, labels, Block(places, batch.column(3)[k].values.to_numpy(), starts)


def _updated(blocks: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """Each entry as the floor of the mean of its parts; unused ones as they are.

    Tasks add up their own blocks; what is shuffled and fetched is one row per
    component of the codebooks, whatever the number of vectors."""
    parts, entries, width = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(codebooks.shape, np.int64)
        count = np.zeros((parts, entries), np.int64)
        for batch in batches:
            for _, _, block in _read(batch):
                if block is None:
                    continue
                chosen, _ = block.nearest(codebooks)
                for part in range(parts):
                    count[part] += np.bincount(chosen[:, part], minlength=entries)
                    for k in range(width):
                        weights = block.component(part * width + k)
                        # Below 2^53, so exact.
                        added = np.bincount(chosen[:, part], weights, entries)
                        total[part, :, k] += added.astype(np.int64)
        used = np.repeat(count.ravel(), width) > 0
        slots = np.flatnonzero(used)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(slots, pa.int64()), pa.array(total.ravel()[slots]),
                pa.array(np.repeat(count.ravel(), width)[slots]),
            ],
            ["slot", "total", "n"],
        )

    sums = (
        blocks.mapInArrow(run, "slot bigint, total bigint, n bigint")
        .groupBy("slot").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    )
    made = codebooks.copy().ravel()
    for row in sums.collect():  # at most one row per component of the codebooks
        made[row.slot] = row.total // row.n
    return made.reshape(codebooks.shape)


def compress(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> Compressed:
    """Codes of all vectors by codebooks learned from all of them.

    Rows whose vector is null or holds a null or non-finite component are dropped.
    Components become ``floor(scale * x)`` (within 2^27 either way). Vectors are cut
    into ``parts`` equal parts, each with a codebook of ``entries`` (256 at most) that
    starts as that part of the vectors of the smallest ids and is moved ``rounds``
    times to the floor of the mean of its nearest parts. With fewer vectors the
    codebooks have fewer entries.

    Returns one row per kept row: ``vec_id``, ``label``, ``code`` (two hex digits per
    part), ``error`` (squared distance to the code) and ``label_error`` (errors summed
    over equal labels, nulls together; null if the sum is beyond 64 bits). The length
    of the first vector, by id, that ``parts`` divide is that of all: kept vectors of
    another length come out with null ``code`` and ``error``. Rows with a null id
    come after all others as starting entries, equal ids are taken by their vectors.
    Repeated rows come out as often as given; other columns are not used.
    """
    if not 0 < entries <= 256:
        raise ValueError("two hex digits name at most 256 entries")
    source = vectors.select(
        F.col(vec_id).alias("vec_id"), F.col(label).alias("label"),
        F.col(vector).cast("array<double>").alias("v"),
    ).where(whole(F.col("v")))
    size = F.size("v")
    usable = source.where((size > 0) & (size % parts == 0))
    first = [F.col("vec_id").asc_nulls_last(), F.col("v")]
    seeds = [r.v for r in usable.select("vec_id", "v").orderBy(*first).limit(entries).collect()]
    dims = len(seeds[0]) if seeds else parts
    if any(len(v) != dims for v in seeds):
        alike = usable.where(size == dims).select("vec_id", "v")
        seeds = [r.v for r in alike.orderBy(*first).limit(entries).collect()]
    codebooks = to_integers(np.array(seeds, float).reshape(len(seeds), dims), scale)
    codebooks = codebooks.reshape(len(seeds), parts, dims // parts).transpose(1, 0, 2).copy()

    kinds = [source.schema[c].dataType for c in ("vec_id", "label")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _blocks(batch, dims, scale)

    schema = StructType(
        [
            StructField("ids", ArrayType(kinds[0])), StructField("labels", ArrayType(kinds[1])),
            StructField("places", BinaryType()), StructField("known", ArrayType(LongType())),
            StructField("starts", ArrayType(LongType())),
        ]
    )
    fits = source.select("vec_id", "label", (size == dims).alias("fits"), "v")
    blocks = stage(fits.mapInArrow(cut, schema), "vector_blocks")
    for _ in range(rounds):
        codebooks = _updated(blocks, codebooks)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, labels, block in _read(batch):
                if block is None:
                    codes, errors = [None] * len(ids), [None] * len(ids)
                else:
                    chosen, errors = block.nearest(codebooks)
                    text = chosen.astype(np.uint8).tobytes().hex()
                    codes = [text[at : at + 2 * parts] for at in range(0, len(text), 2 * parts)]
                yield pa.RecordBatch.from_arrays(
                    [ids, labels, pa.array(codes, pa.string()), pa.array(errors, pa.int64())],
                    ["vec_id", "label", "code", "error"],
                )

    schema = StructType(
        [StructField("vec_id", kinds[0]), StructField("label", kinds[1])]
    ).add("code", "string").add("error", "long")
    rows = stage(blocks.mapInArrow(coded, schema), "vector_codes")
    totals = rows.groupBy(F.col("label").alias("of_label")).agg(
        F.try_sum("error").alias("label_error")
    )
    same = F.col("label").eqNullSafe(F.col("of_label"))
    return Compressed(rows.join(totals, same).drop("of_label"), codebooks)


def decode(code: str, codebooks: Sequence) -> np.ndarray:
    """The integers that a code stands for."""
    chosen = bytes.fromhex(code)
    return np.concatenate([np.asarray(codebooks[p])[e] for p, e in enumerate(chosen)])
