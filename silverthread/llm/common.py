"""Small helpers that the corpus operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from silverthread import session, sinks

#: ASCII white space, as the contracts of the operators name it.
BLANKS = " \t\n\x0b\x0c\r"

#: Bytes of text that become Python strings at a time.
SLICE_BYTES = 1 << 20

#: Bits that a wanted key gets in a bitmap, and bits of a bitmap at most (8 MB).
KEY_BITS, MOST_BITS = 16, 1 << 26

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared scratch folder and read it back.

    Consumers that follow read files that outlive any executor. The folder is the
    session's ``spark.checkpoint.dir``; its owner clears it after the session.
    """
    return sinks.stage(df, session.scratch_path(df.sparkSession, name))[0]


def mostly_among(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows whose ``key``, a 64-bit hash, is in ``wanted`` (a written table with that
    column), and of the others about one in :data:`KEY_BITS`: what a join would drop need
    not be shuffled for it.

    The keys are bits of a bitmap small enough to be broadcast. Where there are more than
    fit it, more of the other rows pass.
    """
    bits = min(max(KEY_BITS * wanted.count(), 1 << 15), MOST_BITS)
    slot, names = F.pmod(F.col(key), F.lit(bits)) + 1, [free_name(rows.columns, n) for n in ("bucket", "bitmap")]
    bucket, bitmap = names
    bitmaps = stage(
        wanted.groupBy(F.bitmap_bucket_number(slot).alias(bucket)).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias(bitmap)
        ),
        "bitmaps",
    )
    bit = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring(F.col(bitmap), F.shiftright(bit, 3).cast("int") + 1, 1)), 16, 10)
    held = F.getbit(byte.cast("long"), (bit % 8).cast("int")) == 1
    return rows.withColumn(bucket, F.bitmap_bucket_number(slot)).join(F.broadcast(bitmaps), bucket).where(held).drop(*names)


def free_name(columns: Iterable[str], wanted: str) -> str:
    """``wanted``, or the first ``wanted_N`` that no column has (in any case)."""
    taken = {c.lower() for c in columns}
    name, n = wanted, 0
    while name.lower() in taken:
        n += 1
        name = f"{wanted}_{n}"
    return name


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def content_id(*columns: Column) -> Column:
    """64-bit hash of a row's id and text: tells rows of one id apart, and is the
    same for repeated rows and for a repeated task."""
    return F.xxhash64(*columns)


def in_slices(batch: pa.RecordBatch, column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows whose strings or binaries in ``column`` come to about
    ``most`` bytes; a longer one is a run of its own. Nothing is copied. A column of
    numbers is taken for the sizes themselves."""
    sizes = batch.column(column)
    if not pa.types.is_integer(sizes.type):
        sizes = pc.fill_null(pc.binary_length(sizes), 0)
    ends = np.cumsum(sizes.to_numpy().astype(np.int64) + 1)
    begin = 0
    while begin < batch.num_rows:
        before = ends[begin - 1] if begin else 0
        end = max(int(np.searchsorted(ends, before + most, side="right")), begin + 1)
        yield batch.slice(begin, end - begin)
        begin = end
