"""CSV, JSON and Parquet scans."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .. import constants as K, schemas

#: Files that a census of headers has open at a time.
OPENED_AT_ONCE = 32


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    keep_malformed: bool = False,
    optional: Sequence[str] = (),
    mixed_headers: bool = False,
) -> DataFrame:
    """CSV with a header row.

    With a schema, columns are found by their name in the header, in any order and
    letter case. Columns that the schema does not name follow as text. One that the
    header lacks fails the read, unless it is ``optional``: then it is null.
    ``path`` may be several files or folders; each is read by its own header, of
    which one line is fetched, and a file in a folder whose header is another than
    that of its neighbours fails the job rather than being read by position. With
    ``mixed_headers`` the header of every file is looked at first, files are grouped by
    it, and each group is read by its own; empty files have no rows.

    ``keep_malformed`` adds the raw text of records that do not fit the schema, so
    that an unreadable field cannot pass for a missing one. Without a schema Spark
    needs a second pass over the data to infer it.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if schema is None:
        return spark.read.option("header", True).option("inferSchema", True).csv(paths)
    groups = header_census(spark, paths) if mixed_headers else paths
    if not groups:
        in_files = schemas.with_malformed(schema) if keep_malformed else schema
        return spark.createDataFrame([], in_files)
    parts = [_by_header(spark, p, schema, keep_malformed, optional) for p in groups]
    if len(parts) == 1:
        return parts[0]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    last = [schemas.MALFORMED] if keep_malformed else []
    return rows.select(*[f"`{c}`" for c in rows.columns if c not in last], *last)


def header_census(spark: SparkSession, paths: Sequence[str]) -> list[list[str]]:
    """The files below ``paths`` that are not empty, in groups of one header line each.

    Files are listed once and only opened for their first line, many at a time, by the
    driver, which keeps a name and a group for each; no file is read by it. Hidden files
    (``_`` and ``.``) are left out, compressed ones are opened by their name's ending.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    listed = []
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        fs = place.getFileSystem(conf)
        for top in fs.globStatus(place) or []:
            files = fs.listFiles(top.getPath(), True)
            while files.hasNext():
                found = files.next()
                if found.getLen() and not found.getPath().getName().startswith(("_", ".")):
                    listed.append((fs, found.getPath()))

    def first_line(file) -> tuple[str, str]:
        fs, place = file
        stream, codec = fs.open(place), codecs.getCodec(place)
        try:
            opened = codec.createInputStream(stream) if codec is not None else stream
            reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(opened, "UTF-8"))
            return (reader.readLine() or "").removeprefix("\ufeff").strip(), place.toString()
        finally:
            stream.close()

    groups: dict[str, list[str]] = {}
    with ThreadPoolExecutor(max_workers=OPENED_AT_ONCE) as pool:
        for line, name in pool.map(first_line, listed):
            if line:
                groups.setdefault(line, []).append(name)
    return [sorted(files) for _, files in sorted(groups.items())]


def _header(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Names in the header of one of the files; none if there are no lines."""
    try:
        return spark.read.option("header", True).csv(path).columns
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return []


def _by_header(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    keep_malformed: bool,
    optional: Sequence[str],
) -> DataFrame:
    declared = {f.name.lower(): f for f in schema.fields}
    header = _header(spark, path) or schema.names
    found = [declared.get(name.lower(), T.StructField(name, T.StringType())) for name in header]
    missing = set(schema.names) - {f.name for f in found}
    if needed := sorted(missing - set(optional)):
        raise ValueError(f"no column {', '.join(needed)} in the header of {path}")
    reader = spark.read.option("header", True).option("enforceSchema", False)
    in_files = T.StructType(found)
    if keep_malformed:
        reader = reader.option("columnNameOfCorruptRecord", schemas.MALFORMED)
        in_files = schemas.with_malformed(in_files)
    rows = reader.schema(in_files).csv(path)
    return rows.select(
        *[
            F.lit(None).cast(f.dataType).alias(f.name) if f.name in missing else f.name
            for f in schema.fields
        ],
        *[f"`{f.name}`" for f in found if f.name.lower() not in declared],
        *[schemas.MALFORMED] * keep_malformed,
    )


def read_events(
    spark: SparkSession,
    path: str,
    schema: T.StructType = schemas.EVENT,
    multiline: bool = False,
) -> DataFrame:
    """Landed event documents, one row per event.

    Each line holds one event or one array of events, so files split across
    tasks. ``multiline`` reads documents that span lines; such a file cannot be
    split, so keep each of them small. Records that do not fit the schema keep
    their text in ``_malformed``.
    """
    return (
        spark.read.schema(schemas.with_malformed(schema))
        .option("columnNameOfCorruptRecord", schemas.MALFORMED)
        .option("multiLine", multiline)
        .json(path)
    )


def parse_events(
    df: DataFrame, text: Column | str, schema: T.StructType = schemas.EVENT
) -> DataFrame:
    """Events from a column of JSON text; works on batch and streaming frames.

    A text holds one event or an array of events. An unreadable text, or element of
    an array, is one row with its text in ``_malformed``; an empty array gives none.
    The parsed record comes out of a generator, which predicates on its fields
    are not pushed through: each text is parsed once, not once per use.
    """
    full = schemas.with_malformed(schema)
    options = {"columnNameOfCorruptRecord": schemas.MALFORMED}
    text = F.col(text) if isinstance(text, str) else text
    many = F.startswith(F.ltrim(text, F.lit(" \t\r\n")), F.lit("["))
    pieces = F.from_json(text, T.ArrayType(T.StringType()))
    unread = F.array(text)
    texts = F.when(many, F.coalesce(pieces, unread)).otherwise(unread)
    return df.select(F.explode(texts).alias("__text")).select(
        F.inline(F.array(F.from_json("__text", full, options)))
    )


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """A Parquet table. Give the schema when a partition column must keep its
    text, as Spark otherwise infers the type of directory values."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def active_members(dimension: DataFrame) -> DataFrame:
    """Active members; ``active_flag`` is a directory, so this prunes files."""
    return dimension.filter(F.col("active_flag") == K.ACTIVE)


def latest_partition(df: DataFrame, column: str) -> DataFrame:
    """Rows of the newest value of a partition column.

    The newest value is found by a query over the partition column alone, which
    reads no data columns, and the rows are then pruned by a literal.
    """
    newest = df.agg(F.max(column)).first()[0]
    return df.filter(F.col(column) == F.lit(newest))


def dated_partition(
    spark: SparkSession, path: str, column: str, value: str, schema: T.StructType
) -> DataFrame:
    """Rows of one value of the outermost partition column, from its directory alone.

    Nothing else is listed or opened, and a value that was never written fails.
    """
    inner = T.StructType([f for f in schema.fields if f.name != column])
    rows = spark.read.schema(inner).parquet(f"{path}/{column}={value}")
    named = {f.name: f for f in schema.fields}
    return rows.withColumn(column, F.lit(value).cast(named[column].dataType)).select(*schema.names)


def driver_rows(
    spark: SparkSession, rows: Iterable[tuple], schema: T.StructType
) -> DataFrame:
    """A few rows known to the driver, as one partition."""
    return spark.createDataFrame(list(rows), schema).coalesce(1)
