"""Ingest of ``\\x01``-delimited warehouse extracts into keyed rows.

Per line: split on the separator with trailing empty fields dropped; a line
one field short gets an empty last field; a line of exactly the declared
width is kept; any other width is dropped.  Field i is named after the i-th
declared column; field 0 is the key.  Parsing is Column expressions over
``spark.read.text`` — not the CSV reader, which would pad short lines and
interpret quotes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tagloom.functions.strings import java_split, strip_trailing
from tagloom.schemas import EXTRACT_COLUMNS, EXTRACT_SEP
from tagloom.sources.packed import dealt_by_range


def line_width(line: Column, sep: str = EXTRACT_SEP) -> Column:
    """Fields of a line without splitting it: separators left after the trailing run is stripped, + 1."""
    stripped = strip_trailing(line, sep)
    return (
        F.when(line == F.lit(""), F.lit(1))
        .when(stripped == F.lit(""), F.lit(0))
        .otherwise(F.length(stripped) - F.length(F.replace(stripped, F.lit(sep), F.lit(""))) + F.lit(1))
    )


def parse_lines(lines: DataFrame, columns: list[str], line_col: str = "value", sep: str = EXTRACT_SEP) -> DataFrame:
    """Lines -> keyed rows of ``columns`` (all strings); bad widths dropped.

    Each output field is one O(1) element access into the split array; the
    one-short case reads its missing last field as ``""`` instead of
    rebuilding the array (a rebuilt array would be inlined into every field
    by the optimizer and copied once per column).
    """
    n = len(columns)
    line = F.col(line_col)
    if len(sep) == 1:
        kept = lines.where(line_width(line, sep).isin(n - 1, n))
        parsed = kept.select(java_split(line, sep).alias("__f"))
    else:
        parsed = lines.select(java_split(line, sep).alias("__f")).where(F.size("__f").isin(n - 1, n))
    f = F.col("__f")
    out = [f.getItem(i).alias(name) for i, name in enumerate(columns[:-1])]
    out.append(F.coalesce(F.try_element_at(f, F.lit(n)), F.lit("")).alias(columns[-1]))
    return parsed.select(*out)


def _columns(kind_or_columns) -> list[str]:
    return EXTRACT_COLUMNS[kind_or_columns] if isinstance(kind_or_columns, str) else list(kind_or_columns)


# Plain zstd text (.zstd).  Spark's short names for text have no zstd, and Hadoop's codec needs its
# native library; this one comes with Spark.
ZSTD_CODEC = "org.apache.parquet.hadoop.codec.ZstandardCodec"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of text files, compressed or not.  Spark reads .zstd by itself, but where the codec is not
    named it takes such a file for plain text and splits it."""
    known = spark.sparkContext._jsc.hadoopConfiguration().get("io.compression.codecs")
    return spark.read.option("io.compression.codecs", ",".join(c for c in (known, ZSTD_CODEC) if c)).text(path)


def read_extract(spark: SparkSession, path: str, kind_or_columns) -> DataFrame:
    """Read one extract folder/file; ``kind_or_columns`` is a name in
    ``EXTRACT_COLUMNS`` or an explicit column list."""
    return parse_lines(read_lines(spark, path), _columns(kind_or_columns))


NULL_MARK = "\\N"  # fixed value: the warehouse's null in a text export


def typed_view(rows: DataFrame, types: dict[str, str] | None = None) -> DataFrame:
    """Keyed rows with the null marker as null, and named columns cast (malformed cells become null)."""
    types = types or {}
    cols = []
    for c in rows.columns:
        v = F.nullif(F.col(c), F.lit(NULL_MARK))
        cols.append((v.try_cast(types[c]) if c in types else v).alias(c))
    return rows.select(*cols)


# What becomes of a line: a row, a row whose missing last field was added, or a reason to leave it out.
ROWS = ("kept", "repaired")
REJECTED = ("empty", "short", "long")
OUTCOMES = ROWS + REJECTED


def line_outcome(line: Column, n: int, sep: str = EXTRACT_SEP) -> Column:
    """One of ``OUTCOMES`` for a line that should have ``n`` fields."""
    width = line_width(line, sep)
    return (
        F.when(width == n, "kept").when(width == n - 1, "repaired").when(line == "", "empty").when(width < n, "short").otherwise("long")
    )


def ingest_observed(spark: SparkSession, src: str, kind_or_columns, dest: str) -> dict[str, int]:
    """Write an extract's rows and, aside by reason, the lines that are none; returns the lines per outcome.

    One pass: the counts are observed while the lines are written into
    ``dest/outcome=<outcome>``.  ``ingested`` and ``rejected`` read them back.
    """
    columns = _columns(kind_or_columns)
    n = len(columns)
    line, outcome = F.col("value"), F.col("outcome")
    given = read_lines(spark, src).select(line, line_outcome(line, n).alias("outcome"))
    seen = Observation()
    counts = [F.count_if(outcome == o).alias(o) for o in OUTCOMES]
    watched = given.observe(seen, *counts)
    good = outcome.isin(*ROWS)
    split = watched.select("outcome", F.when(good, java_split(line, EXTRACT_SEP)).alias("__f"), F.when(~good, line).alias("__line"))
    f = F.col("__f")
    out = [F.get(f, F.lit(i)).alias(c) for i, c in enumerate(columns[:-1])]
    out.append(F.when(good, F.coalesce(F.get(f, F.lit(n - 1)), F.lit(""))).alias(columns[-1]))
    split.select(*out, "__line", "outcome").write.partitionBy("outcome").parquet(dest)
    return {o: int(seen.get[o]) for o in OUTCOMES}


def ingested(spark: SparkSession, dest: str, kind_or_columns) -> DataFrame:
    """The rows of ``ingest_observed``."""
    return spark.read.parquet(dest).where(F.col("outcome").isin(*ROWS)).select(*_columns(kind_or_columns))


def rejected(spark: SparkSession, dest: str) -> DataFrame:
    """``(outcome, line)`` of the lines that gave no row."""
    return spark.read.parquet(dest).where(F.col("outcome").isin(*REJECTED)).select("outcome", F.col("__line").alias("line"))


TARGET_BYTES = 256 * 1024 * 1024
MAX_PARTITIONS = 200_000


# What a byte of a compressed text file is taken to hold; only the number of partitions follows it.
COMPRESSED_SUFFIXES = (".gz", ".deflate", ".bz2", ".lz4", ".snappy", ".zst", ".zstd")
COMPRESSED_FACTOR = 8


def text_size(lines: DataFrame) -> int:
    """About the bytes of lines of text files, compressed or not."""
    compressed = any(f.endswith(COMPRESSED_SUFFIXES) for f in lines.inputFiles())
    return plan_size(lines) * (COMPRESSED_FACTOR if compressed else 1)


def partitions_for_text(lines: DataFrame, target_bytes: int = TARGET_BYTES) -> int:
    """``partitions_for`` of lines of text files, by the size of the text where the files are compressed."""
    return _partitions(lines, text_size(lines), target_bytes)


def plan_size(df: DataFrame) -> int:
    """The optimizer's size of ``df`` in bytes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _partitions(df: DataFrame, size: int, target_bytes: int) -> int:
    return max(df.sparkSession.sparkContext.defaultParallelism, min(MAX_PARTITIONS, -(-size // target_bytes)))


def partitions_for(df: DataFrame, target_bytes: int = TARGET_BYTES) -> int:
    """Partitions of about ``target_bytes`` by the optimizer's size of ``df``; one per core at least."""
    return _partitions(df, plan_size(df), target_bytes)


def sorted_by_key(df: DataFrame, key: str | None = None, partitions: int | None = None) -> DataFrame:
    """Range-partition on the key and sort inside each partition.

    Partition i holds keys at or below partition i+1's, so the files are in
    total key order.  The range bounds are sampled on ``(key, tie)`` where
    ``tie`` is a hash of the whole row: a hot key (one key holding a third
    of all rows) is spread over several partitions instead of one task, and
    the hash is deterministic, so a retried task rebuilds the same split.
    ``partitions`` defaults to a number that follows the size of the input.
    """
    key = key or df.columns[0]
    n = partitions or partitions_for(df)
    tie = F.xxhash64(*[F.col(c) for c in df.columns]).alias("__tie")
    return (
        df.select("*", tie)
        .repartitionByRange(n, F.col(key), F.col("__tie"))
        .sortWithinPartitions(key, "__tie")
        .drop("__tie")
    )


def write_sorted_by_key(df: DataFrame, path: str, key: str | None = None, partitions: int | None = None) -> str:
    """Publish ``sorted_by_key(df)`` as parquet; Spark's commit protocol
    publishes the folder only when the job succeeds."""
    sorted_by_key(df, key, partitions).write.parquet(path)
    return path


def sorted_extract(spark: SparkSession, src: str, kind_or_columns, partitions: int | None = None) -> DataFrame:
    """The rows of an extract, range-partitioned and sorted by key as by ``sorted_by_key``.

    What is sampled, shuffled and sorted is the line: its key is the text
    before the first separator and its tie a hash of it, so a line is split
    into fields once, after the shuffle.  The bounds are sampled at once, the
    lines are shuffled in compressed blocks (``sources/packed.py``); key and
    tie are made again where they arrive.
    """
    columns = _columns(kind_or_columns)
    line = F.col("value")
    given = read_lines(spark, src).where(line_width(line).isin(len(columns) - 1, len(columns)))
    n = partitions or partitions_for_text(given)
    key, tie = F.substring_index(line, EXTRACT_SEP, 1), F.xxhash64(line)
    dealt = dealt_by_range(given, key, tie, n, text_size(given))
    ordered = dealt.select(line, key.alias("__key"), tie.alias("__tie")).sortWithinPartitions("__key", "__tie")
    return parse_lines(ordered.select(line), columns)


# Version 2 pages hold of a text only what differs from the one before, and rows are in key order; a
# dictionary pays only while it is small.
PUBLISH_OPTIONS = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0", "parquet.dictionary.page.size": 64 * 1024}


def ingest(spark: SparkSession, src: str, kind_or_columns, dest: str, partitions: int | None = None) -> str:
    """Read an extract and publish it sorted by key (one call per extract)."""
    rows = sorted_extract(spark, src, kind_or_columns, partitions)
    rows.write.options(**PUBLISH_OPTIONS).parquet(dest)
    return dest


def published_positions(spark: SparkSession, path: str, key: str) -> DataFrame:
    """``(key, position)`` of a sorted publish: the rank (from 1) of each row in file order.

    Files are in key order by their part number; one small row per file gives
    each file's offset.
    """
    rows = spark.read.parquet(path).select(
        F.col(key), F.col("_metadata.file_name").alias("__f"), F.col("_metadata.row_index").alias("__i")
    )
    files = rows.groupBy("__f").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__f").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    offsets = files.select("__f", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__o"))
    out = rows.join(F.broadcast(offsets), "__f")
    return out.select(key, (F.col("__o") + F.col("__i") + F.lit(1)).cast("bigint").alias("position"))
