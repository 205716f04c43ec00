"""Taxonomy and model-registry readers.

Connection settings come only from the caller's options — nothing is built
in.  The JDBC reader is split into parallel range reads when a numeric
partition column and bounds are given; without them Spark reads the table
in one task (fine for a taxonomy of thousands of rows).

No database is reachable in this repository's test setup, so the JDBC path
is exercised only by passing frames in (parquet / in-memory).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.schemas import MODEL_SCHEMA, TAXONOMY_SCHEMA


def read_table(spark: SparkSession, fmt: str, schema=None, **options) -> DataFrame:
    """``fmt``: ``jdbc`` (options url, dbtable, user, password, driver, and
    optionally partitionColumn/lowerBound/upperBound/numPartitions),
    ``parquet``/``orc``/``json``/``csv`` (option path) or ``table`` (option name)."""
    if fmt == "table":
        return spark.table(options["name"])
    if fmt == "jdbc":
        return spark.read.format("jdbc").options(**options).load()
    reader = spark.read.format(fmt)
    if schema is not None and fmt in ("json", "csv"):
        reader = reader.schema(schema)
    path = options.pop("path")
    return reader.options(**options).load(path)


def read_taxonomy(spark: SparkSession, fmt: str = "parquet", **options) -> DataFrame:
    df = read_table(spark, fmt, TAXONOMY_SCHEMA, **options)
    return conform(df, TAXONOMY_SCHEMA)


def read_models(spark: SparkSession, fmt: str = "parquet", **options) -> DataFrame:
    df = read_table(spark, fmt, MODEL_SCHEMA, **options)
    return conform(df, MODEL_SCHEMA)


def conform(df: DataFrame, schema) -> DataFrame:
    """Select and cast to the declared schema; absent columns become null."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


_EPOCH = _dt.datetime(2019, 12, 1)


def taxonomy_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Taxonomy from ``(id, name, rule, level, pid)`` tuples (tests, fixtures)."""
    full = [(int(i), n, r, int(lv), int(p), _EPOCH, _EPOCH) for i, n, r, lv, p in rows]
    return spark.createDataFrame(full, TAXONOMY_SCHEMA)


def models_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Model registry from ``(id, tag_id, model_name, state, model_main, sche_time)`` tuples."""
    full = [
        (int(i), int(t), n, int(s), f"/models/{n}.jar", m, sch, None, _EPOCH, _EPOCH)
        for i, t, n, s, m, sch in rows
    ]
    return spark.createDataFrame(full, MODEL_SCHEMA)
