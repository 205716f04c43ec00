"""Wide-row sources: named fields of one source, every field a string.

A level-4 rule names the source (``inType`` + ``hbaseTable``, or a
``path``) and the fields (``selectFields``).  The selection is a plain
projection, so a columnar source reads only those columns (``ReadSchema``)
and filters written later are pushed into the scan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions.rules import SourceMeta


def select_fields(df: DataFrame, fields: list[str], family: str | None = None) -> DataFrame:
    """The named fields as strings; a field the source lacks is a null column.

    A column family is a struct column of that name: its fields are looked up
    there first, then among the source's own columns (the row key).
    """
    have = set(df.columns)
    kind = df.schema[family].dataType if family in have else None
    inside = set(kind.names) if isinstance(kind, T.StructType) else set()

    def cell(f: str):
        found = [F.col(f"`{family}`.`{f}`")] if f in inside else []
        found += [F.col(f"`{f}`")] if f in have else []
        return F.coalesce(*found) if found else F.lit(None)

    return df.select(*[cell(f).cast("string").alias(f) for f in fields])


Reader = Callable[[SparkSession, SourceMeta], DataFrame]


def _path_or_table(meta: SourceMeta) -> str:
    return meta.option("path") or meta.hbaseTable


def _string_fields(meta: SourceMeta) -> T.StructType:
    fields = T.StructType([T.StructField(f, T.StringType()) for f in meta.fields])
    return T.StructType([T.StructField(meta.family, fields), *fields]) if meta.family else fields


def _wide_rows(spark: SparkSession, meta: SourceMeta) -> DataFrame:
    from tagloom.sources.rowsource import register_wide_rows

    register_wide_rows(spark)
    options = {"path": _path_or_table(meta), "selectFields": meta.selectFields, "family": meta.family, "rowKey": meta.rowKey}
    return spark.read.format("widerow").options(**{k: v for k, v in options.items() if v}).load()


READERS: dict[str, Reader] = {
    "parquet": lambda s, m: s.read.parquet(_path_or_table(m)),
    "orc": lambda s, m: s.read.orc(_path_or_table(m)),
    # text formats: no inference — every field stays a string, as a wide row's cells are
    "csv": lambda s, m: s.read.option("header", m.option("header", "true")).option("inferSchema", "false")
    .option("sep", m.option("sep", ",")).csv(_path_or_table(m)),
    # the fields are known: no inference job reads the files first
    "json": lambda s, m: s.read.schema(_string_fields(m)).json(_path_or_table(m)),
    # a published folder, by its named source
    "widerow": lambda s, m: _wide_rows(s, m),
    "table": lambda s, m: s.table(m.hbaseTable),
    "view": lambda s, m: s.table(m.hbaseTable),
    "jdbc": lambda s, m: s.read.format("jdbc").options(
        **{k: v for k, v in m.extra.items() if k in ("url", "user", "password", "driver", "partitionColumn", "lowerBound", "upperBound", "numPartitions", "fetchsize")},
        dbtable=m.hbaseTable,
    ).load(),
}


def read_source(spark: SparkSession, meta: SourceMeta, readers: dict[str, Reader] | None = None) -> DataFrame:
    """Read the source a level-4 rule names and select its fields as strings.

    ``inType`` picks the reader (case-insensitive); ``hbase`` and the empty
    value mean a table already registered in the catalog under
    ``hbaseTable`` (the wide-row store is exposed to Spark as a table).
    """
    table = dict(READERS)
    table.update(readers or {})
    kind = (meta.inType or "table").lower()
    if kind == "hbase":
        kind = "table"
    if kind not in table:
        raise ValueError(f"unknown inType '{meta.inType}'")
    return select_fields(table[kind](spark, meta), meta.fields, meta.family)
