"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.session import scratch_path

# Internal columns carry this prefix, so columns of the input cannot clash.
OWN = "_tl_"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of the test layout."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here.

    The rows are computed once, later steps read files that every executor
    shares, and the loss of an executor does not recompute what came before.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# A key is hot when it has more than one in HOT_KEYS of the rows: there are always fewer of them than that.
HOT_KEYS = 1000


def join_hot(big: DataFrame, one: DataFrame, keys: list[str], count: str, total: int | None = None) -> DataFrame:
    """Inner join of ``big`` with ``one``, which has one row per key, however many rows of ``big`` a key has.

    ``count`` is a column of ``one``, at least the key's number of rows in
    ``big``; ``total``, its sum, is read from ``one`` where it is not given.
    The rows of hot keys stay where they are and meet the fewer than HOT_KEYS
    rows of ``one`` that are broadcast; all others are shuffled on the key.
    Where ``one`` is asked for its total and has no hot key, it is one plain join.
    Null keys meet nothing.
    """
    if total is None:
        total, most = (x or 0 for x in one.agg(F.sum(count), F.max(count)).first())
        if most * HOT_KEYS <= total:
            return big.join(one, keys)
    is_hot = F.col(count) * HOT_KEYS > F.lit(int(total))
    hot = F.broadcast(one.filter(is_hot))
    usual = big.join(hot.select(*keys), keys, "left_anti").join(one.filter(~is_hot), keys)
    return usual.unionByName(big.join(hot, keys))


# Bytes of an Arrow batch: documents are long, and a worker holds some copies of a batch.
BATCH_BYTES = 8 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def with_package(df: DataFrame) -> DataFrame:
    """``df``, made ready for Python workers.

    Workers on the driver's machine find this package where the driver found
    it, whatever their working folder (on a cluster the package is shipped with
    ``--py-files`` and the path does nothing).  Batches are bounded in bytes;
    a smaller bound of the session stays.
    """
    conf = df.sparkSession.conf
    now = (conf.get(_BATCH_CONF, None) or "").rstrip("bB")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        conf.set(_BATCH_CONF, str(BATCH_BYTES))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = df.sparkSession.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return df


def give_back() -> None:
    """Return freed memory to the system at the end of a task: the worker may sit idle or do other work."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library can
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def map_batches(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterable[dict]]], schema: str | T.StructType
) -> DataFrame:
    """Arrow batches through a function made once per task.

    ``make()`` returns ``f(batch) -> iterable of {column: values}``; it may
    also carry a ``finish`` attribute, called after the last batch.
    """
    target = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    arrow = arrow_schema(target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for b in batches:
            for cols in f(b) or ():
                yield to_batch(cols, arrow)
        finish = getattr(f, "finish", None)
        for cols in (finish() if finish else None) or ():
            yield to_batch(cols, arrow)
        give_back()

    return with_package(df).mapInArrow(run, target)


def to_batch(cols: dict, arrow: pa.Schema) -> pa.RecordBatch:
    arrays = []
    for f in arrow:
        v = cols[f.name]
        arrays.append(v if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array(v, type=f.type))
    arrays = [a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a for a in arrays]
    return pa.RecordBatch.from_arrays(arrays, schema=arrow)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def append_columns(
    df: DataFrame, inputs: dict[str, F.Column], outputs: str, make: Callable[[], Callable[..., dict]]
) -> DataFrame:
    """Keep every column of ``df`` and add ``outputs``, computed per Arrow batch.

    ``make()`` returns ``f(**lists) -> {output: values}`` where the lists are
    the values of ``inputs`` as Python lists.  Input and output columns carry
    the OWN prefix while they travel beside the caller's columns.
    """
    names = list(df.columns)
    extra = T._parse_datatype_string(outputs)
    given = df.select("*", *[c.alias(OWN + k) for k, c in inputs.items()])
    target = T.StructType(list(df.schema.fields) + [T.StructField(OWN + f.name, f.dataType) for f in extra])
    arrow = arrow_schema(target)
    n, keys = len(names), list(inputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for b in batches:
            got = f(**{k: b.column(n + i).to_pylist() for i, k in enumerate(keys)})
            cols = [b.column(i).cast(arrow.field(i).type) for i in range(n)]
            cols += [pa.array(got[x.name], type=arrow.field(n + i).type) for i, x in enumerate(extra)]
            yield pa.RecordBatch.from_arrays(cols, schema=arrow)
        give_back()

    return with_package(given).mapInArrow(run, target)


def doc_bucket(doc_id: F.Column, m: int) -> F.Column:
    """crc32 of the id as text, modulo ``m``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(m)


def text_bytes(c: F.Column) -> F.Column:
    """UTF-8 bytes of a text; null is empty."""
    return F.coalesce(c.cast("string"), F.lit("")).cast("binary")


def hash64(items: Iterable[bytes]) -> np.ndarray:
    """64-bit content hashes (blake2b) of byte strings, the same in every process."""
    from hashlib import blake2b

    raw = b"".join([blake2b(x, digest_size=8).digest() for x in items])
    return np.frombuffer(raw, dtype="<u8")


def crc(b: bytes) -> int:
    return zlib.crc32(b) & 0xFFFFFFFF
