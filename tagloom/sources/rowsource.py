"""``spark.read.format("widerow")``: keyed wide rows of a sorted publish, as a named source.

A publish is a folder of parquet files in key order, so every file (and row
group) holds a range of keys, which its footer states.  The source turns those
ranges into read partitions, and reads only the files, row groups and fields
that are asked for, as Arrow batches.

Options: ``path`` (or ``hbaseTable``) names the folder; ``selectFields`` is
the comma list of fields, which is the schema: every field a string, null
where a row or the whole source lacks it; ``rowKey`` is the field the files
are sorted by (default: the first one); ``family`` names a struct column whose
fields are looked up before the row's own; ``startRow`` and ``stopRow`` bound
the keys (from, and up to but without).

    register_wide_rows(spark)
    spark.read.format("widerow").option("path", p).option("selectFields", "id,job").option("startRow", "7").load()

With ``keyPushdown=true`` the source also takes the query's own filters on the
key down to the files.  It is off by default: Spark 4.1 keeps what one query of
a loaded frame pushed for the frame's next queries, so a frame loaded with it
is for one condition on the key only (load it again for another).

Cells are strings, as in a wide-row store; integers and booleans are written
as text; other types are an error.  The folder must be one that ``pyarrow.fs``
opens on the driver and on every executor (local or mounted, HDFS, S3, GCS).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
    StringStartsWith,
)
from pyspark.sql.types import StringType, StructField, StructType

PARTITION_BYTES = 128 << 20
FOOTER_THREADS = 32
BATCH_ROWS = 16_384
PUSHDOWN_CONF = "spark.sql.python.filterPushdown.enabled"


def open_folder(path: str):
    """(file system, path in it) of a path or URI."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def data_files(path: str) -> list[str]:
    """Data files below a folder, in name order; hidden ones and those of hidden folders are not data."""
    from pyarrow import fs

    system, root = open_folder(path)
    found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    inside = [(f.path, f.path[len(root) :].strip("/").split("/")) for f in found if f.type == fs.FileType.File]
    return sorted(p for p, parts in inside if not any(x.startswith(("_", ".")) for x in parts))


@dataclass(frozen=True)
class KeyRange:
    """Row groups ``first`` to ``last`` of a file and the range of their keys (None: not known)."""

    file: str
    first: int
    last: int
    low: str | None
    high: str | None
    rows: int
    bytes: int


def group_ranges(system, file: str, key: str) -> list[KeyRange]:
    """Key range of every row group of a file, from its footer."""
    with system.open_input_file(file) as f:
        meta = pq.read_metadata(f)
    at = next((i for i in range(meta.num_columns) if meta.schema.column(i).path == key), None)
    out = []
    for g in range(meta.num_row_groups):
        group = meta.row_group(g)
        stats = group.column(at).statistics if at is not None else None
        known = stats is not None and stats.has_min_max
        low, high = (str(stats.min), str(stats.max)) if known else (None, None)
        out.append(KeyRange(file, g, g, low, high, group.num_rows, group.total_byte_size))
    return out


def key_ranges(path: str, key: str) -> list[KeyRange]:
    """Key ranges of all row groups below a folder: footers only, read by several threads."""
    system, _ = open_folder(path)
    with ThreadPoolExecutor(FOOTER_THREADS) as pool:
        return [r for rs in pool.map(lambda f: group_ranges(system, f, key), data_files(path)) for r in rs]


@dataclass
class KeyFilter:
    """Conditions on the key, all of which must hold."""

    tests: list[tuple[str, object]] = field(default_factory=list)

    OPS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<=", StringStartsWith: "prefix"}

    def take(self, f, key: str) -> bool:
        """Add a pushed filter; False if it is none on the key that this source can apply."""
        if getattr(f, "attribute", None) != (key,):
            return False
        op = self.OPS.get(type(f))
        if op and isinstance(f.value, str):
            self.tests.append((op, f.value))
        elif isinstance(f, In) and all(isinstance(v, str) for v in f.value):
            self.tests.append(("in", sorted(set(f.value))))
        elif isinstance(f, IsNotNull):
            self.tests.append(("present", None))
        else:
            return False
        return True

    def may_hold(self, low: str | None, high: str | None) -> bool:
        """Whether a key from ``low`` to ``high`` can pass (strings in code point order, as Spark's)."""
        if low is None or high is None:
            return True
        checks = {
            "=": lambda v: low <= v <= high,
            ">": lambda v: high > v,
            ">=": lambda v: high >= v,
            "<": lambda v: low < v,
            "<=": lambda v: low <= v,
            "prefix": lambda v: low[: len(v)] <= v <= high[: len(v)],
            "in": lambda vs: any(low <= v <= high for v in vs),
            "present": lambda _: True,
        }
        return all(checks[op](v) for op, v in self.tests)

    def mask(self, keys: pa.Array) -> pa.Array | None:
        """Which keys pass; null keys do not."""
        apply = {
            "=": pc.equal, ">": pc.greater, ">=": pc.greater_equal, "<": pc.less, "<=": pc.less_equal,
            "prefix": lambda k, v: pc.starts_with(k, v),
            "in": lambda k, vs: pc.is_in(k, pa.array(vs, pa.string())),
            "present": lambda k, _: pc.is_valid(k),
        }
        out = None
        for op, v in self.tests:
            held = pc.fill_null(apply[op](keys, v), False)
            out = held if out is None else pc.and_(out, held)
        return out


class RangePartition(InputPartition):
    def __init__(self, ranges: KeyRange):
        super().__init__(ranges)


class WideRowSource(DataSource):
    """Wide rows of a published folder (see the module)."""

    @classmethod
    def name(cls) -> str:
        return "widerow"

    def fields(self) -> list[str]:
        names = [f for f in (self.options.get("selectFields") or "").split(",") if f]
        if not names:
            raise ValueError("widerow: the option selectFields names the fields to read")
        return names

    def schema(self) -> StructType:
        return StructType([StructField(f, StringType()) for f in self.fields()])

    def reader(self, schema: StructType) -> WideRowReader:
        path = self.options.get("path") or self.options.get("hbaseTable")
        if not path:
            raise ValueError("widerow: the option path (or hbaseTable) names the folder")
        key = self.options.get("rowKey") or self.fields()[0]
        out = WideRowReader(path, list(schema.names), key, self.options.get("family") or None)
        out.push = (self.options.get("keyPushdown") or "").lower() == "true"
        for op, name in ((">=", "startRow"), ("<", "stopRow")):
            if self.options.get(name):
                out.filter.tests.append((op, self.options.get(name)))
        return out


class WideRowReader(DataSourceReader):
    def __init__(self, path: str, names: list[str], key: str, family: str | None):
        self.path, self.names, self.key, self.family = path, names, key, family
        self.filter = KeyFilter()
        self.push = False

    def pushFilters(self, filters):
        for f in filters:
            if not (self.push and self.filter.take(f, self.key)):
                yield f

    def partitions(self) -> list[RangePartition]:
        """Neighbouring row groups of a file, up to a size, whose keys may pass."""
        out: list[KeyRange] = []
        for r in key_ranges(self.path, self.key):
            if not r.rows or not self.filter.may_hold(r.low, r.high):
                continue
            last = out[-1] if out else None
            if last and last.file == r.file and last.last + 1 == r.first and last.bytes + r.bytes <= PARTITION_BYTES:
                out[-1] = KeyRange(r.file, last.first, r.last, last.low, r.high, last.rows + r.rows, last.bytes + r.bytes)
            else:
                out.append(r)
        return [RangePartition(r) for r in out]

    def read(self, partition: RangePartition | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no partition was left
            return
        r = partition.value
        system, _ = open_folder(self.path)
        schema = pa.schema([(n, pa.string()) for n in self.names])
        with system.open_input_file(r.file) as f:
            file = pq.ParquetFile(f)
            have = file.schema_arrow
            kind = have.field(self.family).type if self.family in have.names else None
            inside = {x.name for x in kind} if kind is not None and pa.types.is_struct(kind) else set()
            places = {n: [*([(self.family, n)] if n in inside else []), *([(n,)] if n in have.names else [])] for n in self.names}
            needed = [".".join(p) for ps in places.values() for p in ps]
            if self.key in have.names:
                needed.append(self.key)
            groups = list(range(r.first, r.last + 1))
            for b in file.iter_batches(BATCH_ROWS, row_groups=groups, columns=sorted(set(needed))):
                if self.filter.tests:
                    keys = b.column(self.key) if self.key in b.schema.names else pa.nulls(b.num_rows, pa.string())
                    b = b.filter(self.filter.mask(_text(keys)))
                if b.num_rows:
                    yield pa.RecordBatch.from_arrays([_cell(b, places[n]) for n in self.names], schema=schema)


def _cell(b: pa.RecordBatch, places: list[tuple]) -> pa.Array:
    """A field's values: of the family where it has one, else the row's own."""
    out = None
    for place in places:
        v = b.column(place[0])
        if len(place) > 1:
            v = pc.struct_field(v, place[1])
        out = _text(v) if out is None else pc.coalesce(out, _text(v))
    return pa.nulls(b.num_rows, pa.string()) if out is None else out


def _text(v: pa.Array) -> pa.Array:
    t = v.type
    if not (pa.types.is_string(t) or pa.types.is_large_string(t) or pa.types.is_integer(t) or pa.types.is_boolean(t) or pa.types.is_null(t)):
        raise TypeError(f"widerow: a cell is a string, not {t}; publish the source with string columns")
    return v if pa.types.is_string(t) else v.cast(pa.string())


def register_wide_rows(spark: SparkSession) -> None:
    """Make the source known to a session, and let it take filters where a frame asks for it.

    Its classes travel to the workers by value: executors need no package.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.conf.set(PUSHDOWN_CONF, "true")
    spark.dataSource.register(WideRowSource)
