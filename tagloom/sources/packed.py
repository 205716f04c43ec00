"""Range partitioning of wide text lines that shuffles them as compressed blocks.

Lines of an extract repeat much, within a line and from line to line, and a
shuffle compresses little of that.  So the bounds of the ranges are sampled,
each task deals its lines to the ranges and packs those of one range into
blocks, and the blocks are what is shuffled.  Where they arrive they are
unpacked into the same lines.

A block is compressed twice: pieces of lines by snappy, whose output of such
lines repeats as they do, and the pieces of a block together by zstd.

The functions that run in tasks travel by value: executors need no package.
"""

from __future__ import annotations

import struct
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bounds: sampled lines per partition, and of all partitions together.
SAMPLE_LINES = 100
MAX_SAMPLE_LINES = 1_000_000
# What a task holds: bytes of lines before they are dealt, and of their pieces before they are packed.
HELD_BYTES = 32 << 20
PIECE_BYTES = 128 << 20
ZSTD_LEVEL = 6

_KEYS = pa.schema([("key", pa.binary()), ("tie", pa.int64())])
_LINES = pa.schema([("line", pa.binary())])
_BLOCKS = pa.schema([("slot", pa.int32()), ("size", pa.int64()), ("block", pa.binary())])
_HEAD = "<qq"  # bytes of a piece as it is, and when unpacked


def range_bounds(lines: DataFrame, line: Column, key: Column, tie: Column, n: int, text_bytes: int) -> pa.Table:
    """At most ``n - 1`` ``(key, tie)`` that cut the lines into ranges of about equal bytes, in order.

    A line is sampled with a chance in proportion to its length, so nothing
    needs to be counted first; ``text_bytes`` is about the bytes of them all.
    """
    rate = min(SAMPLE_LINES * n, MAX_SAMPLE_LINES) / max(1, text_bytes)
    if n > 1:
        lines = lines.where(F.rand(0) < F.lit(rate) * (F.octet_length(line) + F.lit(1)))
    else:
        lines = lines.limit(0)
    found = lines.select(key.cast("binary").alias("key"), tie.alias("tie")).toArrow()
    found = found.cast(_KEYS).sort_by([("key", "ascending"), ("tie", "ascending")])
    cuts = sorted({i * found.num_rows // n for i in range(1, n)} if found.num_rows else ())
    return found.take(pa.array(cuts, pa.int64())).combine_chunks()


def slots(rows: pa.Table, bounds: pa.Table) -> np.ndarray:
    """For each of ``rows`` the number of ``bounds`` below its ``(key, tie)``."""
    both = pa.concat_tables([bounds, rows.select(_KEYS.names)])
    is_bound = np.arange(both.num_rows) < bounds.num_rows
    both = both.append_column("last", pa.array(is_bound))  # a bound comes after the rows that equal it
    order = pc.sort_indices(both, [(c, "ascending") for c in both.column_names]).to_numpy()
    below = np.empty(both.num_rows, np.int64)
    below[order] = np.cumsum(is_bound[order])
    return below[bounds.num_rows :]


def pieces(held: list[pa.RecordBatch], bounds: pa.Table) -> Iterator[tuple[int, bytes]]:
    """``(slot, piece)`` of the held lines, which are given up."""
    rows = pa.Table.from_batches(held).cast(pa.schema([*_KEYS, *_LINES])).combine_chunks()
    held.clear()
    if not rows.num_rows:
        return
    slot = slots(rows, bounds)
    order = np.argsort(slot, kind="stable")
    lines = rows["line"].chunk(0).take(pa.array(order))
    slot = slot[order]
    starts = np.flatnonzero(np.diff(slot, prepend=-1))
    snappy = pa.Codec("snappy")
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(slot)], strict=True):
        # a slice is written without the lines around it
        plain = pa.RecordBatch.from_arrays([lines.slice(a, b - a)], schema=_LINES).serialize()
        once = snappy.compress(plain, asbytes=True)
        yield int(slot[a]), struct.pack(_HEAD, len(once), plain.size) + once


def pack(batches: Iterable[pa.RecordBatch], bounds: pa.Table) -> Iterator[pa.RecordBatch]:
    """Batches of ``(key, tie, line)`` as blocks of the lines of one range each."""
    zstd = pa.Codec("zstd", ZSTD_LEVEL)
    held, dealt = [], {}
    size = packed = 0

    def blocks() -> Iterator[pa.RecordBatch]:
        cols = [[], [], []]
        while dealt:
            slot, v = dealt.popitem()
            whole = b"".join(v)
            for col, x in zip(cols, (slot, len(whole), zstd.compress(whole, asbytes=True)), strict=True):
                col.append(x)
        if cols[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _BLOCKS, strict=True)], schema=_BLOCKS)

    def deal() -> int:
        n = 0
        for slot, piece in pieces(held, bounds):
            dealt.setdefault(slot, []).append(piece)
            n += len(piece)
        return n

    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= HELD_BYTES:
            packed, size = packed + deal(), 0
            if packed >= PIECE_BYTES:
                yield from blocks()
                packed = 0
    if held:
        deal()
    yield from blocks()


def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of blocks."""
    zstd, snappy = pa.Codec("zstd"), pa.Codec("snappy")
    for b in batches:
        for size, block in zip(b.column("size").to_pylist(), b.column("block"), strict=True):
            whole, at = zstd.decompress(block.as_buffer(), size), 0
            while at < size:
                once, plain = struct.unpack_from(_HEAD, whole, at)
                at += struct.calcsize(_HEAD)
                yield pa.ipc.read_record_batch(snappy.decompress(whole[at : at + once], plain), _LINES)
                at += once


def dealt_by_range(lines: DataFrame, key: Column, tie: Column, n: int, text_bytes: int) -> DataFrame:
    """The one column of ``lines`` in ``n`` partitions, by ranges of ``(key, tie)``, in no order within them."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    name = lines.columns[0]
    line = F.col(name)
    bounds = range_bounds(lines, line, key, tie, n, text_bytes)

    def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return pack(batches, bounds)

    def to_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return unpack(batches)

    given = lines.select(key.cast("binary").alias("key"), tie.alias("tie"), line.cast("binary").alias("line"))
    blocks = given.mapInArrow(to_blocks, "slot int, size long, block binary").repartitionById(n, F.col("slot"))
    return blocks.mapInArrow(to_lines, "line binary").select(F.col("line").cast("string").alias(name))
