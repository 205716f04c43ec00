"""Lines that are shuffled as compressed blocks."""

import random
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_ingest import wide_lines

from tagloom.schemas import EXTRACT_COLUMNS
from tagloom.schemas import EXTRACT_SEP as SEP
from tagloom.sources import extracts, ingest, packed, published_positions, read_extract

KEYS = pa.schema([("key", pa.binary()), ("tie", pa.int64())])


def batch(rows):
    cols = list(zip(*rows, strict=True)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, [*KEYS, pa.field("line", pa.binary())], strict=True)], names=["key", "tie", "line"])


def unpacked(blocks):
    """(slot, line) of every line of blocks."""
    out = []
    for b in blocks:
        for i in range(b.num_rows):
            out += [(b["slot"][i].as_py(), x.as_py()) for r in packed.unpack([b.slice(i, 1)]) for x in r["line"]]
    return out


@pytest.mark.parametrize("held, piece", [(1, 1), (200, 1000), (1 << 25, 1 << 27)])
def test_blocks_hold_every_line_once(monkeypatch, held, piece):
    monkeypatch.setattr(packed, "HELD_BYTES", held)
    monkeypatch.setattr(packed, "PIECE_BYTES", piece)
    r = random.Random(3)
    words = [b"", b"a", b"a\x00", b"\xff\xfe", "é".encode(), b"b", b"ab", b"zz" * 50]
    rows = [(r.choice(words), r.randrange(-3, 3), bytes(r.choices(range(256), k=r.randrange(40)))) for _ in range(300)]
    cuts = sorted({(r.choice(words), r.randrange(-3, 3)) for _ in range(12)})
    bounds = pa.table({"key": pa.array([k for k, _ in cuts], pa.binary()), "tie": pa.array([t for _, t in cuts], pa.int64())}, schema=KEYS)
    given = [batch(rows[i : i + 37]) for i in range(0, len(rows), 37)] + [batch([])]
    want = sorted((sum(c < (k, t) for c in cuts), line) for k, t, line in rows)
    assert sorted(unpacked(packed.pack(iter(given), bounds))) == want
    assert unpacked(packed.pack(iter([]), bounds)) == []
    alone = {slot for slot, _ in unpacked(packed.pack(iter(given), bounds.slice(0, 0)))}
    assert alone == {0}


def test_blocks_of_wide_lines_are_small():
    columns = EXTRACT_COLUMNS["goods"]
    rows = [(k := str(i * 7919 % 5000).encode(), i, SEP.encode().join([k, *[c.encode() + b":" + k for c in columns[1:]]])) for i in range(5000)]
    bounds = pa.table({"key": [b"2", b"4"], "tie": [0, 0]}, schema=KEYS)
    blocks = list(packed.pack(iter([batch(rows)]), bounds))
    assert len(unpacked(blocks)) == 5000
    assert sum(len(x.as_py()) for b in blocks for x in b["block"]) < sum(len(x) for _, _, x in rows) / 12


def test_only_blocks_are_shuffled(spark, tmp_path):
    wide_lines(spark, 100, EXTRACT_COLUMNS["goods"]).write.text(str(tmp_path / "lines"))
    df = extracts.sorted_extract(spark, str(tmp_path / "lines"), "goods", 3)
    shuffled = df._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression", 1)[1].splitlines()[1]
    assert "MapInArrow" in shuffled and "block" in shuffled


def test_ranges_of_partitions(spark, tmp_path):
    # repeated lines, a hot key with many lines, keys of other alphabets, an empty key, lines of wrong width
    lines = [f"k{i % 500}{SEP}b{i % 1000}{SEP}c" for i in range(3000)] + [f"hot{SEP}{i}{SEP}x" for i in range(3000)]
    lines += [f"é{i}{SEP}é{SEP}c" for i in range(100)] + [f"{SEP}none{SEP}c", f"two{SEP}b", "", "short", f"a{SEP}b{SEP}c{SEP}d"]
    src, dest = str(tmp_path / "src"), str(tmp_path / "dest")
    random.Random(1).shuffle(lines)
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(3).write.text(src)
    want = sorted(tuple(r) for r in read_extract(spark, src, ["id", "a", "b"]).collect())
    df = extracts.sorted_extract(spark, src, ["id", "a", "b"], 6)
    got = df.withColumn("p", F.spark_partition_id()).collect()
    assert sorted((r.id, r.a, r.b) for r in got) == want and len(want) == 6102
    keys = [r.id.encode() for r in got]
    assert keys == sorted(keys)  # in partition order
    sizes = [sum(r.p == p for r in got) for p in range(6)]
    assert min(sizes) > 300 and max(sizes) < 2500
    assert len({r.p for r in got if r.id == "hot"}) >= 3
    ingest(spark, src, ["id", "a", "b"], dest, 6)
    back = published_positions(spark, dest, "id").orderBy("position").collect()
    assert [r.position for r in back] == list(range(1, 6103)) and [r.id.encode() for r in back] == keys


def test_nothing_to_publish(spark, tmp_path):
    spark.createDataFrame([("short",)], "value string").write.text(str(tmp_path / "src"))
    for n in (1, 4):
        dest = ingest(spark, str(tmp_path / "src"), ["id", "a", "b"], str(tmp_path / f"dest{n}"), n)
        assert spark.read.parquet(dest).columns == ["id", "a", "b"] and spark.read.parquet(dest).isEmpty()


def test_published_files_are_small(spark, tmp_path):
    wide_lines(spark, 20_000, EXTRACT_COLUMNS["goods"]).write.text(str(tmp_path / "lines"))
    dest = ingest(spark, str(tmp_path / "lines"), "goods", str(tmp_path / "out"), 2)
    extracts.sorted_extract(spark, str(tmp_path / "lines"), "goods", 2).write.option("compression", "zstd").parquet(str(tmp_path / "zstd"))
    small, zstd = (sum(f.stat().st_size for f in Path(p).glob("part-*")) for p in (dest, tmp_path / "zstd"))
    assert small < 0.8 * zstd
    assert spark.read.parquet(dest).exceptAll(spark.read.parquet(str(tmp_path / "zstd"))).isEmpty()
