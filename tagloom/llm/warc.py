"""Seekable Zstandard WARC bundles.

Records are grouped into independent Zstandard frames; a bundle is a file of
frames that ends in a seek table (a skippable frame of the public seekable
format), and an index maps each record identifier to its bundle, its frame
and its place inside that frame.  One record is read by decompressing one
frame.

A task writes bundles from its own partition, without a shuffle.  File names
hold a fresh identifier, so a task that is tried again writes new files, and
the index holds only those of the attempt that succeeded.

Records are WARC/1.1: responses and revisits hold an HTTP response block with
all mandatory fields, so other readers take them.

Defined cases: a null html is an empty payload; null urls are read back as
empty (their target URI is the record's own identifier); a null id is a record like others (ids compare with null smallest).
Of fully equal rows (id, url and payload) one is the response.  Columns other
than id, url and payload are not read.  An empty table gives no bundle and an
empty index.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import io
import struct
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.common import map_batches, staged, text_bytes
from tagloom.operators.broadcast import maybe_broadcast
from tagloom.session import scratch_path

# Fixed values of the public Zstandard seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

FRAME_BYTES = 1 << 20  # uncompressed bytes after which a frame is closed
BUNDLE_BYTES = 256 << 20  # compressed bytes after which a bundle is closed
LEVEL = 3

INDEX_SCHEMA = (
    "record_id string, page_id long, bundle string, frame int, frame_start long, frame_size long, "
    "offset long, length long"
)
READ_SCHEMA = (
    "record_id string, page_id long, url string, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, payload binary"
)


# --- one record --------------------------------------------------------------


def response_id(page_id, url, digest: str) -> str:
    """Identifier of the response of a payload: revisits name it without looking for it."""
    return str(uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}\n{url}\n{digest}"))


def _uri(url: str | None, rid: str) -> str:
    """A target URI; a page without a url is named by its record."""
    return "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode()) for c in url) if url else f"urn:uuid:{rid}"


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to=None, revisit=False, rid="", date="", refers_url=None) -> bytes:
    """A WARC/1.1 record whose block is an HTTP response.

    A revisit has the response's HTTP header but not its payload, and names the
    record, the URI and the date of what it repeats.  Ids and the url as given
    travel in extension fields.
    """
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{rid}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_uri(url, rid)}",
        "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if url:
        head.append(f"X-URL: {base64.b64encode(url.encode()).decode()}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisit:
        first = response_id(refers_to, refers_url, digest)
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:uuid:{first}>",
            f"WARC-Refers-To-Target-URI: {_uri(refers_url, first)}",
            f"WARC-Refers-To-Date: {date}",
        ]
        if refers_to is not None:
            head.append(f"X-Refers-To-Page-ID: {refers_to}")
    block = http if revisit else http + payload
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Inverse of ``record_bytes``; the digest of a response is checked against its payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    h = dict(x.split(": ", 1) for x in lines[1:])
    n = int(h["Content-Length"])
    block = rest[:n]
    if len(block) != n or rest[n:] != b"\r\n\r\n":
        raise ValueError("record cut short")
    http, _, body = block.partition(b"\r\n\r\n")
    if not http.startswith(b"HTTP/1.1 "):
        raise ValueError("not an HTTP response")
    kind, digest = h["WARC-Type"], h["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and digest != payload_digest(body):
        raise ValueError("payload digest differs")
    num = lambda k: int(h[k]) if k in h else None
    return {
        "record_id": h["WARC-Record-ID"][10:-1],
        "page_id": num("X-Page-ID"),
        "url": base64.b64decode(h.get("X-URL", "")).decode(),
        "record_type": kind,
        "refers_to": num("X-Refers-To-Page-ID"),
        "payload_bytes": num("X-Payload-Length"),
        "payload_digest": digest,
        "payload": body,
    }


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- one bundle --------------------------------------------------------------


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """Skippable frame with (compressed, uncompressed) size of every frame and the footer."""
    body = b"".join(struct.pack("<II", c, d) for c, d in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(f) -> list[tuple[int, int, int]]:
    """(start, compressed size, uncompressed size) of each frame, from the end of an open file."""
    f.seek(0, io.SEEK_END)
    end = f.tell()
    f.seek(end - 9)
    n, _, magic = struct.unpack("<IBI", f.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    f.seek(end - 9 - 8 * n)
    raw, out, at = f.read(8 * n), [], 0
    for i in range(n):
        c, d = struct.unpack_from("<II", raw, 8 * i)
        out.append((at, c, d))
        at += c
    return out


def open_shared(uri: str):
    """(file system, path) of a location all executors share."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class BundleWriter:
    """Writes the records of one task; ``rows`` are the index entries of closed frames."""

    def __init__(self, root: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES):
        import zstandard

        self.fs, self.root = open_shared(root)
        self.uri, self.frame_bytes, self.bundle_bytes = root, frame_bytes, bundle_bytes
        self.z = zstandard.ZstdCompressor(level=LEVEL)
        self.rows: list[tuple] = []
        self.out = None
        self._reset_frame()

    def _reset_frame(self):
        self.buf, self.pending, self.raw = [], [], 0

    def add(self, record_id: str, page_id, raw: bytes) -> None:
        if self.out is None:
            self.name = f"bundle-{uuid.uuid4().hex}.warc.zst"
            self.out = self.fs.open_output_stream(f"{self.root}/{self.name}", compression=None)
            self.sizes, self.at = [], 0
        self.pending.append((record_id, page_id, self.raw, len(raw)))
        self.buf.append(raw)
        self.raw += len(raw)
        if self.raw >= self.frame_bytes:
            self.close_frame()

    def close_frame(self) -> None:
        if not self.buf:
            return
        z = self.z.compress(b"".join(self.buf))
        self.out.write(z)
        frame = len(self.sizes)
        self.rows += [(r, p, f"{self.uri}/{self.name}", frame, self.at, len(z), o, n) for r, p, o, n in self.pending]
        self.sizes.append((len(z), self.raw))
        self.at += len(z)
        self._reset_frame()
        if self.at >= self.bundle_bytes:
            self.close()

    def close(self) -> None:
        if self.out is None:
            return
        self.close_frame()
        if self.out is None:  # the last frame filled the bundle
            return
        self.out.write(seek_table(self.sizes))
        self.out.close()
        self.out = None


class BundleReader:
    """Reads records by (bundle, frame, offset, length); keeps the last open bundle and frame."""

    def __init__(self):
        import zstandard

        self.z = zstandard.ZstdDecompressor()
        self.name = self.frame = self.f = None

    def record(self, bundle: str, frame: int, offset: int, length: int) -> bytes:
        if bundle != self.name:
            self.close()
            fs, path = open_shared(bundle)
            self.f, self.name, self.frame = fs.open_input_file(path), bundle, None
            self.table = read_seek_table(self.f)
        if frame != self.frame:
            start, c, d = self.table[frame]
            self.f.seek(start)
            self.data, self.frame = self.z.decompress(self.f.read(c), max_output_size=d), frame
        return self.data[offset : offset + length]

    def close(self) -> None:
        if self.f is not None:
            self.f.close()
        self.f = self.name = None


# --- the operator ------------------------------------------------------------


def record_types(pages: DataFrame, id_col="page_id", url_col="url", payload_col="html", min_bytes: int = 0) -> DataFrame:
    """Rows to write: page_id, url, payload, revisit, refers_to and refers_url (of the response).

    Rows with equal payloads of ``min_bytes`` or more share one response, the
    one with the largest (id, url).  Only payloads that occur more than once
    are joined; that side is broadcast when its measured size allows.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        text_bytes(F.col(payload_col)).alias("payload"),
    ).withColumn("sha", F.sha1("payload"))
    who = F.struct("page_id", "url")
    several = (
        rows.filter(F.length("payload") >= min_bytes)
        .groupBy("sha", "page_id", "url")
        .agg(F.count("*").alias("n"))
        .groupBy("sha")
        .agg(F.sum("n").alias("copies"), F.max(F.struct("page_id", "url", "n")).alias("top"))
        .filter("copies > 1")
        .select("sha", "top")
    )
    several = staged(several, "warc-copies")
    side, small = maybe_broadcast(several)
    j = rows.join(side, "sha", "left")
    is_top = F.col("page_id").eqNullSafe(F.col("top.page_id")) & F.col("url").eqNullSafe(F.col("top.url"))
    j = j.withColumn("is_top", F.col("top").isNull() | is_top)
    plain = j.filter(~F.col("is_top") | F.col("top").isNull() | (F.col("top.n") == 1)).select(
        "page_id", "url", "payload", (~F.col("is_top")).alias("revisit"), F.when(~F.col("is_top"), F.col("top.page_id")).alias("refers_to"),
        F.when(~F.col("is_top"), F.col("top.url")).alias("refers_url"),
    )
    if several.filter("top.n > 1").isEmpty():
        return plain
    # fully equal rows at the top: one response, the others revisit it
    equal = (
        j.filter(F.col("is_top") & (F.col("top.n") > 1))
        .groupBy("sha", "page_id", "url")
        .agg(F.first("payload").alias("payload"), F.count("*").alias("n"))
        .select("page_id", "url", "payload", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("k"))
        .select("page_id", "url", "payload", (F.col("k") > 1).alias("revisit"), F.when(F.col("k") > 1, F.col("page_id")).alias("refers_to"),
                F.when(F.col("k") > 1, F.col("url")).alias("refers_url"))
    )
    return plain.unionByName(equal)


def write_bundles(
    records: DataFrame, root: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES,
    date: str | None = None, min_bytes: int = 0,
) -> DataFrame:
    """Write the rows of ``record_types`` as bundles below ``root``; lazy index of INDEX_SCHEMA.

    ``date`` is the records' WARC-Date (default: now), one for the whole run;
    ``min_bytes`` is that of ``record_types``: shorter payloads share no response.
    """
    date = date or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def make():
        w = BundleWriter(root, frame_bytes, bundle_bytes)

        def drain():
            if w.rows:
                rows, w.rows = w.rows, []
                names = [x.split()[0] for x in INDEX_SCHEMA.split(", ")]
                yield dict(zip(names, map(list, zip(*rows, strict=True)), strict=True))

        def f(b):
            for p, u, raw, rev, ref, ref_url in zip(*[b.column(i).to_pylist() for i in range(6)], strict=True):
                digest = payload_digest(raw)
                rid = str(uuid.uuid4()) if rev or len(raw) < min_bytes else response_id(p, u, digest)
                w.add(rid, p, record_bytes(p, u, raw, digest, ref, rev, rid, date, ref_url))
            yield from drain()

        def finish():
            w.close()
            yield from drain()

        f.finish = finish
        return f

    return map_batches(records.select("page_id", "url", "payload", "revisit", "refers_to", "refers_url"), make, INDEX_SCHEMA)


def read_records(index: DataFrame, payload: bool = True) -> DataFrame:
    """The records an index names, in bundle order within each task; READ_SCHEMA.

    Rows of one bundle go to one task (a bundle is bounded in size), so each
    frame is decompressed once.  Any subset of an index works: only the
    frames it names are read.  There are as many tasks as bundles: index rows
    are small, what they name is not, so their bytes must not decide.
    """

    def make():
        r = BundleReader()

        def f(b):
            cols = [b.column(i).to_pylist() for i in range(4)]
            got = [parse_record(r.record(*x)) for x in zip(*cols, strict=True)]
            yield {k: [g[k] if payload or k != "payload" else None for g in got] for k in names}

        names = [x.split()[0] for x in READ_SCHEMA.split(", ")]
        f.finish = r.close
        return f

    ordered = (
        index.select("bundle", "frame", "offset", "length")
        .repartition(max(1, index.select("bundle").distinct().count()), "bundle")
        .sortWithinPartitions("bundle", "frame", "offset")
    )
    return map_batches(ordered, make, READ_SCHEMA)


def warc_round_trip(spark: SparkSession, pages: DataFrame, root: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Write every page, keep the index as a table, read every record back."""
    root = root or scratch_path(spark, "warc")
    if "://" not in root and not root.startswith("file:"):
        root = "file://" + root
    root = root.replace("file:///", "file:/").replace("file:/", "file:///")
    open_fs, path = open_shared(root)
    open_fs.create_dir(path, recursive=True)
    index = staged(write_bundles(record_types(pages, min_bytes=min_bytes), root, min_bytes=min_bytes), "warc-index")
    return read_records(index, payload=False)
