import base64
import hashlib
import io

import pytest
from cases import bag
from pyspark.sql import functions as F

from tagloom.llm import warc

PAGES = "page_id long, url string, html string, score string"


def pages():
    out = [(i, f"http://e/{i % 7}", f"<p>{i % 5} ü</p>" if i % 3 else f"own {i}" * 50, "x") for i in range(40)]
    out += [(100, None, None, "x"), (101, "u\r\nX: y", "", "x"), (None, "u", "lonely", "x"), (None, "u", "own 3" * 50, "x")]
    out += [(50, "u", "same", "x")] * 3 + [(49, "u", "same", "x"), (102, "u", "z" * 300_000, "x")]
    return out


def brute(rows, min_bytes=0):
    by = {}
    for i, (p, u, h, _) in enumerate(rows):
        by.setdefault(h or "", []).append(((p is not None, p or 0, u is not None, u or "", i), p))
    out = []
    for h, group in by.items():
        raw = h.encode()
        top, top_page = max(group)
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        for key, p in group:
            revisit = len(raw) >= min_bytes and key != top
            out.append((p, len(raw), digest, "revisit" if revisit else "response", top_page if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("min_bytes", [0, 10])
def test_round_trip(spark, min_bytes):
    df = spark.createDataFrame(pages(), PAGES).repartition(3)
    got = warc.warc_round_trip(spark, df, min_bytes=min_bytes)
    assert bag(got, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == brute(pages(), min_bytes)


def test_bundles_frames_and_index(spark, tmp_path):
    df = spark.createDataFrame(pages(), PAGES).repartition(2)
    root = f"file://{tmp_path}"
    index = warc.write_bundles(warc.record_types(df), root, frame_bytes=2000, bundle_bytes=4000).cache()
    rows = index.collect()
    assert len({r["record_id"] for r in rows}) == len(pages())
    import zstandard

    for path in sorted(tmp_path.glob("*.zst")):
        raw = path.read_bytes()
        table = warc.read_seek_table(io.BytesIO(raw))
        # a plain decompressor skips the seek table and reads all frames
        whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
        assert len(whole) == sum(d for _, _, d in table)
        for r in rows:
            if r["bundle"].endswith(path.name):
                start, c, d = table[r["frame"]]
                assert (start, c) == (r["frame_start"], r["frame_size"])
                frame = zstandard.ZstdDecompressor().decompress(raw[start : start + c], max_output_size=d)
                rec = warc.parse_record(frame[r["offset"] : r["offset"] + r["length"]])
                assert rec["record_id"] == r["record_id"] and rec["page_id"] == r["page_id"]
    some = warc.read_records(index.filter(F.col("page_id") == 102)).collect()
    assert len(some) == 1 and bytes(some[0]["payload"]) == b"z" * 300_000


def test_empty_table(spark):
    assert warc.warc_round_trip(spark, spark.createDataFrame([], PAGES)).count() == 0


def test_records_are_valid_warc(spark, tmp_path):
    """Read as another program would: records one after the other, by their lengths alone."""
    import re
    from urllib.parse import urlparse

    import zstandard

    df = spark.createDataFrame(pages() + [(200, "http://e/a b/ü?q=1", "unicode url", "x"), (201, "", "no url", "x")], PAGES).repartition(2)
    warc.write_bundles(warc.record_types(df), f"file://{tmp_path}", frame_bytes=2000).collect()
    found = []
    for path in sorted(tmp_path.glob("*.zst")):
        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(path.read_bytes()), read_across_frames=True).read()
        while raw:
            head, _, rest = raw.partition(b"\r\n\r\n")
            version, *lines = head.decode("ascii").split("\r\n")
            h = dict(x.split(": ", 1) for x in lines)
            n = int(h["Content-Length"])
            assert version == "WARC/1.1" and rest[n : n + 4] == b"\r\n\r\n" and len(h) == len(lines)
            found.append((h, rest[:n]))
            raw = rest[n + 4 :]
    by_id = {h["WARC-Record-ID"]: (h, block) for h, block in found}
    assert len(by_id) == len(found) == len(pages()) + 2
    for h, block in found:
        assert re.fullmatch(r"<urn:uuid:[0-9a-f-]{36}>", h["WARC-Record-ID"])
        assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", h["WARC-Date"]) and h["Content-Type"] == "application/http;msgtype=response"
        assert h["WARC-Target-URI"] and urlparse(h["WARC-Target-URI"]) and not re.search(r"\s", h["WARC-Target-URI"])
        http, _, body = block.partition(b"\r\n\r\n")
        status, *fields = http.decode("ascii").split("\r\n")
        fields = dict(x.split(": ", 1) for x in fields)
        assert status == "HTTP/1.1 200 OK" and fields["Content-Type"].startswith("text/html")
        if h["WARC-Type"] == "response":
            assert int(fields["Content-Length"]) == len(body)
            assert h["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode()
        else:
            first, whole = by_id[h["WARC-Refers-To"]]
            assert first["WARC-Type"] == "response" and first["WARC-Payload-Digest"] == h["WARC-Payload-Digest"] and body == b""
            assert (h["WARC-Refers-To-Target-URI"], h["WARC-Refers-To-Date"]) == (first["WARC-Target-URI"], first["WARC-Date"])
            assert int(fields["Content-Length"]) == len(whole.partition(b"\r\n\r\n")[2]) and h["WARC-Profile"].endswith("identical-payload-digest")


def test_urls_come_back(spark):
    urls = {1: "http://e/a b/ü?q=%20", 2: "u\r\nX: y", 3: "", 4: None, 5: "http://e/5"}
    df = spark.createDataFrame([(i, u, f"page {i}", "x") for i, u in urls.items()], PAGES)
    got = warc.warc_round_trip(spark, df).collect()
    assert {r["page_id"]: r["url"] for r in got} == {i: u or "" for i, u in urls.items()}
