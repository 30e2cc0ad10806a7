"""Archives: round trips, seeking, revisits."""

import collections
import hashlib
import io

import zstandard

from framecat.llm import warc

ODD = [(None, None, None), (1, "http://x/ a", ""), (2, "u", "x" * 100), (3, None, "x" * 100), (2, "u", "x" * 100), (4, "u", "x" * 99), (5, "u", "x" * 99),
       (6, "u", "é" * 50), (7, "u", "é" * 50), (None, "u", "é" * 50), (8, "u", "\r\n\r\nWARC/1.1\r\n" * 20), (9, "u", "long" * 400000)]


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], "page_id long, url string, html string, digest string, first int").repartition(3)


def brute(rows):
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        ids = [k for k, _, x in rows if (x or "") == (h or "") and k is not None]
        first = min(ids) if ids and len(data) >= 100 else None
        revisit = first is not None and i != first
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return collections.Counter(out)


def test_archive(spark, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 300)
    monkeypatch.setattr(warc, "BUNDLE_BYTES", 2000)
    rows = ODD + [(100 + i, "u", f"page {i % 40} " * 30) for i in range(90)]
    got = warc.archive(pages(spark, rows)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert collections.Counter(map(tuple, got.collect())) == brute(rows)
    assert warc.archive(pages(spark, [])).count() == 0


def test_seek_and_plain_reading(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 500)
    rows = [(i, f"http://h/{i}", f"text {i} " * 20) for i in range(60)]
    index = warc.write_bundles(pages(spark, rows), str(tmp_path))
    asked = spark.createDataFrame([(7,), (31,), (999,)], "page_id long")
    got = {r.page_id: bytes(r.payload).decode() for r in warc.lookup(index, asked).collect()}
    assert got == {i: f"text {i} " * 20 for i in (7, 31)}
    seen = 0
    for path in tmp_path.iterdir():
        whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(path.read_bytes()), read_across_frames=True).read()
        at = 0
        while at < len(whole):
            _, _, at = warc.parse(whole, at)
            seen += 1
    assert seen == 60 and index.agg({"frame": "max"}).first()[0] > 1


def test_stores():
    assert warc.store_of("/tmp/x")[1] == "/tmp/x" and warc.store_of("file:///tmp/x y")[1] == "/tmp/x y"
