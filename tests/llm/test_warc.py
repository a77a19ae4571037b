"""Archives: round trip, the format's frames, broken archives."""

import base64
import hashlib
import struct

import zstandard as zstd

from plumbline.llm import warc


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_round_trip_with_revisits(spark):
    same = "<p>same</p>" * 50
    pages = [(n, f"http://a/{n}", f"<html>{n} é😀</html>" * (n % 7)) for n in range(300)]
    pages += [(n, "http://b/x y\r\n", same) for n in range(1000, 1100)] + [(5000, None, None), (None, "u", "lone"), (None, "u", same)]
    pages += [(7000, "u", "twice"), (7000, "u", "twice"), (9000, "u", "x" * 3_000_000)]
    df = spark.createDataFrame([(*p, 1, "e") for p in pages], "page_id long, url string, html string, payload int, first string")
    largest = {}
    for page_id, _, html in pages:
        data = (html or "").encode()
        if page_id is not None:
            largest[data] = max(largest.get(data, page_id), page_id)
    want = []
    for page_id, _, html in pages:
        data = (html or "").encode()
        first = largest.get(data)
        refers = None if first is None or first == page_id else first
        want.append((page_id, len(data), digest(data), "response" if refers is None else "revisit", refers, None))
    assert rows_of(warc.archived_pages(df)) == sorted(want, key=str)
    assert warc.archived_pages(df.limit(0)).count() == 0


def test_small_payloads_are_not_revisited(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    got = {r.page_id: r.refers_to for r in warc.with_revisits(df, 3).collect()}
    assert got == {1: None, 2: None, 3: 4, 4: None}


def test_archives_hold_dictionary_and_a_frame_each(spark, tmp_path):
    df = spark.createDataFrame([(n, f"http://a/{n}", f"<html><body>page {n}</body></html>" * 20) for n in range(400)], "page_id long, url string, html string")
    manifest = warc.write_archives(warc.with_revisits(df.coalesce(1)), str(tmp_path / "w"), roll=8000)
    files = manifest.collect()
    assert len(files) > 1 and sum(r.records for r in files) == 400
    for r in files:
        data = open(r.path, "rb").read()
        magic, size = struct.unpack("<II", data[:8])
        assert magic == warc.DICTIONARY_FRAME and len(data) == r.bytes
        trained = zstd.ZstdCompressionDict(zstd.ZstdDecompressor().decompress(data[8 : 8 + size]))
        at, n = 8 + size, 0
        while at < len(data):
            d = zstd.ZstdDecompressor(dict_data=trained).decompressobj()
            assert d.decompress(data[at:]).startswith(b"WARC/1.1\r\n") and d.eof
            at, n = len(data) - len(d.unused_data), n + 1
        assert n == r.records
    back = warc.read_archives(manifest)
    assert back.filter("problem IS NOT NULL").count() == 0
    assert {bytes(r.payload) for r in back.collect()} == {f"<html><body>page {n}</body></html>".encode() * 20 for n in range(400)}


def test_broken_archives(spark, tmp_path):
    c = zstd.ZstdCompressor(level=3)
    good = warc.record(1, "http://a", b"body", digest(b"body"), None, "2024-01-01T00:00:00Z")
    made = {
        "plain dictionary": struct.pack("<II", warc.DICTIONARY_FRAME, 5) + b"hello" + zstd.ZstdCompressor(dict_data=zstd.ZstdCompressionDict(b"hello")).compress(good),
        "none": b"",
        "cut": c.compress(good)[:-5],
        "noise": c.compress(good) + b"noise",
        "short": c.compress(good.replace(b"body\r\n\r\n", b"bod\r\n\r\n")),
        "two": c.compress(good + good),
        "version": c.compress(good.replace(b"WARC/1.1", b"WARC/9")),
        "digest": c.compress(good.replace(b"body", b"bodY")),
        "header": c.compress(good.replace(b"WARC-Date: ", b"WARC-Date ")),
        "missing": c.compress(good.replace(b"WARC-Date:", b"X-Date:")),
        "length": c.compress(good.replace(b"\r\nContent-Length: ", b"\r\nContent-Length: -")),
        "skipped": struct.pack("<II", 0x184D2A50, 3) + b"abc" + c.compress(good),
    }
    for name, data in made.items():
        (tmp_path / f"{name}.warc.zst").write_bytes(data)
    paths = spark.createDataFrame([(str(tmp_path / f"{n}.warc.zst"),) for n in made] + [(None,)], "path string")
    got = {}
    for r in warc.read_archives(paths).collect():
        got.setdefault(r.path.rsplit("/", 1)[1].split(".")[0], []).append(r.problem)
    assert got.pop("plain dictionary") == [None] and got.pop("skipped") == [None]
    assert "none" not in got and got.pop("noise") == [None, "frame does not decode"]
    assert got == {
        "cut": ["archive ends within a frame"], "short": ["length does not match the frame"], "two": ["length does not match the frame"],
        "version": ["no WARC version"], "digest": ["block digest does not match"], "header": ["malformed header"],
        "missing": ["no warc-date"], "length": ["malformed content-length"],
    }
