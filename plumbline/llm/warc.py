"""WARC archives compressed with Zstandard: one frame for each record, a dictionary in front.

An archive starts with a skippable frame that holds the dictionary (plain or
compressed itself), followed by one frame for each record. Writers train the
dictionary on the first records of a task (at most SAMPLE_RECORDS and
SAMPLE_BYTES of them) and start a new archive after ROLL_BYTES. Every attempt of
a task writes files of its own name, and only the files named by the attempts
that count enter the manifest, so lost executors leave no half archive behind.
Readers stream: they hold one chunk and one record.

Records that break a rule come out with `problem` set: a frame that does not
decode, ends early or holds more than its record, a missing or malformed header,
a length or a digest that does not match. A frame that can't be delimited ends
its archive.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard as zstd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.frames import arrow_schema
from plumbline.session import new_path, spool

DICTIONARY_FRAME = 0x184D2A5D
ZSTD_FRAME = 0xFD2FB528
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES = 128, 4 << 20, 32 << 10
ROLL_BYTES = 32 << 20
CHUNK = 1 << 18
LEVEL = 3
MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_FIELD = re.compile(r"[!#$%&'*+.^_`|~0-9A-Za-z-]+")
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def payload_digest(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1, by groups of 20 bits."""
    hexed = F.sha1(payload)
    digits = [F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Adds payload, its size and digest, and for repeats the id of the record they revisit.

    Of equal payloads of at least `least_bytes`, the largest page_id is the
    response; rows that share that id, and rows without any id in their group, are
    responses too. Null html is an empty payload. The groups are reduced to one
    row before they are joined back.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"),
    )
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": payload_digest(F.col("payload"))})
    firsts = rows.filter(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest", "payload_bytes")
    firsts = firsts.agg(F.max("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    rows = rows.join(firsts, ["payload_digest", "payload_bytes"], "left")
    repeat = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return rows.withColumn("refers_to", F.when(repeat, F.col("first"))).drop("first")


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """A response record, or a revisit record that keeps only the HTTP head."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date": date,
        "WARC-Target-URI": url and _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url),
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Block-Digest": "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode(),
        "WARC-Profile": None if refers_to is None else REVISIT_PROFILE,
        "WARC-Refers-To": None if refers_to is None else f"<urn:page:{refers_to}>",
        "Content-Length": str(len(block)),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v)
    return f"WARC/1.1\r\n{lines}\r\n".encode("utf-8", "replace") + block + b"\r\n\r\n"


def make_dictionary(samples: list[bytes]) -> zstd.ZstdCompressionDict | None:
    """A trained dictionary; the first bytes of the samples where they are too few to train on."""
    if not any(samples):
        return None
    try:
        return zstd.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL)
    except zstd.ZstdError:
        return zstd.ZstdCompressionDict(b"".join(samples)[:DICTIONARY_BYTES], dict_type=zstd.DICT_TYPE_RAWCONTENT)


class Writer:
    """Archives of one task attempt."""

    def __init__(self, folder: str, name: str, roll: int) -> None:
        self.files, self.root = fs.FileSystem.from_uri(folder)
        self.folder, self.name, self.roll = folder, name, roll
        self.waiting: list[bytes] = []
        self.compressor = self.out = None
        self.front = b""
        self.done: list[tuple[str, int, int]] = []

    def add(self, data: bytes) -> None:
        if self.compressor is None:
            self.waiting.append(data)
            if len(self.waiting) >= SAMPLE_RECORDS or sum(map(len, self.waiting)) >= SAMPLE_BYTES:
                self._begin()
            return
        self._write(data)

    def _begin(self) -> None:
        trained = make_dictionary(self.waiting)
        if trained is not None:
            packed = zstd.ZstdCompressor(level=19).compress(trained.as_bytes())
            self.front = struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed
        self.compressor = zstd.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True, write_content_size=True)
        for data in self.waiting:
            self._write(data)
        self.waiting = []

    def _write(self, data: bytes) -> None:
        if self.out is None:
            self.path = f"{self.name}-{len(self.done):04d}.warc.zst"
            self.out = self.files.open_output_stream(f"{self.root}/{self.path}", compression=None)
            self.out.write(self.front)
            self.records, self.size = 0, len(self.front)
        frame = self.compressor.compress(data)
        self.out.write(frame)
        self.records, self.size = self.records + 1, self.size + len(frame)
        if self.size >= self.roll:
            self._end()

    def _end(self) -> None:
        self.out.close()
        self.out = None
        self.done.append((f"{self.folder}/{self.path}", self.records, self.size))

    def finish(self) -> list[tuple[str, int, int]]:
        if self.waiting:
            self._begin()
        if self.out is not None:
            self._end()
        return self.done


def write_archives(rows: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", roll: int = ROLL_BYTES) -> DataFrame:
    """Writes the rows of `with_revisits` as archives into `folder`; the stored manifest `path, records, bytes`."""
    out = arrow_schema("path string, records long, bytes long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        writer = Writer(folder, f"part-{task.partitionId():05d}-{task.taskAttemptId()}", roll)
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                writer.add(record(*row, date))
        done = writer.finish()
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done) if done else [[]] * 3, out)], schema=out)

    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "200")
    target, root = fs.FileSystem.from_uri(folder)
    target.create_dir(root, recursive=True)
    columns = rows.select("page_id", "url", "payload", "payload_digest", "refers_to")
    return spool(columns.mapInArrow(run, "path string, records long, bytes long"), "manifest")


class Source:
    """Bytes of a stream, with pushing back of what was read too far."""

    def __init__(self, stream) -> None:
        self.stream, self.rest, self.at = stream, b"", 0

    def take(self, n: int) -> bytes:
        while len(self.rest) < n and (more := self.stream.read(max(CHUNK, n - len(self.rest)))):
            self.rest += more
        data, self.rest = self.rest[:n], self.rest[n:]
        self.at += len(data)
        return data

    def push(self, data: bytes) -> None:
        self.rest = data + self.rest
        self.at -= len(data)


def frames(stream) -> Iterator[tuple[int, bytes, str | None]]:
    """`(offset, decoded frame, problem)`, skippable frames aside; the first of them may hold the dictionary."""
    source, trained = Source(stream), None
    while head := source.take(4):
        at = source.at - 4 if len(head) == 4 else source.at - len(head)
        magic = int.from_bytes(head, "little")
        if len(head) == 4 and magic & 0xFFFFFFF0 == 0x184D2A50:
            size = int.from_bytes(source.take(4), "little")
            body = source.take(size)
            if len(body) < size:
                yield at, b"", "archive ends within a frame"
                return
            if magic == DICTIONARY_FRAME and at == 0:
                if body[:4] == ZSTD_FRAME.to_bytes(4, "little"):
                    try:
                        body = zstd.ZstdDecompressor().decompressobj().decompress(body)
                    except zstd.ZstdError:
                        yield at, b"", "dictionary does not decode"
                        return
                trained = zstd.ZstdCompressionDict(body)
            continue
        source.push(head)
        decoder = zstd.ZstdDecompressor(dict_data=trained).decompressobj()
        parts = []
        try:
            while not decoder.eof and (data := source.take(CHUNK)):
                parts.append(decoder.decompress(data))
        except zstd.ZstdError:
            yield at, b"".join(parts), "frame does not decode"
            return
        if not decoder.eof:
            yield at, b"".join(parts), "archive ends within a frame"
            return
        source.push(decoder.unused_data)
        yield at, b"".join(parts), None


def parse_record(data: bytes) -> tuple[dict[str, str], bytes, str | None]:
    """Header fields in lower case, block and the first broken rule."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not mark:
        return {}, b"", "header does not end"
    if not re.fullmatch(r"WARC/1\.[01]", first):
        return {}, b"", "no WARC version"
    fields: dict[str, str] = {}
    last = None
    for line in lines:
        if line[:1] in (" ", "\t") and last:
            fields[last] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        if not colon or not _FIELD.fullmatch(name):
            return fields, b"", "malformed header"
        last = name.lower()
        fields[last] = value.strip()
    for name in MANDATORY:
        if name not in fields:
            return fields, b"", f"no {name}"
    if not re.fullmatch(r"[0-9]{1,18}", fields["content-length"]):
        return fields, b"", "malformed content-length"
    length = int(fields["content-length"])
    block, end = rest[:length], rest[length:]
    if len(block) < length or end != b"\r\n\r\n":
        return fields, block, "length does not match the frame"
    return fields, block, None


def _sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def read_record(data: bytes, problem: str | None) -> dict:
    """Columns of `read_archives` for a decoded frame."""
    fields, block, broken = parse_record(data) if problem is None else ({}, b"", problem)
    out = {
        "record_type": fields.get("warc-type"),
        "record_id": fields.get("warc-record-id"),
        "url": fields.get("warc-target-uri"),
        "refers_to_id": fields.get("warc-refers-to"),
        "payload": None,
        "payload_bytes": None,
        "payload_digest": None,
        "problem": broken,
    }
    if broken:
        return out
    if fields.get("warc-block-digest", "sha1:" + _sha1(block)) != "sha1:" + _sha1(block):
        return out | {"problem": "block digest does not match"}
    payload, named = block, fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    length = len(block)
    if fields.get("content-type", "").startswith("application/http"):
        head, mark, payload = block.partition(b"\r\n\r\n")
        sizes = [v for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:]) if k.lower() == b"content-length"]
        length = int(sizes[0]) if sizes and sizes[0].strip().isdigit() else len(payload)
        if not mark or (out["record_type"] != "revisit" and length != len(payload)):
            return out | {"problem": "HTTP length does not match"}
    if out["record_type"] == "revisit":
        return out | {"payload_bytes": length, "payload_digest": named}
    if named and named != _sha1(payload):
        return out | {"problem": "payload digest does not match"}
    return out | {"payload": payload, "payload_bytes": len(payload), "payload_digest": _sha1(payload)}


RECORD = "path string, offset long, record_type string, record_id string, url string, refers_to_id string, payload binary, payload_bytes long, payload_digest string, problem string"


def read_archives(paths: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the archives named in column `path`; payloads are null if not asked for."""
    out = arrow_schema(RECORD)

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in rows], f.type) for f in out], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, name = fs.FileSystem.from_uri(path)
                rows, held = [], 0
                with files.open_input_stream(name, compression=None) as stream:
                    for offset, data, problem in frames(stream):
                        row = {"path": path, "offset": offset} | read_record(data, problem)
                        if not payloads:
                            row["payload"] = None
                        rows.append(row)
                        held += len(row["payload"] or b"") + 500
                        if held >= SAMPLE_BYTES:
                            yield batch_of(rows)
                            rows, held = [], 0
                yield batch_of(rows)

    names = paths.filter("path IS NOT NULL").select("path")
    return names.repartition(max(1, names.count())).mapInArrow(run, RECORD)


def _page_id(column: str) -> Column:
    return F.expr(f"try_cast(nullif(regexp_extract({column}, '^<urn:page:(-?[0-9]+)>$', 1), '') AS bigint)")


def archived_pages(pages: DataFrame) -> DataFrame:
    """Writes the pages, reads the archives back and returns a row for each record."""
    folder = new_path(pages.sparkSession, "warc")
    back = read_archives(write_archives(with_revisits(pages), folder), payloads=False)
    return back.select(
        _page_id("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        _page_id("refers_to_id").alias("refers_to"),
        "problem",
    )
