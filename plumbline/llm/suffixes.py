"""Removal of repeated byte strings with suffix arrays.

A byte goes if a string of LENGTH bytes that covers it also starts earlier: in a
smaller doc_id, or before in the same document. Strings are judged on the input.

1. Each string is keyed by the smallest hash of the GRAM-byte pieces in it, so equal
   strings have equal keys. Consecutive strings with one key form a run.
2. Runs meet by key. Of equal runs, all but the first go whole, within a
   batch already, so that what is copied often is sent once for each batch.
   Runs that share their key with a different run are fetched as text, and so
   are those in which a string may come twice.
3. The runs of a key are laid end to end and their suffixes sorted; strings that are equal
   stand beside each other, and all but the earliest go. Keys with more than
   HOT_RUNS different runs are not gathered: their strings are told apart by hash, and
   only the first place of each in a batch of documents is grouped, as a row.

The suffix array is built by grouping: suffixes are grouped by their Lyndon
prefixes, the groups are taken in descending order and lengthen the groups of the
previous smaller suffixes, and the order within the groups is then emitted from
the smallest suffix on. Nothing is renamed or solved recursively.

Null text has no bytes. Rows without an id come after all others. Rows that share
an id count as one document: strings at equal starts are not earlier than each other.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.frames import arrow_schema, map_rows
from plumbline.session import spool

LENGTH = 100
GRAM = 32
# Most strings that one place of the smallest hash can cover; repetitive texts have longer runs.
RUN = LENGTH - GRAM + 1
HOT_RUNS = 256
# Groups of so few runs are first tested for having anything in common.
FEW = 6
BUCKET_BYTES = 8_000_000
LAST = (1 << 63) - 1
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
PARTS = "doc_id long, code long, kind int, data binary"


def suffix_array(text: list[int]) -> list[int]:
    """Order of the suffixes of a sequence of small whole numbers."""
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    place, group, end = [0] * n, [0] * n, {}
    start = 0
    for i, s in enumerate(order):
        if text[s] != text[order[start]]:
            start = i
        place[s], group[s], end[start] = i, start, i
    previous = [-1] * n
    top = n - 1
    # Descending: each group in turn lengthens the groups of the previous smaller suffixes.
    while top >= 0:
        g = group[order[top]]
        members = sorted(order[g : top + 1]) if top > g else (order[g],)
        counts: dict[int, int] = {}
        for s in members:
            p = s - 1
            while p >= 0 and group[p] >= g:
                p = previous[p]
            previous[s] = p
            if p >= 0:
                counts[p] = counts.get(p, 0) + 1
        top = g - 1
        if not counts:
            continue
        # Those followed by more repeats of the group come later; they leave the end of their old group first.
        by_count: dict[int, list[int]] = {}
        for p, c in counts.items():
            by_count.setdefault(c, []).append(p)
        for c in sorted(by_count, reverse=True):
            moved: dict[int, int] = {}
            for p in by_count[c]:
                old = group[p]
                last = end[old] - moved.get(old, 0)
                other, at = order[last], place[p]
                order[at], place[other] = other, at
                order[last], place[p] = p, last
                moved[old] = moved.get(old, 0) + 1
            for old, k in moved.items():
                first, last = end[old] - k + 1, end[old]
                if first > old:
                    end[old], end[first] = first - 1, last
                    for i in range(first, last + 1):
                        group[order[i]] = first
    # Ascending: what stands before a suffix is next in its own group, and so along the previous smaller ones.
    out, free, placed = [0] * n, {}, bytearray(n)
    for i in range(-1, n):
        p = (n if i < 0 else out[i]) - 1
        while p >= 0 and not placed[p]:
            g = group[p]
            at = free.get(g, g)
            out[at], free[g], placed[p] = p, at + 1, 1
            p = previous[p]
    return out


def keys_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Key of each string of LENGTH bytes, the smallest mixed hash of its pieces; and where such a piece comes again.

    A string is marked if its first piece has its key and so has a later one. In a run
    that holds a string twice, at most RUN - 1 bytes apart, one of its strings is marked.
    """
    h = (data.astype(np.uint64) + np.uint64(1)) * _MIX
    size, power = 1, _BASE
    with np.errstate(over="ignore"):
        while size < GRAM:
            h = h[:-size] * power + h[size:]
            power, size = power * power, 2 * size
        h ^= h >> np.uint64(31)
        h *= _MIX
        h ^= h >> np.uint64(29)
    width, span, pieces = LENGTH - GRAM + 1, 1, h
    while 2 * span <= width:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    keys = np.minimum(h[: len(h) - (width - span)], h[width - span :]) if width > span else h
    again = np.append((pieces[: len(keys) - 1] == keys[:-1]) & (keys[1:] == keys[:-1]), False)
    return keys, again


def runs_of(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """Key, hash of the text, start and number of strings of each run of a document, and whether one may come twice in it."""
    none = np.zeros(0, np.uint64)
    if len(data) < LENGTH:
        return none, none, none.astype(np.int64), none.astype(np.int64), none.astype(bool)
    keys, again = keys_of(data)
    new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    counts = np.diff(np.append(new, len(keys)))
    if counts.max() > RUN:
        # Long runs are cut at fixed distances from their start.
        pieces = -(-counts // RUN)
        first = np.repeat(new, pieces)
        step = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        new = first + step * RUN
        counts = np.diff(np.append(new, len(keys)))
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(len(data), _BASE, np.uint64))
        sums = np.append(np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers))
        # The hash does not depend on where the run stands: shifted to a common power.
        h = (sums[new + counts + LENGTH - 1] - sums[new]) * _inverse_powers(len(data))[new]
    return keys[new], h ^ (counts.astype(np.uint64) << np.uint64(56)), new, counts, np.logical_or.reduceat(again, new)


_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_inverses = np.ones(1, np.uint64)


def _inverse_powers(n: int) -> np.ndarray:
    global _inverses
    if len(_inverses) < n:
        size = max(n, 2 * len(_inverses))
        with np.errstate(over="ignore"):
            _inverses = np.cumprod(np.append(np.uint64(1), np.full(size - 1, _INVERSE, np.uint64)))
    return _inverses


def _spans(starts: np.ndarray, counts: np.ndarray) -> bytes:
    return np.stack([starts, starts + counts + LENGTH - 1], axis=1).astype(np.int64).tobytes()


def _by_document(ids: np.ndarray, codes: np.ndarray, rows: list[np.ndarray]) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """Rows of each document, put together."""
    order = np.lexsort((codes, ids))
    ids, codes, rows = ids[order], codes[order], [r[order] for r in rows]
    cuts = np.flatnonzero((ids[1:] != ids[:-1]) | (codes[1:] != codes[:-1])) + 1 if len(ids) else []
    heads = np.append(0, cuts).astype(int) if len(ids) else []
    for at, part in zip(heads, zip(*(np.split(r, cuts) for r in rows))):
        yield int(ids[at]), int(codes[at]), list(part)


REMOVE, FETCH, FETCH_HOT = 0, 1, 2


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Keys are smallest hashes and so lie low; they are mixed again to spread them evenly."""
    mixed = (keys ^ (keys >> np.uint64(32))) * _MIX
    return ((mixed >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def sent_runs(docs: DataFrame, buckets: int) -> DataFrame:
    """`bucket, doc_id, code, data`: first runs of each batch by bucket of their key; what goes already, in buckets below 0."""

    def make():
        def run(batch):
            out = {k: [] for k in ("bucket", "doc_id", "code", "data")}
            order = sorted(range(len(batch["doc_id"])), key=lambda i: batch["doc_id"][i])
            parts, ids, codes = [], [], []
            for i in order:
                found = runs_of(np.frombuffer((batch["text"][i] or "").encode("utf-8", "replace"), np.uint8))
                if len(found[0]):
                    parts.append(found)
                    ids.append(np.full(len(found[0]), batch["doc_id"][i], np.int64))
                    codes.append(np.full(len(found[0]), batch["code"][i], np.int64))
            if not parts:
                return out
            keys, hashes, starts, counts, twice = map(np.concatenate, zip(*parts))
            ids, codes = np.concatenate(ids), np.concatenate(codes)
            first, gone = _firsts(keys, hashes, ids, starts)
            for doc_id, code, (s, c) in _by_document(ids[gone], codes[gone], [starts[gone], counts[gone]]):
                for k, v in zip(out, (-1 - doc_id % buckets, doc_id, code, _spans(s, c))):
                    out[k].append(v)
            place = bucket_of(keys[first], buckets)
            rank = np.argsort(place, kind="stable")
            first, place = first[rank], place[rank]
            cuts = np.flatnonzero(np.diff(place)) + 1
            for at, part in zip(np.append(0, cuts).tolist(), np.split(first, cuts)):
                packed = packed_runs(*(x[part] for x in (keys, hashes, ids, codes, starts, counts, twice)))
                for k, v in zip(out, (int(place[at]), 0, 0, packed)):
                    out[k].append(v)
            return out

        return run

    return map_rows(docs, make, "bucket int, doc_id long, code long, data binary")


def packed_runs(keys, hashes, ids, codes, starts, counts, twice) -> bytes:
    """Columns laid end to end; ids once for each document."""
    new = np.append(True, (ids[1:] != ids[:-1]) | (codes[1:] != codes[:-1]))
    each = np.diff(np.append(np.flatnonzero(new), len(ids))).astype(np.uint32)
    head = np.array([len(keys), len(each)], np.uint32)
    columns = (head, keys, hashes, ids[new], codes[new], each, starts.astype(np.uint32), counts.astype(np.uint8), twice)
    return b"".join(c.tobytes() for c in columns)


def unpacked_runs(data: bytes) -> tuple[np.ndarray, ...]:
    n, docs = np.frombuffer(data, np.uint32, 2).tolist()
    at, out = 8, []
    for kind, size in ((np.uint64, n), (np.uint64, n), (np.int64, docs), (np.int64, docs), (np.uint32, docs), (np.uint32, n), (np.uint8, n), (bool, n)):
        out.append(np.frombuffer(data, kind, size, at))
        at += out[-1].nbytes
    keys, hashes, ids, codes, each, starts, counts, twice = out
    return keys, hashes, np.repeat(ids, each), np.repeat(codes, each), starts.astype(np.int64), counts.astype(np.int64), twice


def _firsts(keys, hashes, ids, starts) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the first of equal runs, and of those that stand later."""
    order = np.lexsort((starts, ids, hashes, keys))
    k, h, i, s = keys[order], hashes[order], ids[order], starts[order]
    new = np.append(True, (k[1:] != k[:-1]) | (h[1:] != h[:-1]))
    head = np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))
    same = (i == i[head]) & (s == s[head])
    return np.sort(order[same]), order[~same]


def met_runs(sent: DataFrame, buckets: int) -> DataFrame:
    """`doc_id, code, kind, data`: spans to remove, and runs to fetch as key, start and number of strings."""
    out = arrow_schema(PARTS)

    def run(table: pa.Table) -> pa.Table:
        rows = []
        if table.column("bucket")[0].as_py() < 0:
            for doc_id, code, data in zip(*(table.column(c).to_pylist() for c in ("doc_id", "code", "data"))):
                rows.append((doc_id, code, REMOVE, data))
        else:
            columns = zip(*map(unpacked_runs, table.column("data").to_pylist()))
            keys, hashes, ids, codes, starts, counts, twice = map(np.concatenate, columns)
            first, gone = _firsts(keys, hashes, ids, starts)
            for doc_id, code, (s, c) in _by_document(ids[gone], codes[gone], [starts[gone], counts[gone]]):
                rows.append((doc_id, code, REMOVE, _spans(s, c)))
            keys, ids, codes, starts, counts, twice = (x[first] for x in (keys, ids, codes, starts, counts, twice))
            _, which, times = np.unique(keys, return_inverse=True, return_counts=True)
            times = times[which]
            for kind, chosen in ((FETCH, ((times > 1) | twice) & (times <= HOT_RUNS)), (FETCH_HOT, times > HOT_RUNS)):
                for doc_id, code, (k, s, c) in _by_document(ids[chosen], codes[chosen], [keys[chosen], starts[chosen], counts[chosen]]):
                    rows.append((doc_id, code, kind, np.stack([k.view(np.int64), s, c], axis=1).tobytes()))
        columns = zip(*rows) if rows else [[]] * 4
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    return sent.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(run, PARTS)


# What a fetched row holds: a run to sort, a string's first place in a batch, or spans to remove.
SORT, FIRST, GONE = 0, 1, 2


def fetched(docs: DataFrame, parts: DataFrame, buckets: int) -> DataFrame:
    """`bucket, key, doc_id, code, start, text, kind` of the runs to fetch.

    Strings of hot keys are told apart by hash. Where one stands earlier in the
    batch as well, it is to be removed for sure; only the first place in a batch goes on.
    """
    asked = parts.filter(F.col("kind") != REMOVE).groupBy("doc_id", "code").agg(F.collect_list(F.struct("kind", "data")).alias("asked"))
    both = docs.join(asked, ["doc_id", "code"])

    def make():
        def run(batch):
            out = {k: [] for k in ("bucket", "key", "doc_id", "code", "start", "text", "kind")}

            def add(*row):
                for k, v in zip(out, row):
                    out[k].append(v)

            hot: list[tuple[bytes, int, int, int]] = []
            for doc_id, code, text, asked in zip(*(batch[k] for k in ("doc_id", "code", "text", "asked"))):
                data = text.encode("utf-8", "replace")
                for part in asked:
                    runs = np.frombuffer(part["data"], np.int64).reshape(-1, 3)
                    if part["kind"] == FETCH_HOT:
                        for _, start, count in runs.tolist():
                            strings = (hashlib.blake2b(data[s : s + LENGTH], digest_size=16).digest() for s in range(start, start + count))
                            hot += zip(strings, itertools.repeat(doc_id), range(start, start + count), itertools.repeat(code))
                        continue
                    for place, (key, start, count) in zip(bucket_of(runs[:, 0].view(np.uint64), buckets).tolist(), runs.tolist()):
                        add(place, key, doc_id, code, start, data[start : start + count + LENGTH - 1], SORT)
            first: dict[bytes, tuple[int, int]] = {}
            for string, doc_id, start, _ in hot:
                if (doc_id, start) <= first.get(string, (doc_id, start)):
                    first[string] = doc_id, start
            gone: dict[tuple[int, int], list[int]] = {}
            for string, doc_id, start, code in hot:
                if (doc_id, start) == first[string]:
                    add(0, 0, doc_id, code, start, string, FIRST)
                else:
                    gone.setdefault((doc_id, code), []).append(start)
            for (doc_id, code), starts in gone.items():
                add(0, 0, doc_id, code, 0, _spans(np.array(starts, np.int64), np.ones(len(starts), np.int64)), GONE)
            return out

        return run

    schema = "bucket int, key long, doc_id long, code long, start long, text binary, kind int"
    return map_rows(both, make, schema)


def anything_common(texts: list[bytes]) -> bool:
    """Whether two texts may share LENGTH bytes: half as many from a multiple of that place on would be in both."""
    half = LENGTH // 2
    for n, a in enumerate(texts):
        blocks = [a[i : i + half] for i in range(0, len(a) - half + 1, half)]
        if any(block in b for m, b in enumerate(texts) if m != n for block in blocks):
            return True
        # A text can also repeat within itself.
        if len(set(blocks)) < len(blocks) or any(block in a[i + 1 :] for i, block in zip(range(0, len(a), half), blocks)):
            return True
    return False


def shortened(texts: list[bytes]) -> list[tuple[int, int, int]]:
    """Stretches `(text, start, end)` around the strings whose hash comes more than once; equal strings are all within."""
    data = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64) + np.uint64(1)
    lengths = np.array([len(t) for t in texts])
    ends = np.cumsum(lengths)
    with np.errstate(over="ignore"):
        sums = np.append(np.uint64(0), np.cumsum(data * np.cumprod(np.full(len(data), _BASE, np.uint64))))
        at = np.flatnonzero(np.repeat(ends, lengths) - np.arange(len(data)) >= LENGTH)
        h = (sums[at + LENGTH] - sums[at]) * _inverse_powers(len(data))[at]
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    chosen = np.zeros(len(h), bool)
    chosen[order[1:][same]] = chosen[order[:-1][same]] = True
    at = at[chosen]
    if not len(at):
        return []
    owner = np.searchsorted(ends, at, side="right")
    cut = np.flatnonzero((np.diff(at) >= LENGTH) | (np.diff(owner) > 0))
    heads, tails = at[np.append(0, cut + 1)], at[np.append(cut, len(at) - 1)]
    owner = owner[np.append(0, cut + 1)]
    first = (ends - lengths)[owner]
    return list(zip(owner.tolist(), (heads - first).tolist(), (tails - first + LENGTH).tolist()))


def repeated_starts(texts: list[bytes], heads: list[tuple[int, int]]) -> list[list[int]]:
    """For runs of one key, with document and start of each: the offsets in each run of strings that also start earlier."""
    joined: list[int] = []
    firsts, owner = [], []
    for n, t in enumerate(texts):
        firsts.append(len(joined))
        joined.extend(b + 1 for b in t)
        joined.append(0)
        owner += [n] * (len(t) + 1)
    data = b"\0".join(texts) + b"\0"
    limit = [f + len(t) - LENGTH for f, t in zip(firsts, texts)]
    gone: list[list[int]] = [[] for _ in texts]
    group: list[int] = []

    def settle():
        if len(group) > 1:
            at = [(heads[owner[i]][0], heads[owner[i]][1] + i - firsts[owner[i]]) for i in group]
            least = min(at)
            for i, a in zip(group, at):
                if a > least:
                    gone[owner[i]].append(i - firsts[owner[i]])

    last = None
    for i in suffix_array(joined):
        if i > limit[owner[i]]:
            continue
        string = data[i : i + LENGTH]
        if string != last:
            settle()
            group.clear()
            last = string
        group.append(i)
    settle()
    return gone


def repeats(rows: DataFrame, buckets: int) -> DataFrame:
    """Spans to remove among fetched runs, as `doc_id, code, kind, data`."""
    out = arrow_schema(PARTS)

    def run(table: pa.Table) -> pa.Table:
        by_key: dict[int, list] = {}
        # Repeated rows of a document ask for the same runs.
        for row in set(zip(*(table.column(c).to_pylist() for c in ("key", "doc_id", "code", "start", "text")))):
            by_key.setdefault(row[0], []).append(row)
        found = []
        for members in by_key.values():
            if len(members) <= FEW and not anything_common([m[4] for m in members]):
                continue
            parts = shortened([m[4] for m in members])
            gone = repeated_starts([members[n][4][a:b] for n, a, b in parts], [(members[n][1], members[n][3] + a) for n, a, _ in parts])
            for (n, a, _), offsets in zip(parts, gone):
                if offsets:
                    _, doc_id, code, start, _ = members[n]
                    s = np.array(offsets, np.int64) + start + a
                    found.append((doc_id, code, REMOVE, _spans(s, np.ones(len(s), np.int64))))
        columns = zip(*found) if found else [[]] * 4
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    # Little data and much work: a number of partitions of its own keeps it spread.
    sorted_out = rows.filter(F.col("kind") == SORT).repartition(buckets, "bucket").groupBy("bucket").applyInArrow(run, PARTS)
    gone = rows.filter(F.col("kind") == GONE).select("doc_id", "code", F.lit(REMOVE).alias("kind"), F.col("text").alias("data"))
    hot = rows.filter(F.col("kind") == FIRST).select("text", "doc_id", "code", "start")
    first = hot.groupBy("text").agg(F.min(F.struct("doc_id", "start")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    later = hot.join(first, "text").filter(F.struct("doc_id", "start") > F.col("first"))
    starts = later.groupBy("doc_id", "code").agg(F.array_sort(F.collect_set("start")).alias("starts"))

    def make():
        def spans(batch):
            n = len(batch["starts"])
            data = [_spans(s := np.array(each, np.int64), np.ones(len(s), np.int64)) for each in batch["starts"]]
            return {"doc_id": batch["doc_id"], "code": batch["code"], "kind": [REMOVE] * n, "data": data}

        return spans

    return sorted_out.union(map_rows(starts, make, PARTS)).union(gone)


def spans_removed(df: DataFrame) -> DataFrame:
    """`doc_id, code, parts` of the documents that lose bytes; `code` is a hash of the text."""
    docs = df.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"), F.xxhash64("text").alias("code"), "text")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, -(-total // BUCKET_BYTES))
    parts = spool(met_runs(sent_runs(docs, buckets), buckets), "met")
    more = spool(repeats(spool(fetched(docs, parts, 4 * buckets), "runs"), buckets), "repeats")
    gone = parts.filter(F.col("kind") == REMOVE).union(more)
    return gone.groupBy("doc_id", "code").agg(F.collect_list("data").alias("parts"))


def merged(parts: list[bytes], n: int) -> list[tuple[int, int]]:
    """Disjoint spans, in order, that cover the given ones."""
    spans = np.concatenate([np.frombuffer(p, np.int64).reshape(-1, 2) for p in parts]) if parts else np.zeros((0, 2), np.int64)
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, spans[:, 0], 1)
    np.add.at(edges, spans[:, 1], -1)
    covered = np.cumsum(edges)[:n] > 0
    steps = np.flatnonzero(np.diff(np.concatenate([[0], covered.view(np.int8), [0]])))
    return list(zip(steps[::2].tolist(), steps[1::2].tolist()))


def _with_spans(df: DataFrame) -> DataFrame:
    """`_row` with all columns of `df`, and the parts of what its text loses."""
    gone = spans_removed(df).withColumnRenamed("doc_id", "_id")
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")
    rows = df.select(row, F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("_id"), F.xxhash64("text").alias("code"))
    return rows.join(gone, ["_id", "code"], "left").select("_row", "parts")


def _kept(text: str | None, parts: list[bytes] | None) -> tuple[bytes, int, int]:
    """Remaining bytes, number of bytes, number of removed spans."""
    data = (text or "").encode("utf-8", "replace")
    spans = merged([] if parts is None else list(parts), len(data))
    ends = [0, *(x for s in spans for x in s), len(data)]
    return b"".join(data[a:b] for a, b in zip(ends[::2], ends[1::2])), len(data), len(spans)


def deduplicated(df: DataFrame) -> DataFrame:
    """`doc_id, n_bytes, n_removed, n_spans, kept` of every row; `kept` holds the remaining bytes."""

    def make():
        def run(batch):
            found = [_kept(t, p) for t, p in zip(batch["text"], batch["parts"])]
            return {
                "doc_id": batch["doc_id"],
                "n_bytes": [n for _, n, _ in found],
                "n_removed": [n - len(k) for k, n, _ in found],
                "n_spans": [s for _, _, s in found],
                "kept": [k for k, _, _ in found],
            }

        return run

    rows = _with_spans(df).select(F.col("_row.doc_id").cast("long").alias("doc_id"), "_row.text", "parts")
    return map_rows(rows, make, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def remaining_texts(df: DataFrame) -> DataFrame:
    """The rows of `df` with what remains of their text, and `n_chars`, if there, of its length.

    Bytes of a character that was cut are left out. Rows that lose all their text go.
    """

    @F.pandas_udf("string")
    def rest(texts, parts):
        import pandas as pd

        return pd.Series([_kept(t, p)[0].decode("utf-8", "ignore") for t, p in zip(texts, parts)], dtype=object)

    rows = _with_spans(df)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "200")
    text = F.when(F.col("parts").isNull(), F.col("_row.text")).otherwise(rest(F.col("_row.text"), F.col("parts")))
    rows = rows.withColumn("_text", text).filter("parts IS NULL OR trim(_text) <> ''")
    changed = {"text": F.col("_text")}
    if "n_chars" in df.columns:
        changed["n_chars"] = F.when(F.col("parts").isNull(), F.col("_row.n_chars")).otherwise(F.length("_text").cast("long"))
    return rows.select(*[changed[c].alias(c) if c in changed else F.col(f"_row.`{c}`").alias(c) for c in df.columns])


def removal_digests(df: DataFrame) -> DataFrame:
    out = deduplicated(df)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
