"""How far the sources of a language stand apart, from term counts by chunk factorization.

Terms are runs of letters, A-Z in lower case, and of characters beyond ASCII; they
never cross white space, so a text's terms are those of its white-space chunks:

1. Chunks are counted for each document, in blocks of whole documents. A block's
   different chunks go out by hash, a packed row for each bucket of them; its
   documents and counts by chunk stay with the block.
2. In a bucket every globally distinct chunk is tokenized once.
3. The terms are joined back to the blocks, which list their chunks in the same
   order. Each block, being whole documents, gives the number of distinct documents
   and of occurrences of each term by language and source, packed by buckets of
   terms. Sums over blocks, MERGED at a time, are the counts of the corpus.

Each language keeps the terms of at least `least` of its documents. With count c of
N occurrences of V kept terms, a term's share is 1 + floor(10^9 (c+5) / (N+5V));
two sources differ by the sum of the absolute differences of all shares.

Bounds: a block holds BLOCK_BYTES of text or one longer document; differences are
taken over blocks of about CELLS sources times terms, for SOURCES sources at a time.
Every arithmetic step is in whole numbers. Hot sources and languages are spread, as
blocks and terms are the keys.

Null text, language and source count as empty; documents without terms still make
their language and source a group. Repeated rows are documents each. An empty table
gives no rows; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import itertools
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.llm.frames import arrow_schema
from plumbline.session import spool

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
BLOCK_BYTES = 8 << 20
BLOCK_DOCUMENTS = 1 << 20
# Text for each bucket of chunks and of terms; blocks whose counts a task adds up.
BUCKET_BYTES = 12 << 20
MERGED = 256
CELLS = 1 << 17
SOURCES = 512
SCALE = 1_000_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Packed blocks and what their buckets of chunks send back; a posting holds a document's place in its block and, in its
# lowest byte, a count of 1 to 255; larger counts take several.
BLOCKS = "block long, bucket int, text binary, firsts binary, postings binary, groups binary, info string"
# Packed counts of the terms of a bucket: how many entries each term has, and of each its group, documents and occurrences.
COUNTS = "bucket int, part int, text binary, sizes binary, groups binary, docs binary, n binary, info string"
KEPT = "lang string, source string, term string, n long, total long"


def squeezed(data: bytes) -> bytes:
    """What a packed cell holds; both exchanges and stored tables are mostly such cells."""
    return zstandard.compress(data, 1)


loose = zstandard.decompress


def bucket_of(words: list[bytes], buckets: int) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets


def postings(texts: list[bytes], buckets: int) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Different chunks of the texts by bucket, their buckets, the place of each chunk's first posting, and all postings."""
    split = [t.split() for t in texts]
    words = list(itertools.chain.from_iterable(split))
    chunks = list(set(words))
    place = bucket_of(chunks, buckets)
    order = np.argsort(place, kind="stable")
    chunks, place = [chunks[i] for i in order.tolist()], place[order]
    code = dict(zip(chunks, range(len(chunks))))
    codes = np.fromiter(map(code.__getitem__, words), np.int64, len(words))
    docs = np.repeat(np.arange(len(texts)), [len(s) for s in split])
    keys, counts = np.unique(codes * len(texts) + docs, return_counts=True)
    codes, docs = keys // len(texts), keys % len(texts)
    times = -(-counts // 255)
    codes, docs = np.repeat(codes, times), np.repeat(docs, times)
    held = np.full(len(codes), 255)
    held[np.cumsum(times) - 1] = counts - 255 * (times - 1)
    firsts = np.searchsorted(codes, np.arange(len(chunks) + 1))
    return chunks, place, firsts.astype(np.uint32), (docs << 8 | held).astype(np.uint32)


def _cuts(place: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Bucket, first and end of each run of equal buckets."""
    new = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(place) else np.zeros(0, np.int64)
    return zip(place[new].tolist(), new.tolist(), np.append(new[1:], len(place)).tolist())


def block_rows(block: int, held: list[tuple[str, str, bytes]], buckets: int) -> list[tuple]:
    """A row for the block, with its postings and the language and source of each document, and one for each bucket of chunks."""
    held.sort(key=lambda r: r[:2])
    groups = list(dict.fromkeys(r[:2] for r in held))
    number = {g: i for i, g in enumerate(groups)}
    of = np.array([number[r[:2]] for r in held], np.uint32)
    chunks, place, firsts, packed = postings([r[2] for r in held], buckets)
    rows = [(block, -1, None, *map(squeezed, (firsts.tobytes(), packed.tobytes(), of.tobytes())), json.dumps(groups))]
    return rows + [(block, b, squeezed(b" ".join(chunks[i:j])), None, None, None, None) for b, i, j in _cuts(place)]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def packed_blocks(df: DataFrame, buckets: int) -> DataFrame:
    """The stored rows of `block_rows` over `lang, source, text`."""
    schema = arrow_schema(BLOCKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        held: list[tuple[str, str, bytes]] = []
        size = done = 0
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                for lang, source, text in zip(*(c.to_pylist() for c in batch.slice(start, 200).columns)):
                    held.append((lang, source, text.encode("utf-8", "replace")))
                    size += len(held[-1][2])
                    if size >= BLOCK_BYTES or len(held) >= BLOCK_DOCUMENTS:
                        yield _batch(block_rows(first + done, held, buckets), schema)
                        held, size, done = [], 0, done + 1
        if held:
            yield _batch(block_rows(first + done, held, buckets), schema)

    return spool(df.mapInArrow(run, BLOCKS), "blocks")


_FIND = re.compile(TERM.encode("latin-1")).findall
_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def tokenized(blocks: DataFrame, buckets: int) -> DataFrame:
    """For each block and bucket the terms of its chunks, in their order, in the columns of `BLOCKS`; a chunk is tokenized once."""
    schema = arrow_schema(BLOCKS)

    def run(table: pa.Table) -> pa.Table:
        known: dict[bytes, bytes] = {}
        rows = []
        for block, bucket, text in zip(*(table.column(c) for c in ("block", "bucket", "text"))):
            chunks = loose(text.as_py()).split(b" ")
            for chunk in set(chunks).difference(known):
                known[chunk] = b" ".join(_FIND(chunk.translate(_LOWER)))
            terms = b"\n".join(map(known.__getitem__, chunks))
            rows.append((block.as_py(), bucket.as_py(), squeezed(terms), None, None, None, None))
        return pa.Table.from_batches([_batch(rows, schema)])

    chunks = blocks.filter("bucket >= 0").repartition(buckets, "bucket")
    return chunks.groupBy("bucket").applyInArrow(run, BLOCKS)


def _narrow(values: np.ndarray) -> bytes:
    return squeezed(values.astype(np.uint32 if values.max(initial=0) < 1 << 32 else np.uint64).tobytes())


def _wide(data: bytes, n: int) -> np.ndarray:
    data = loose(data)
    return np.frombuffer(data, np.uint32 if len(data) == 4 * n else np.uint64).astype(np.int64)


def count_rows(part: int, terms: list[bytes], place: np.ndarray, term: np.ndarray, group: np.ndarray, docs: np.ndarray, n: np.ndarray, groups: list) -> list[tuple]:
    """Packed rows by bucket of counts by term and group; terms are in the order of their buckets, entries in that of the terms."""
    firsts = np.searchsorted(term, np.arange(len(terms) + 1))
    rows = []
    for b, i, j in _cuts(place):
        at = slice(firsts[i], firsts[j])
        used, local = np.unique(group[at], return_inverse=True)
        packed = (np.diff(firsts[i : j + 1]), local, docs[at], n[at])
        rows.append((b, part, squeezed(b" ".join(terms[i:j])), *map(_narrow, packed), json.dumps([groups[g] for g in used.tolist()])))
    return rows


def block_counts(table: pa.Table, buckets: int, parts: int) -> list[tuple]:
    """Distinct documents and occurrences of each term of a block, by language and source."""
    rows = sorted(table.to_pylist(), key=lambda r: r["bucket"])
    head, replies = rows[0], rows[1:]
    if not replies:
        return []
    groups = json.loads(head["info"])
    of, firsts, packed = (np.frombuffer(loose(head[c]), np.uint32) for c in ("groups", "firsts", "postings"))
    of, firsts = of.astype(np.int64), firsts.astype(np.int64)
    lines = b"\n".join(loose(r["text"]) for r in replies).split(b"\n")
    times = np.fromiter((line.count(b" ") + 1 if line else 0 for line in lines), np.int64, len(lines))
    words = b" ".join(filter(None, lines)).split()
    terms = list(set(words))
    if not terms:
        return []
    place = bucket_of(terms, buckets)
    order = np.argsort(place, kind="stable")
    terms, place = [terms[i] for i in order.tolist()], place[order]
    code = dict(zip(terms, range(len(terms))))
    # The postings of a chunk, once for each term in it.
    row = np.repeat(np.arange(len(lines)), times)
    each = np.diff(firsts)[row]
    at = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each) + np.repeat(firsts[row], each)
    found = packed[at].astype(np.int64)
    keys = np.repeat(np.fromiter(map(code.__getitem__, words), np.int64, len(words)), each) * len(of) + (found >> 8)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], found[order] & 255
    new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    keys, counts = keys[new], np.add.reduceat(counts, new)
    # Documents stand in the order of their groups.
    term, group = keys // len(of), of[keys % len(of)]
    new = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (group[1:] != group[:-1])))
    docs, n = np.diff(np.append(new, len(keys))), np.add.reduceat(counts, new)
    return count_rows(zlib.crc32(str(head["block"]).encode()) % parts, terms, place, term[new], group[new], docs, n, groups)


def merged_counts(table: pa.Table) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray, list]:
    """Sums over packed rows of one bucket: terms, and by term and group the documents and occurrences."""
    code: dict[bytes, int] = {}
    groups: dict[tuple, int] = {}
    columns: list[list[np.ndarray]] = [[], [], [], []]
    for r in table.to_pylist():
        words = loose(r["text"]).split(b" ")
        sizes = _wide(r["sizes"], len(words))
        n = int(sizes.sum())
        names = np.array([groups.setdefault(tuple(g), len(groups)) for g in json.loads(r["info"])])
        codes = np.fromiter((code.setdefault(w, len(code)) for w in words), np.int64, len(words))
        for column, values in zip(columns, (np.repeat(codes, sizes), names[_wide(r["groups"], n)], _wide(r["docs"], n), _wide(r["n"], n))):
            column.append(values)
    term, group, docs, n = map(np.concatenate, columns)
    order = np.lexsort((group, term))
    term, group = term[order], group[order]
    new = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (group[1:] != group[:-1])))
    return list(code), term[new], group[new], np.add.reduceat(docs[order], new), np.add.reduceat(n[order], new), list(groups)


def kept_rows(table: pa.Table, least: int, schema: pa.Schema) -> pa.Table:
    """The kept terms of a bucket: occurrences in each source, and in the language."""
    terms, term, group, docs, n, groups = merged_counts(table)
    langs = {lang: i for i, lang in enumerate(dict.fromkeys(g[0] for g in groups))}
    key = term * len(langs) + np.array([langs[g[0]] for g in groups])[group]
    _, which = np.unique(key, return_inverse=True)
    met, total = np.zeros(which.max() + 1, np.int64), np.zeros(which.max() + 1, np.int64)
    np.add.at(met, which, docs)
    np.add.at(total, which, n)
    keep = np.flatnonzero(met[which] >= least)
    names = [[groups[g][i] for g in group[keep].tolist()] for i in (0, 1)]
    shown = [terms[t].decode() for t in term[keep].tolist()]
    columns = [*names, shown, n[keep], total[which[keep]]]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def kept_counts(df: DataFrame, least: int) -> DataFrame:
    """`lang, source, term, n, total`: occurrences of the kept terms in a source that has them, and in the language; stored."""
    size = df.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets, parts = max(8, -(-size // BUCKET_BYTES)), max(1, -(-size // (BLOCK_BYTES * MERGED)))
    blocks = packed_blocks(df, buckets)
    both = blocks.filter("bucket < 0").union(tokenized(blocks, buckets))
    schema, kept = arrow_schema(COUNTS), arrow_schema(KEPT)

    def counts(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_batch(block_counts(table, buckets, parts), schema)])

    def merge(table: pa.Table) -> pa.Table:
        bucket, part = (table.column(c)[0].as_py() for c in ("bucket", "part"))
        terms, *entries, groups = merged_counts(table)
        return pa.Table.from_batches([_batch(count_rows(part // MERGED, terms, np.full(len(terms), bucket), *entries, groups), schema)])

    found = both.groupBy("block").applyInArrow(counts, COUNTS)
    # A task merges about MERGED rows of a bucket, however many blocks there are.
    while parts > 1:
        found, parts = spool(found.groupBy("bucket", "part").applyInArrow(merge, COUNTS), "counts"), -(-parts // MERGED)
    found = found.drop("part").repartition(buckets, "bucket")
    return spool(found.groupBy("bucket").applyInArrow(lambda table: kept_rows(table, least, kept), KEPT), "kept")


def _share(count: str, total: str) -> str:
    """Exact share of `count` among `total` occurrences of `v` terms."""
    return f"CAST(1 + (CAST({SCALE} AS DECIMAL(20,0)) * ({count} + 5)) div ({total} + 5 * v) AS BIGINT)"


def _differences(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """`lang, source, item, value`: sums of absolute differences of the shares of any two sources of a language with kept terms."""
    sizes = groups.groupBy("lang").agg(F.count("*").alias("s"), F.max("v").alias("v")).agg(F.max("s"), F.max("v")).first()
    sources, terms = sizes[0] or 1, sizes[1] or 1
    columns = max(16, CELLS // sources)
    term_blocks, source_blocks = -(-terms // columns), -(-sources // SOURCES)
    place = F.pmod(F.xxhash64("term"), F.lit(term_blocks)).alias("tb")
    every = F.explode(F.sequence(F.lit(0), F.lit(source_blocks - 1))).alias("sb")
    base = groups.filter("v > 0").select("lang", "source", F.lit(None).cast("string").alias("term"), F.expr(_share("0", "own")).alias("p"))
    base = base.withColumn("tb", F.explode(F.sequence(F.lit(0), F.lit(term_blocks - 1)))).select("*", every)
    both = cells.select("lang", "source", "term", "p", place, every).select(base.columns).union(base)
    both = both.withColumn("mine", F.pmod(F.xxhash64("source"), F.lit(source_blocks)) == F.col("sb"))
    out = arrow_schema("lang string, source string, item string, value long")

    def run(table: pa.Table) -> pa.Table:
        heads = table.filter(pc.is_null(table.column("term")))
        rest = table.filter(pc.is_valid(table.column("term")))
        names, base = heads.column("source").to_pylist(), np.array(heads.column("p"), np.int64)
        number = {s: i for i, s in enumerate(names)}
        coded = rest.column("term").combine_chunks().dictionary_encode()
        shares = np.repeat(base[:, None], len(coded.dictionary), axis=1)
        shares[[number[s] for s in rest.column("source").to_pylist()], coded.indices.to_numpy()] = rest.column("p").to_numpy()
        mine = np.flatnonzero(heads.column("mine").to_numpy(zero_copy_only=False))
        values = [np.abs(shares - shares[i]).sum(axis=1) for i in mine]
        n = len(names)
        lang = pa.array([table.column("lang")[0].as_py()] * (n * len(mine)), pa.string())
        source = pa.array([names[i] for i in mine for _ in range(n)], pa.string())
        value = pa.array(np.concatenate(values) if values else [], pa.int64())
        return pa.table([lang, source, pa.array(names * len(mine), pa.string()), value], schema=out)

    made = both.groupBy("lang", "tb", "sb").applyInArrow(run, "lang string, source string, item string, value long")
    return made.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).filter("source <> item")


def divergence(df: DataFrame, least: int = 30, top: int = 50) -> DataFrame:
    """`lang, source, part, item, value, rank`: for each source its distance to every other (`pair`) and its `top` terms (`term`)."""
    docs = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    kept = kept_counts(docs, least)
    langs = kept.groupBy("lang").agg(F.count_distinct("term").alias("v"), F.sum("n").alias("all"))
    owns = kept.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    groups = docs.select("lang", "source").distinct().join(owns, ["lang", "source"], "left").join(langs, "lang", "left")
    zero = F.lit(0).cast("long")
    groups = spool(groups.select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("own", "v", "all")]), "groups")
    cells = kept.join(groups, ["lang", "source"]).withColumns({"p": F.expr(_share("n", "own")), "q": F.expr(_share("total", "all"))})
    own = W.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    rank = F.row_number().over(own).alias("rank")
    terms = cells.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    terms = terms.select("*", rank).filter(F.col("rank") <= top)
    others = groups.select("lang", F.col("source").alias("item"))
    pairs = groups.select("lang", "source").join(others, "lang").filter("source <> item")
    pairs = pairs.join(_differences(cells, groups), ["lang", "source", "item"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", zero).alias("value"))
    return pairs.select("*", rank).union(terms)
