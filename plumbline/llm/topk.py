"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are ranged by length, longest first, and cut into buckets of similar
length. A query starts with the k-th best product among the longest vectors as
its threshold. A bucket is left out for a query when even a parallel vector of
its greatest length would stay below the threshold; otherwise the threshold over
both lengths is the bucket's local cosine threshold. Where it is low, a bucket is
pruned by length alone; where it is high, by the interval in which a vector's
coordinate must lie along the query's largest one. What is left is verified by
exact products, and raises the threshold for the buckets that follow.

Groups of buckets meet blocks of queries, both of bounded size, in a cogrouped
join: vectors go out once for each block of queries, and queries once for each
group of vectors. Products are exact: in floating point where the lengths
show that no sum exceeds 2^53, in 64-bit integers otherwise.

Vectors that are null or hold null or non-finite components, and rows without an
id, take no part. Vectors of unequal dimensions are compared as if padded with zeros. Rows that share
the query's id are the query's own; other repeated rows are candidates each. Of query rows
with one id, that with the smallest vector asks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.llm.frames import arrow_schema
from plumbline.session import spool

BUCKET = 1024
# A bucket ends where vectors are shorter than this share of its longest, if it has LEAST_BUCKET.
SIMILAR, LEAST_BUCKET = 0.9, 128
GROUP_VECTORS = 16_384
BLOCK_QUERIES = 16_384
SEEDS = 2048
# Local cosine thresholds from which coordinates prune better than lengths.
COORDINATE_FROM = 0.5
TOGETHER = 256
SLACK = 1 - 1e-9
PACKED = "place int, ids binary, data binary, dims int"


def whole_numbers(df: DataFrame, scale: int = 1024) -> DataFrame:
    """`vec_id, v array<long>, length` of the rows that take part."""
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = df.filter(F.col("vec_id").isNotNull() & x.isNotNull() & F.coalesce(finite, F.lit(False)))
    v = F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double")).cast("long"))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    return rows.withColumn("length", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))))


def _packed(batches: Iterator[pa.RecordBatch], rows: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows of up to `rows` vectors each, in their order; `place` is the partition."""
    place = TaskContext.get().partitionId()
    ids: list[int] = []
    vectors: list[list[int]] = []

    def row():
        data = matrix(vectors)
        made = [[place], [np.array(ids, np.int64).tobytes()], [data.tobytes()], [data.shape[1]]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(made, schema)], schema=schema)

    for batch in batches:
        for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids.append(i)
            vectors.append(v)
            if len(ids) == rows:
                yield row()
                ids, vectors = [], []
    if ids:
        yield row()


def matrix(vectors: list[list[int]]) -> np.ndarray:
    dims = max(map(len, vectors), default=0)
    out = np.zeros((len(vectors), dims), np.int64)
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    return out


def unpacked(ids: bytes, data: bytes, dims: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    return ids, np.frombuffer(data, np.int64).reshape(len(ids), dims)


def products(a: np.ndarray, b: np.ndarray, a_length: float, b_length: float) -> np.ndarray:
    """Exact products of all rows of `a` with all of `b`."""
    dims = min(a.shape[1], b.shape[1])
    a, b = a[:, :dims], b[:, :dims]
    if a_length * b_length < 2**52:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def lengths_of(m: np.ndarray) -> np.ndarray:
    return np.sqrt((m.astype(np.float64) ** 2).sum(axis=1))


class Best:
    """The best candidates so far of each of some queries."""

    def __init__(self, ids: np.ndarray, k: int, floor: np.ndarray) -> None:
        self.ids, self.k = ids, k
        self.floor = floor.astype(np.float64)
        self.found: list[list[tuple[int, int]]] = [[] for _ in ids]

    def add(self, q: int, vec_ids: np.ndarray, scores: np.ndarray) -> None:
        keep = (scores >= self.floor[q]) & (vec_ids != self.ids[q])
        if not keep.any():
            return
        vec_ids, scores = vec_ids[keep], scores[keep]
        if len(scores) > self.k:
            top = np.lexsort((vec_ids, -scores))[: self.k]
            vec_ids, scores = vec_ids[top], scores[top]
        rows = sorted(self.found[q] + list(zip((-scores).tolist(), vec_ids.tolist())))[: self.k]
        self.found[q] = rows
        if len(rows) == self.k:
            self.floor[q] = max(self.floor[q], -rows[-1][0])


def buckets_of(ids: np.ndarray, data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, vectors and lengths of buckets of similar length, longest first."""
    lengths = lengths_of(data)
    order = np.argsort(-lengths, kind="stable")
    at = 0
    while at < len(order):
        top = lengths[order[at]]
        similar = int(np.searchsorted(-lengths[order], -SIMILAR * top, side="right"))
        end = min(at + BUCKET, max(similar, at + LEAST_BUCKET), len(order))
        part = order[at:end]
        yield ids[part], data[part], lengths[part]
        at = end


def search(queries: np.ndarray, best: Best, buckets: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
    """Runs queries through buckets, updating `best`."""
    q_lengths = lengths_of(queries)
    for ids, data, lengths in buckets:
        top = lengths[0]
        unit = None
        for start in range(0, len(queries), TOGETHER):
            rows = np.arange(start, min(start + TOGETHER, len(queries)))
            rows = rows[best.floor[rows] * SLACK <= q_lengths[rows] * top + 1e-6]
            if not len(rows):
                continue
            reach = q_lengths[rows] * top
            cosine = np.divide(best.floor[rows], reach, out=np.full(len(rows), -1.0), where=reach > 0) * SLACK
            by_coordinate = cosine >= COORDINATE_FROM
            plain = rows[~by_coordinate]
            if len(plain):
                # Length pruning: lengths fall, so what may still pass is a prefix.
                least = np.divide(best.floor[plain], q_lengths[plain], out=np.full(len(plain), -np.inf), where=q_lengths[plain] > 0)
                ends = np.searchsorted(-lengths, -(least * SLACK - 1e-6), side="right")
                end = int(ends.max())
                scores = products(queries[plain], data[:end], q_lengths[plain].max(), top)
                for q, s, e in zip(plain.tolist(), scores, ends.tolist()):
                    best.add(q, ids[:e], s[:e])
            if by_coordinate.any():
                if unit is None:
                    unit = data / np.maximum(lengths, 1e-12)[:, None]
                for q, c in zip(rows[by_coordinate].tolist(), np.minimum(cosine[by_coordinate], 1).tolist()):
                    x = queries[q] / q_lengths[q]
                    focus = int(np.abs(x).argmax())
                    if focus >= unit.shape[1]:
                        chosen = np.arange(len(ids))
                    else:
                        spread = np.sqrt(max(0.0, (1 - x[focus] ** 2) * (1 - c * c))) + 1e-9
                        low = x[focus] * c - spread if x[focus] > -c else -1.0
                        high = x[focus] * c + spread if x[focus] < c else 1.0
                        chosen = np.flatnonzero((unit[:, focus] >= low - 1e-9) & (unit[:, focus] <= high + 1e-9))
                    if len(chosen):
                        best.add(q, ids[chosen], products(queries[q : q + 1], data[chosen], q_lengths[q], top)[0])


def _ranged(df: DataFrame, rows: int, columns: list, packed: int) -> tuple[DataFrame, int]:
    parts = max(1, -(-df.count() // rows))
    dealt = df.repartitionByRange(parts, *columns).sortWithinPartitions(*columns).select("vec_id", "v")
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "200")
    schema = arrow_schema(PACKED)
    made = spool(dealt.mapInArrow(lambda batches: _packed(batches, packed, schema), PACKED), "vectors")
    return made, (made.agg(F.max("place")).first()[0] or 0) + 1


def top_products(df: DataFrame, k: int = 10, every: int = 100, scale: int = 1024) -> DataFrame:
    """`query_id, rank, vec_id, score`: the k best of all other rows for each row whose id is divisible by `every`."""
    rows = spool(whole_numbers(df, scale), "whole")
    # Ids part vectors of equal length, so copies spread over the partitions.
    vectors, groups = _ranged(rows, GROUP_VECTORS, [F.desc("length"), F.asc("vec_id")], GROUP_VECTORS)
    asking = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    queries, blocks = _ranged(asking, BLOCK_QUERIES, [F.asc("vec_id")], BLOCK_QUERIES)
    seeds = [(r["vec_id"], r["v"]) for r in rows.orderBy(F.desc("length"), F.asc("vec_id")).limit(SEEDS).collect()]
    seed_ids, seed_data = np.array([i for i, _ in seeds], np.int64), matrix([v for _, v in seeds])
    out = arrow_schema("query_id long, vec_id long, score long")

    def tables_of(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for ids, data, dims in zip(*(table.column(c).to_pylist() for c in ("ids", "data", "dims"))):
            yield unpacked(ids, data, dims)

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int]] = []
        buckets = [b for ids, data in tables_of(left) for b in buckets_of(ids, data)]
        buckets.sort(key=lambda b: -b[2][0])
        for ids, data in tables_of(right):
            first = Best(ids, k, np.full(len(ids), -np.inf))
            search(data, first, list(buckets_of(seed_ids, seed_data)))
            best = Best(ids, k, first.floor)
            search(data, best, buckets)
            found += [(q, v, -s) for q, rows in zip(ids.tolist(), best.found) for s, v in rows]
        columns = zip(*found) if found else [[]] * 3
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    spread = vectors.withColumnRenamed("place", "_g").withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = queries.withColumnRenamed("place", "_s").withColumn("_g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    both = spread.groupBy("_g", "_s").cogroup(asked.groupBy("_g", "_s")).applyInArrow(meet, "query_id long, vec_id long, score long")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    ranked = both.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
