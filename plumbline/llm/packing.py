"""Packing documents into sequences by best fit and a swap-based local search.

Items are dealt at random into blocks of BLOCK_ITEMS, each small enough for one
task. A block is packed best fit first, then improved: the emptiest bin gives its
items to other underfull bins, by moving one, exchanging one for a shorter one,
or two for one. Every step raises the sum of squared fills, so the search ends;
it also ends once the block uses as few bins as its total length allows. The
bins that stay poorly filled in their blocks meet again in a second round, which
starts from the bins as they are and can only empty more of them.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm import bpe
from plumbline.llm.frames import map_rows
from plumbline.session import spool

BLOCK_ITEMS = 8192
# Bins filled less than this share meet again across blocks.
SETTLED = 0.9


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins as lists of positions; longest items first, each into the fullest bin that takes it."""
    bins: list[list[int]] = []
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    gaps = 0  # bit g: some bin has a gap of g
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        fitting = gaps >> need
        if fitting:
            gap = need + (fitting & -fitting).bit_length() - 1
            b = by_gap[gap].pop()
            if not by_gap[gap]:
                gaps &= ~(1 << gap)
            bins[b].append(i)
        else:
            gap, b = capacity, len(bins)
            bins.append([i])
        by_gap[gap - need].append(b)
        gaps |= 1 << gap - need
    return bins


def improve(lengths: np.ndarray, bins: list[list[int]], capacity: int) -> list[list[int]]:
    """Empties bins by moves and exchanges; the result has empty lists for the bins it emptied."""
    owner = np.zeros(len(lengths), np.int64)
    for b, members in enumerate(bins):
        owner[members] = b
    fill = np.bincount(owner, lengths, len(bins)).astype(np.int64)
    least = -(-int(lengths.sum()) // capacity)
    stuck = np.zeros(len(bins), bool)
    used = int((fill > 0).sum())
    while used > least:
        open_bins = (fill > 0) & (fill < capacity)
        if not (open_bins & ~stuck).any():
            break
        a = int(np.where(open_bins & ~stuck, fill, capacity + 1).argmin())
        near = np.flatnonzero(open_bins[owner] & (owner != a) & (fill[owner] >= fill[a]))
        step = _best_step(lengths, owner, fill, np.flatnonzero(owner == a), near, open_bins, a, capacity)
        if step is None:
            stuck[a] = True
            continue
        given, taken, b = step
        gain = int(lengths[given].sum() - lengths[taken].sum())
        owner[given], owner[taken] = b, a
        fill[a] -= gain
        fill[b] += gain
        stuck[[a, b]] = False
        used -= int(fill[a] == 0)
    out: list[list[int]] = [[] for _ in bins]
    for i, b in enumerate(owner.tolist()):
        out[b].append(i)
    return out


def _best_step(lengths, owner, fill, mine, near, open_bins, a, capacity):
    """The step that leaves the smallest gap in the receiving bin: items given, items taken, bin."""
    best = None
    gaps = np.where(open_bins & (fill >= fill[a]), capacity - fill, -1)
    gaps[a] = -1
    # Equal lengths are alike: one of each is tried.
    _, first = np.unique(lengths[mine], return_index=True)
    ones = mine[first]
    pairs = [(i,) for i in ones.tolist()]
    for i in ones.tolist():
        left = gaps - lengths[i]
        fits = np.flatnonzero(left >= 0)
        if len(fits):
            b = fits[left[fits].argmin()]
            if best is None or left[b] < best[0]:
                best = (left[b], [i], [], int(b))
    if best is not None:
        return best[1:]
    tried = set()
    for n, i in enumerate(mine.tolist()):
        for j in mine[n + 1 :].tolist():
            pair = (min(lengths[i], lengths[j]), max(lengths[i], lengths[j]))
            if pair not in tried:
                tried.add(pair)
                pairs.append((i, j))
    others, room = lengths[near], (capacity - fill)[owner[near]]
    for given in pairs:
        gain = lengths[list(given)].sum() - others
        left = np.where(gain > 0, room - gain, -1)
        fits = np.flatnonzero(left >= 0)
        if len(fits):
            at = fits[left[fits].argmin()]
            if best is None or left[at] < best[0]:
                best = (left[at], list(given), [int(near[at])], int(owner[near[at]]))
    return best and best[1:]


def _placed(frame: pd.DataFrame, bins: list[list[int]], names: list[int]) -> pd.DataFrame:
    lengths = frame["length"].to_numpy()
    order = [i for members in bins for i in members]
    sizes = np.array([len(m) for m in bins])
    ends = np.cumsum(lengths[order])
    offsets = ends - lengths[order]
    firsts = np.concatenate([[0], np.cumsum(sizes)[:-1]])[sizes > 0]
    held = sizes[sizes > 0]
    out = frame.iloc[order].copy()
    out["offset"] = offsets - np.repeat(offsets[firsts], held)
    out["sequence_id"] = np.repeat(np.array(names, np.int64)[sizes > 0], held)
    out["fill"] = np.repeat(np.add.reduceat(lengths[order], firsts), held)
    return out


def pack(items: DataFrame, capacity: int, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """Adds `sequence_id` and `offset` to items with a `length` from 1 to `capacity`.

    Rows are items, equal ones too. Columns of the input named `sequence_id`,
    `offset`, `fill` or `_block` are replaced.
    """
    items = spool(items.drop("sequence_id", "offset", "fill", "_block"), "items")
    long = F.lit(None).cast("long")
    rows = items.filter(F.col("length") < capacity)
    # The table is stored, so a row keeps its number if a task runs again.
    whole = items.filter(F.col("length") == capacity).withColumns(
        {"offset": F.lit(0).cast("long"), "sequence_id": -1 - F.monotonically_increasing_id()}
    )
    blocks = max(1, -(-rows.count() // block_items))
    dealt = rows.withColumn("_block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)))
    dealt = dealt.withColumns({"offset": long, "sequence_id": long, "fill": long})

    def first(frame: pd.DataFrame) -> pd.DataFrame:
        lengths = frame["length"].to_numpy()
        bins = improve(lengths, best_fit(lengths, capacity), capacity)
        base = int(frame["_block"].iloc[0]) << 24
        return _placed(frame, bins, [base + n for n in range(len(bins))])

    packed = dealt.groupBy("_block").applyInPandas(first, dealt.schema)
    if blocks > 1:
        packed = spool(packed, "packed")
        poor = F.col("fill") < SETTLED * capacity
        again = max(1, -(-packed.filter(poor).count() // block_items))

        def second(frame: pd.DataFrame) -> pd.DataFrame:
            names, place = np.unique(frame["sequence_id"].to_numpy(), return_inverse=True)
            bins: list[list[int]] = [[] for _ in names]
            for i, b in enumerate(place.tolist()):
                bins[b].append(i)
            return _placed(frame, improve(frame["length"].to_numpy(), bins, capacity), names.tolist())

        regroup = F.pmod(F.xxhash64("sequence_id"), F.lit(again))
        rest = packed.filter(poor).withColumn("_block", regroup).groupBy("_block").applyInPandas(second, dealt.schema)
        packed = packed.filter(~poor).unionByName(rest)
    return whole.unionByName(packed.drop("_block", "fill"))


def token_pieces(df: DataFrame, path: str, capacity: int, end_id: int = 0) -> DataFrame:
    """Pieces of at most `capacity` tokens of each document's ids followed by `end_id`.

    Only documents of more tokens are cut. A null text is empty and gives one
    piece of the end id; repeated rows give their pieces each.
    """

    def make():
        end = np.uint32(end_id).tobytes()

        def run(batch):
            out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32")}
            for doc_id, ids in zip(batch["doc_id"], bpe.encode_ids(batch["text"], path)):
                ids += end
                for piece, start in enumerate(range(0, len(ids) // 4, capacity)):
                    part = ids[4 * start : 4 * (start + capacity)]
                    for k, v in zip(out, (doc_id, piece, start, len(part) // 4, zlib.crc32(part))):
                        out[k].append(v)
            return out

        return run

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return map_rows(df.select(df["doc_id"].cast("long"), df["text"]), make, schema)


def packed_documents(df: DataFrame, path: str, capacity: int = 2048) -> DataFrame:
    """Each piece with its sequence and its place there."""
    return pack(token_pieces(df, path, capacity), capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
