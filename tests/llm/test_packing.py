"""Packing: whole pieces, gapless sequences, few sequences."""

import itertools
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from plumbline.llm import packing
from plumbline.llm.queries import vocabulary


def fewest(lengths, capacity):
    """Number of bins by trying every way."""

    def place(rest, fills):
        if not rest:
            return len(fills)
        best, seen = len(fills) + len(rest), set()
        for n, f in enumerate(fills):
            if f + rest[0] <= capacity and f not in seen:
                seen.add(f)
                best = min(best, place(rest[1:], fills[:n] + [f + rest[0]] + fills[n + 1 :]))
        return min(best, place(rest[1:], fills + [rest[0]]))

    return place(sorted(lengths, reverse=True), [])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=8))
def test_search_against_all_ways(lengths):
    lengths = np.array(lengths)
    bins = packing.improve(lengths, packing.best_fit(lengths, 20), 20)
    assert sorted(itertools.chain(*bins)) == list(range(len(lengths)))
    assert all(lengths[b].sum() <= 20 for b in bins)
    assert sum(map(bool, bins)) <= fewest(list(lengths), 20) + 1


def test_search_empties_bins_that_first_fit_leaves():
    # One item to a bin at the start; exchanges and moves have to bring them together.
    lengths = np.array([6, 6, 4, 4, 5, 5, 3, 7, 2, 8])
    start = [[0, 6], [1, 8], [2, 4], [3, 5], [7], [9]]
    bins = packing.improve(lengths, start, 10)
    assert sum(map(bool, bins)) == 5 and all(lengths[b].sum() == 10 for b in bins if b)


def check_rows(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("block", [50, 100_000])
def test_pack_table(spark, block):
    rnd = np.random.default_rng(3)
    lengths = [int(x) for x in np.concatenate([rnd.integers(1, 300, 600), rnd.integers(900, 2049, 300), [2048] * 20])]
    items = spark.createDataFrame([(n, x, 7) for n, x in enumerate(lengths)], "name long, length long, fill int")
    rows = packing.pack(items, 2048, block).collect()
    assert sorted((r.name, r.length) for r in rows) == list(enumerate(lengths))
    used = check_rows(rows, 2048)
    assert used <= len(packing.best_fit(np.array(lengths), 2048)) * (1.06 if block == 50 else 1)
    assert packing.pack(items.limit(0), 2048).count() == 0


def test_documents(spark):
    library = Tokenizer.from_file(vocabulary())
    docs = [(1, "alpha beta " * 3000), (2, None), (3, ""), (None, "Gamma"), (4, "same text"), (4, "same text")]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, length string")
    rows = packing.packed_documents(df, vocabulary()).collect()
    check_rows(rows, 2048)
    want = []
    for doc_id, text in docs:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            want.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
    assert sorted(map(str, want)) == sorted(str(tuple(r)[:5]) for r in rows)
