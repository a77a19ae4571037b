"""Jaccard components against all pairs."""

import random
import re

import pytest

from plumbline.llm import jaccard


def brute(rows):
    sets = []
    for _, text in rows:
        lower = "".join(c.lower() if c.isascii() else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lower)
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted(((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def family(rnd, vocabulary, length, copies, edits):
    """Copies of copies, with words exchanged."""
    made = [[rnd.choice(vocabulary) for _ in range(length)]]
    for _ in range(copies):
        words = list(rnd.choice(made))
        for _ in range(rnd.randint(0, edits)):
            words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        made.append(words)
    return made


def corpus(seed):
    rnd = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(400)] + ["É", "é", "A", "a"]
    passage = [rnd.choice(vocabulary) for _ in range(40)]
    docs = []
    for length, copies, edits in ((60, 40, 3), (150, 30, 5), (30, 30, 1), (8, 12, 1), (500, 15, 12), (4, 6, 1)):
        docs += family(rnd, vocabulary, length, copies, edits)
    docs += [[*passage, *(rnd.choice(vocabulary) for _ in range(rnd.randint(2, 80)))] for _ in range(80)]
    docs += [[rnd.choice(vocabulary) for _ in range(rnd.randint(1, 120))] for _ in range(60)]
    texts = [rnd.choice([" ", "\n", "\t "]).join(d) for d in docs] + [None, "", " \n ", "a", "A", "word " * 300, "x y z", "x y z"]
    rnd.shuffle(texts)
    return [(i * 3, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("heavy, limit", [(1000, None), (10, None), (10, 10**6), (1000, 0)])
def test_against_all_pairs(spark, monkeypatch, heavy, limit):
    # With few documents, a low bound makes shingles heavy; the boundary between enumeration and scans is set to both ends as well.
    monkeypatch.setattr(jaccard, "HEAVY_LEAST", heavy)
    if heavy == 10:
        monkeypatch.setattr(jaccard, "HEAVY_SHARE", 10**9)
    if limit is not None:
        monkeypatch.setattr(jaccard, "boundary", lambda sets: limit)
    rows = corpus(heavy)
    rows += [(None, rows[5][1]), (None, "alone and without an id at all"), rows[9], rows[9]]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n long, sig string")
    got = sorted((tuple(r) for r in jaccard.jaccard_components(df).collect()), key=str)
    assert got == brute(rows)


def test_empty_table(spark):
    assert jaccard.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_columns_named_like_the_helpers(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(1, text, "mine1", 5, "a"), (2, text, "mine2", 6, "b"), (2, text, "mine2", 6, "b"), (3, "other words here", None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _row string, component int, _key string")
    out = jaccard.representatives(df)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted([rows[0], rows[3]], key=str)


def test_a_bucket_takes_little_more_than_its_hashes():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from plumbline.llm.frames import arrow_schema

    rnd = np.random.default_rng(1)
    names = [bytes([i % 256, i // 256]) + b"x" * 14 for i in range(600)]
    common = rnd.integers(0, 2**64, 50, np.uint64)
    sets = [np.unique(np.concatenate([rnd.integers(0, 2**64, 4000, np.uint64), rnd.choice(common, 5)])) for _ in names]
    # The last row repeats sets of the first.
    rows = [list(range(i, i + 20)) for i in range(0, 600, 20)] + [[0, 1, 2]]
    table = pa.table({
        "bucket": pa.array([0] * len(rows), pa.int32()),
        "sig": [b"".join(names[i] for i in r) + np.array([len(sets[i]) for i in r], np.uint32).tobytes() for r in rows],
        "n": [len(r) for r in rows],
        "hashes": [np.concatenate([sets[i] for i in r]).tobytes() for r in rows],
    })
    tracemalloc.start()
    got = jaccard.shared_in_bucket(table, arrow_schema("sig binary, n long, hashes binary, df binary"))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3 * sum(8 * len(s) for s in sets)
    found, times = np.unique(np.concatenate(sets), return_counts=True)
    many = dict(zip(found[times > 1].tolist(), times[times > 1].tolist()))
    want = {n: {h: many[h] for h in s.tolist() if h in many} for n, s in zip(names, sets)}
    made = {r["sig"]: dict(zip(np.frombuffer(r["hashes"], np.uint64).tolist(), np.frombuffer(r["df"], np.int64).tolist())) for r in got.to_pylist()}
    assert made == {n: w for n, w in want.items() if w}
    assert jaccard.shared_in_bucket(table.slice(0, 1), got.schema).num_rows <= 20
