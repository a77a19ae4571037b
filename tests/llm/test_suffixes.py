"""Suffix order and removal against plain versions."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plumbline.llm import suffixes


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffix_order(text):
    assert suffixes.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_suffix_order_of_long_texts():
    rnd = random.Random(1)
    for text in ([1] * 3000, [1, 2] * 1500, [rnd.randint(0, 255) for _ in range(5000)], [3, 1, 2] * 700 + [0] + [3, 1, 2] * 700):
        assert suffixes.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def brute(rows):
    last = suffixes.LAST
    docs = [(last if d is None else d, (t or "").encode()) for d, t in rows]
    first = {}
    for d, b in docs:
        for s in range(len(b) - 99):
            w = b[s : s + 100]
            first[w] = min(first.get(w, (d, s)), (d, s))
    out = []
    for (doc_id, _), (d, b) in zip(rows, docs):
        gone = bytearray(len(b))
        for s in range(len(b) - 99):
            if first[b[s : s + 100]] < (d, s):
                gone[s : s + 100] = b"\1" * 100
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(n) for n in (18, 22, 25, 40, 90)]
    texts = []
    for _ in range(150):
        parts = [rnd.choice([prose(rnd.randint(1, 40)), rnd.choice(passages), rnd.choice(passages)[rnd.randint(0, 60) :]]) for _ in range(rnd.randint(1, 6))]
        texts.append(" ".join(parts))
    for t in rnd.sample(texts, 30):
        words = t.split(" ")
        words[rnd.randrange(len(words))] = word()
        texts.append(" ".join(words))
    texts += rnd.sample(texts, 20) + ["ab " * 300, "x" * 1000, "x" * 99, "x" * 100, None, "", passages[0][:99], "ab " * 200 + prose(30)]
    rnd.shuffle(texts)
    return [(rnd.choice([2 * i, 2 * i, 7]), t) for i, t in enumerate(texts)] + [(None, passages[-1]), (None, texts[3]), (50, texts[3]), (50, texts[3])]


@pytest.mark.parametrize("hot", [4096, 3])
def test_removal(spark, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT_RUNS", hot)
    rows = corpus(hot)
    df = spark.createDataFrame([(*r, b"x", 1) for r in rows], "doc_id long, text string, code binary, kind int").repartition(5)
    got = sorted((tuple(r) for r in suffixes.removal_digests(df).collect()), key=str)
    assert got == brute(rows)
    assert suffixes.removal_digests(df.limit(0)).count() == 0


def test_strings_that_come_again_in_the_only_run_of_their_key(spark):
    rnd = random.Random(8)
    prose = lambda n: "".join(rnd.choice("abcdefghij klmé") for _ in range(n))
    rows = [(0, "-" * 120), (1, "z" * (suffixes.RUN + 99)), (2, prose(40) + "= " * 60 + prose(50))]
    rows += [(3 + i, prose(rnd.randint(0, 80)) + prose(p) * (rnd.randint(101, 300) // p + 1) + prose(30)) for i, p in enumerate((3, 7, 34, 35, 67, 68, 69, 99))]
    got = suffixes.removal_digests(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_only_stretches_with_repeats_are_sorted():
    same = bytes(range(100, 230))
    texts = [b"x" * 20 + same, b"no such string " * 3 + b"y" * 60, same[5:125] + b"end"]
    assert suffixes.shortened(texts) == [(0, 25, 145), (2, 0, 120)]
    assert suffixes.shortened([same, same[::-1]]) == []
