"""The audit against plain counting."""

import collections
import random
import re

import numpy as np
import pytest

from plumbline.llm import divergence

TERM = re.compile(divergence.TERM)
LOWER = str.maketrans(divergence.UPPER, divergence.LOWER)


def expected(rows, least, top):
    met, n, all_n, groups = collections.Counter(), collections.Counter(), collections.Counter(), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = collections.Counter(TERM.findall((text or "").translate(LOWER)))
        for t, c in found.items():
            met[lang, t] += 1
            n[lang, source, t] += c
            all_n[lang, t] += c
    out = []
    for lang, source in groups:
        kept = [t for (g, t), m in met.items() if g == lang and m >= least]

        def share(count, who):
            return {t: 1 + 10**9 * (count(t) + 5) // (sum(map(count, kept)) + 5 * len(kept)) for t in kept}

        own = share(lambda t: n[lang, source, t], source)
        whole = share(lambda t: all_n[lang, t], lang)
        pairs = []
        for other in sorted(s for g, s in groups if g == lang and s != source):
            theirs = share(lambda t: n[lang, other, t], other)
            pairs.append((sum(abs(own[t] - theirs[t]) for t in kept), other))
        terms = [(own[t] - whole[t], t) for t in kept if n[lang, source, t] and own[t] > whole[t]]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, item, value, r) for r, (value, item) in enumerate(found[:most], 1)]
    return out


WORDS = ["the", "The,", "of", "OF", "don't", "a1b2", "e f", "naïve", "ÉCLAIR", "x--y--x", "日本語", "😀", "42", "!!", "re-re-re", " z", "İ", "st\x7fu", "\x1cq"]


def texts(rnd, n):
    made = []
    for k in range(n):
        words = [rnd.choice(WORDS) if rnd.random() < 0.8 else f"w{rnd.randint(0, 40)}" for _ in range(rnd.randint(0, 40))]
        made.append("".join(w + rnd.choice([" ", "\n", "\t\x0b", "  "]) for w in words))
    return made


SCHEMA = "doc_id long, text string, lang string, source string, term string, block int, n double"
ORDER = ["lang", "source", "part", "item", "value", "rank"]


def run(spark, rows, least, top):
    df = spark.createDataFrame([(*r, "x", 1, 2.0) for r in rows], SCHEMA)
    return sorted(tuple(r[c] for c in ORDER) for r in divergence.divergence(df, least, top).collect())


@pytest.mark.parametrize("block, bucket, merged, cells, sources", [(8 << 20, 24 << 20, 256, 1 << 20, 512), (500, 4000, 4, 40, 3)])
def test_against_plain_counts(spark, monkeypatch, block, bucket, merged, cells, sources):
    for name, value in (("BLOCK_BYTES", block), ("BUCKET_BYTES", bucket), ("MERGED", merged), ("CELLS", cells), ("SOURCES", sources)):
        monkeypatch.setattr(divergence, name, value)
    rnd = random.Random(8)
    rows = []
    for k, text in enumerate(texts(rnd, 500)):
        source = "hot" if rnd.random() < 0.4 else rnd.choice(["b", "c", "", None, "é", *"klmnop"])
        rows.append((k, text, rnd.choice(["en", "en", "de", None]), source))
    rows += [(None, None, None, None), (1, None, "fr", "only"), (2, "", "fr", "none"), (3, "rare words", "it", "x"), (3, "rare words", "it", "x")]
    rows += [(9, "the of " * 3000, "en", "b"), (9, "naïve " * 300, "en", "c"), (9, "naïve " * 300, "en", "c")]
    got = run(spark, rows, 5, 10)
    assert got == sorted(expected(rows, 5, 10))
    assert any(r[2] == "term" for r in got) and ("fr", "none", "pair", "only", 0, 1) in got


def test_nothing(spark):
    assert run(spark, [], 30, 50) == []


def test_postings_hold_large_counts():
    chunks, place, firsts, packed = divergence.postings([b"a " * 700 + b"b", b"", b"a b\x0cb"], 4)
    assert sorted(chunks) == [b"a", b"b"] and place.tolist() == divergence.bucket_of(chunks, 4).tolist() == sorted(place)
    total = {c: collections.Counter() for c in chunks}
    for c, i, j in zip(chunks, firsts, firsts[1:]):
        for p in packed[i:j].tolist():
            total[c][p >> 8] += p & 255
    assert total == {b"a": {0: 700, 2: 1}, b"b": {0: 1, 2: 2}}
    assert packed.dtype == np.uint32
