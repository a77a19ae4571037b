"""Encoding against the tokenizers library."""

import hashlib
import random

import pytest
from tokenizers import Tokenizer

from plumbline.llm import bpe
from plumbline.llm.queries import vocabulary

PARTS = [*"abcdefghijklmnopqrstuvwxyzABZ0123456789'.,!?-_  \n\t\x1c\x85 éÉñßÀΣσςİıſK½²Ⅷ日本語한글😀é̀ﬁǅ<|>​　"]
PARTS += ["don't", "I'LL", "<|endoftext|>", "<|startoftext|>", "aaaaaaa", "hello world", "<|endoftext|", "HeLLo"]
LONG = ["", " ", "ab" * 700 + "x", "é" * 500, "hahaha" * 300, "word " * 5000, "<|endoftext|>" * 3]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(vocabulary())
    t.no_truncation()
    t.no_padding()
    return t


def texts():
    rnd = random.Random(1)
    made = ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 60))) for _ in range(3000)]
    few = ["".join(rnd.choice("abcde aeiou tnrs"[:k]) for _ in range(40)) for k in range(1, 16) for _ in range(60)]
    return made + few + LONG


def test_ids_and_decoded_text(library):
    made = texts()
    for text, (ids, shown), packed in zip(made, bpe.encode(made, vocabulary()), bpe.encode_ids(made, vocabulary())):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids == " ".join(map(str, want)), text
        assert shown == library.decode(want, skip_special_tokens=False)
        assert list(memoryview(packed).cast("I")) == want
        assert bpe.decode_ids(want, vocabulary()) == shown


def test_pairs_by_brute_force():
    e = bpe.encoder(vocabulary())
    rnd = random.Random(2)
    import numpy as np

    inner, final = list(e.inner.values()), list(e.final.values())
    pairs = [(rnd.choice(inner), rnd.choice(rnd.choice([inner, final]))) for _ in range(4000)]
    a, b = np.array(pairs).T
    for (x, y), good in zip(pairs, e.compatible(a, b)):
        left, right = e.texts[x], e.texts[y]
        ends = right.endswith(bpe.END)
        symbols = [e.vocab[c] for c in left + (right.removesuffix(bpe.END) if ends else right)]
        if ends:
            symbols[-1] = e.final_symbol[right.removesuffix(bpe.END)[-1]]
        assert (e.merge(symbols) == [x, y]) == good


def test_table_with_nulls_and_repeats(spark, library):
    rows = [(1, "Hello <|endoftext|>", "x"), (1, "Hello <|endoftext|>", "x"), (2, None, None), (None, "", "y"), (3, " \n", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(bpe.encoding_digests(df, vocabulary()).collect(), key=str)
    none = hashlib.sha256(b"").hexdigest()
    assert len(got) == 5
    for r in got:
        if r.doc_id == 1:
            want = library.encode("Hello <|endoftext|>", add_special_tokens=False).ids
            assert r.n_tokens == len(want) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        else:
            assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (0, none, none)
    assert bpe.encoding_digests(df.limit(0), vocabulary()).count() == 0
    whole = bpe.encode_table(df, vocabulary()).collect()
    assert sorted(len(r.ids) for r in whole) == [0, 0, 0, 2, 2]


def test_merging_side_by_side():
    e = bpe.encoder(vocabulary())
    rnd = random.Random(3)
    letters = [*"eeettaaoinshr", *bpe.byte_alphabet()]
    words = ["".join(rnd.choices(letters[: rnd.choice((5, 13, 60, len(letters)))], k=rnd.choice((1, 2, 3, 6, 9, 14, 30, 99, 100, 101, 300)))) for _ in range(3000)]
    want = []
    for w in words:
        want.append(e.merge([*map(e.symbol.__getitem__, w[:-1]), e.final_symbol[w[-1]]]))
    assert e.merge_words(words) == want and e.merge_words([]) == []
