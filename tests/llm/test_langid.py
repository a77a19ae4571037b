"""Languages: held-out accuracy, the kernel itself, edge cases."""

import zlib

import numpy as np

from plumbline.llm import langid

SF_DIR = "/root/testdata/sf0.01"


def test_weights_are_the_kernel_expansion():
    texts = ["the cat sat on the mat", "der Hund und die Katze", "the dog and a cat", "die Maus und der Hund", "on the mat", "und die"] * 3
    labels = ["en", "de", "en", "de", "en", "de"] * 3
    pairs = [(lang, np.unique(np.concatenate(langid.gram_codes(t)))) for lang, t in zip(labels, texts)]
    model = langid.fit(pairs)
    blocks = langid.STARTS

    def kernel(a, b):
        out = 0.0
        for s, e in zip(blocks, blocks[1:]):
            x = {c for c in a if s <= c < e} & set(model.features.tolist())
            y = {c for c in b if s <= c < e} & set(model.features.tolist())
            if x and y:
                out += len(x & y) / (len(x) * len(y)) ** 0.5 / 4
        return out

    phi = model.presence(texts)
    for i in (0, 1, 5):
        for j in (0, 2, 3):
            assert abs(float(phi[i] @ phi[j]) - kernel(pairs[i][1].tolist(), pairs[j][1].tolist())) < 1e-5
    assert [model.languages[i] for i in model.score(texts).argmax(axis=1)] == labels


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = {r.doc_id: r for r in langid.languages(docs).collect()}
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [d for d in got if got[d].held_out]
    assert all((zlib.crc32(str(d).encode()) % 4 == 2) == got[d].held_out for d in got) and len(held) > 100
    assert sum(got[d].lang_pred == lang[d] for d in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_edges(spark):
    rows = [(i, ("the quick brown fox " if i % 2 else "der schnelle braune Fuchs ") * 5, "en" if i % 2 else "de", 1) for i in range(60)]
    rows += [(None, "the fox", "en", 1), (100, None, "en", 1), (101, "12 34 !?", None, 1), (102, "", "en", 1), (103, "the quick fox " * 20_000, None, 1), rows[0]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = [(r.doc_id, r.lang_pred) for r in langid.languages(df).collect()]
    assert len(got) == len(rows)
    by = dict(got)
    assert by[100] == by[101] == by[102] == "und" and by[103] == by[None] == "en" and got.count((0, "de")) == 2
    assert langid.languages(df.limit(0)).count() == 0
    none = langid.languages(df.withColumn("lang", df.lang.substr(9, 0).try_cast("int").cast("string"))).collect()
    assert {r.lang_pred for r in none} == {"und"}
