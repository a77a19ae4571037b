"""Toxicity: held-out quality, the network's gradient, edge cases."""

import random
import zlib

import numpy as np

from plumbline.llm import toxicity


def corpus(n=900):
    rnd = random.Random(4)
    syllables = ["ka", "lo", "mi", "te", "ru", "so", "na", "pe"]
    word = lambda: "".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4)))
    docs, labels = [], []
    for i in range(n):
        lang = ("xx", "yy")[i % 2]
        words = [word() + ("" if lang == "xx" else "ei") for _ in range(rnd.randint(20, 120))]
        toxic = int(rnd.random() < 0.3)
        for _ in range(2 * toxic):
            words.insert(rnd.randrange(len(words)), "vile" + word() if lang == "xx" else "schuft" + word())
        docs.append((i, " ".join(words), lang, "s", 1.0))
        labels.append((i, 1, toxic))
    return docs, labels


def test_held_out_quality_and_edges(spark):
    docs, labels = corpus()
    extra = [(None, "kalo vileka vilemi", "xx", "s", 1.0), (5000, None, "xx", "s", 1.0), (5001, "", None, "s", 1.0), (5002, "kalo " * 50_000 + "vilelo vilesona", None, None, None), docs[0]]
    df = spark.createDataFrame(docs + extra, "doc_id long, text string, lang string, source string, score double")
    known = spark.createDataFrame([*labels, labels[0], (None, 1, 1), (7777, 1, None)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(df, known).collect()
    assert len(got) == len(docs) + len(extra) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    by = {r.doc_id: r for r in got}
    truth = {d: y for d, _, y in labels}
    held = [d for d in truth if zlib.crc32(str(d).encode()) % 5 == 0]
    assert all(by[d].held_out == (d in set(held)) for d in truth)
    assert sum(by[d].predicted == truth[d] for d in held) >= 0.95 * len(held)
    assert by[5000].predicted == by[5001].predicted == 0 and by[5000].score == by[5001].score
    assert by[5002].predicted == 1 and by[None].predicted == 1
    # Nothing but the text counts.
    plain = toxicity.score(df.withColumn("lang", df.source).withColumn("doc_id", df.doc_id + 5), toxicity.fit(toxicity.examples(df, known)))
    assert {(r.doc_id - 5, r.score) for r in plain.collect() if r.doc_id is not None} == {(r.doc_id, r.score) for r in got if r.doc_id is not None}
    assert toxicity.toxicity(df.limit(0), known.limit(0)).count() == 0
    alone = toxicity.toxicity(df, known.filter("toxic = 1")).collect()
    assert {r.score for r in alone} == {1.0}


def test_pooling_and_padding():
    net = toxicity.Network(1)
    rnd = np.random.default_rng(2)
    texts = [rnd.integers(1, 50, (n, 3)).astype(np.int32) for n in (0, 1, 2, 7)]
    ids, starts = toxicity.lay_out(texts)
    vectors = net.embed[ids].sum(axis=1)
    together = net.logits(vectors, starts)
    for t, want in zip(texts, together):
        one, start = toxicity.lay_out([t])
        assert abs(net.logits(net.embed[one].sum(axis=1), start)[0] - want) < 1e-5
    assert toxicity.threshold(np.array([-2.0, -1.0, 3.0, 4.0]), np.array([0, 0, 1, 1])) == 1.0


def test_gradient_against_finite_differences():
    net = toxicity.Network(3)
    rnd = np.random.default_rng(5)
    # In double precision, with few words so that every parameter in use matters.
    net.embed, net.out, net.base = (x.astype(np.float64) for x in (net.embed, rnd.normal(size=net.out.shape), net.base))
    # Off zero, where the padding's windows have their kink.
    net.filters, net.bias = [x.astype(np.float64) for x in net.filters], [rnd.normal(0, 0.1, x.shape) for x in net.bias]
    ids, starts = toxicity.lay_out([rnd.integers(1, 12, (n, 3)) for n in (1, 4, 9, 2)])
    labels, weight = np.array([1.0, 0.0, 0.0, 1.0]), np.array([0.7, 1.3, 1.3, 0.7])

    def loss():
        vectors = net.embed[ids].sum(axis=1)
        z = net.logits(vectors, starts)
        return (weight * np.where(labels == 1, np.logaddexp(0, -z), np.logaddexp(0, z))).mean()

    checked = 0
    for q, g in zip(net.parameters(), toxicity.gradients(net, ids, starts, labels, weight)):
        flat, slopes = q.reshape(-1), g.reshape(-1)
        used = np.flatnonzero(np.abs(slopes) > 1e-6)
        for i in rnd.choice(used, min(25, len(used)), replace=False):
            kept, step = flat[i], 1e-5
            ends = []
            for sign in (1, -1):
                flat[i] = kept + sign * step
                ends.append(loss())
            flat[i] = kept
            assert abs((ends[0] - ends[1]) / (2 * step) - slopes[i]) < 1e-6 + 1e-4 * abs(slopes[i])
            checked += 1
    assert checked > 100


def test_few_labels_still_train(spark):
    """Five toxic documents of forty labelled ones are learned from."""
    docs = [(i, f"kalo mite {'vilesoru nape' if i % 8 == 0 else 'sona peru'} w{i} tena", "xx", "s") for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    chosen = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 != 0]
    toxic, plain = [i for i in chosen if i % 8 == 0][:5], [i for i in chosen if i % 8][:35]
    known = spark.createDataFrame([(i, 1, int(i in toxic)) for i in toxic + plain], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(df, known).collect()}
    assert len({r.score for r in got.values()}) > 10
    assert all(got[i].predicted == (i % 8 == 0) for i in range(400))


def test_all_labelled_documents_train(spark, monkeypatch):
    """Far more documents of a label than a shard has: all are examples, and shards together learn words that few of them have."""
    docs = [(i, f"kalo mite {f'vile{i % 40}soru nape' if i % 4 == 0 else f'sona{i % 39} peru'} tena", "xx", "s") for i in range(8000)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    known = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(8000)], "doc_id long, quality int, toxic int")
    monkeypatch.setattr(toxicity, "SHARD", 1500, raising=False)
    found = toxicity.examples(df, known)
    assert found.count() == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(8000)) > 6000
    assert found.rdd.getNumPartitions() == 5
    got = toxicity.score(df, toxicity.fit(found)).collect()
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in got) > 7950
    assert toxicity.threshold(np.array([-1.0, 0.0, 2.0]), np.array([1, 0, 5]), np.array([9, 4, 6])) == 1.0
