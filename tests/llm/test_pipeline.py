"""The stages in a row against plain versions of each."""

import re
import zlib

import numpy as np
import pytest
from test_jaccard import brute as components_of
from test_secrets import all_of
from test_suffixes import brute as removal_of
from tokenizers import Tokenizer

import corpus_pipeline
from plumbline.llm import quality
from plumbline.llm.queries import vocabulary

SF_DIR = "/root/testdata/sf0.001"


def mask(text):
    out, at = "", 0
    spans = sorted((s, e) for s, _, _, e in all_of(text))
    joined = []
    for s, e in spans:
        if joined and s < joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], e)
        else:
            joined.append([s, e])
    for s, e in joined:
        out += text[at:s] + corpus_pipeline.MASK
        at = e
    return out + text[at:]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(folder / name))
        docs = out[name] = spark.read.parquet(str(folder / name))
    return out


def rows_of(df):
    return {r.doc_id: r.asDict() for r in df.collect()}


def test_columns(stages):
    for name in ("quality_rules", "jaccard_join", "suffix_dedup", "secret_scan"):
        assert stages[name].columns == stages["documents"].columns


def test_quality(stages):
    docs, kept = rows_of(stages["documents"]), rows_of(stages["quality_rules"])
    verdict = {r.doc_id: r.kept for r in quality.quality(stages["documents"]).collect()}
    assert kept == {d: r for d, r in docs.items() if verdict[d]}
    for d, r in docs.items():
        c = dict(zip(quality.COUNTS, quality.counts_of(r["text"])))
        if c["n_words"] < 50 or 2 * c["n_repeat_words"] > c["n_words"]:
            assert d not in kept


def test_near_copies(stages):
    docs, kept = rows_of(stages["quality_rules"]), rows_of(stages["jaccard_join"])
    groups = components_of([(d, r["text"]) for d, r in docs.items()])
    assert kept == {d: docs[d] for d, _, c in groups if d == c}


def test_repeated_strings(stages):
    docs, kept = rows_of(stages["jaccard_join"]), rows_of(stages["suffix_dedup"])
    for d, n, removed, _, _ in removal_of([(d, r["text"]) for d, r in docs.items()]):
        if removed == 0:
            assert kept[d] == docs[d]
        elif d in kept:
            assert n - removed - 6 * 4 <= len(kept[d]["text"].encode()) <= n - removed
            assert kept[d]["n_chars"] == len(kept[d]["text"])


def test_secrets(stages):
    docs, kept = rows_of(stages["suffix_dedup"]), rows_of(stages["secret_scan"])
    for d, r in docs.items():
        assert kept[d]["text"] == mask(r["text"])
    assert docs.keys() == kept.keys()


def test_packing(stages):
    library = Tokenizer.from_file(vocabulary())
    want = []
    for d, r in rows_of(stages["secret_scan"]).items():
        ids = np.array(library.encode(r["text"], add_special_tokens=False).ids + [0], "<u4")
        want += [(d, p, s, len(ids[s : s + 2048]), zlib.crc32(ids[s : s + 2048].tobytes())) for p, s in enumerate(range(0, len(ids), 2048))]
    rows = stages["best_fit_packing"].collect()
    assert sorted(want) == sorted(tuple(r)[:5] for r in rows)
    used = len({r.sequence_id for r in rows})
    assert used <= -(-sum(r.length for r in rows) // 2048) + 1


def test_edges(spark):
    rows = [(1, None, None, None, None), (None, "word " * 80, "en", "s", 400), (2, "", "en", "s", 0), (3, "a b c " * 40, None, None, 240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        for df in (docs, docs.limit(0)):
            stage(spark, df, SF_DIR).collect()
    text = " ".join(f"w{i}" for i in range(80)) + ' api_key = "0123456789abcdef"'
    docs = spark.createDataFrame([(5, text, "en", "s", len(text), "extra")], "doc_id long, text string, lang string, source string, n_chars long, kept string")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
    want = re.sub('api_key.*f(?=")', "[secret]", text)
    assert [tuple(r) for r in docs.collect()] == [(5, want, "en", "s", len(want), "extra")]


def test_one_row_of_each_group_stays(spark):
    def text(k, *more):
        return " ".join([*(f"t{k}w{i}" for i in range(80)), *more])

    rows = [
        (None, text(1)), (None, text(1)), (None, text(1, "x")),  # near copies, none with an id
        (None, text(2)), (4, text(2)), (3, text(2, "x")),  # linked with ids
        (5, text(3)), (5, text(3, "x")), (5, text(4)),  # one id, two texts that link and one that does not
        (6, text(5)), (6, text(5)), (6, text(5)),  # repeats of the smallest id
        (7, text(6)), (8, text(6)), (8, text(6)),  # repeats of another
        (None, text(7)),  # linked with nothing
        (9, None), (9, None), (9, ""), (None, None), (None, None),
    ]
    docs = spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, text string, lang string")
    got = corpus_pipeline.jaccard_join(spark, docs, SF_DIR)
    assert got.columns == docs.columns
    got = [(r.doc_id, r.text and r.text.split()[0][:2], r.text) for r in got.collect()]
    heads = sorted(((d, h) for d, h, t in got if t), key=str)
    assert heads == sorted([(None, "t1"), (3, "t2"), (5, "t3"), (5, "t4"), (6, "t5"), (7, "t6"), (None, "t7")], key=str)
    # Rows without words link with nothing.
    assert sorted(((d, t) for d, _, t in got if not t), key=str) == sorted([(9, None), (9, ""), (None, None), (None, None)], key=str)
