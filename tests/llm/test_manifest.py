"""The manifest against trees built one hash at a time."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from plumbline.llm import manifest

LOWER = str.maketrans(manifest.UPPER, manifest.LOWER)


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    doc_id, source, lang, n_chars = row[0], row[3], row[2], row[4]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def grown(nodes):
    """Levels of a tree from its leaves to its last node."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def path_of(levels, i):
    steps = []
    for nodes in levels[:-1]:
        run = nodes[i // 16 * 16 : i // 16 * 16 + 16]
        steps.append(("".join(run[: i % 16]), "".join(run[i % 16 + 1 :])))
        i //= 16
    return steps


def expected(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[3], []).append(row)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source, members in by_source.items():
        members.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[1])))
        trees[source] = grown([leaf_of(r, r[1]) for r in members])
    top = grown([trees[s][-1][0] for s in sources])
    out = []
    for place, source in enumerate(sources):
        for i, row in enumerate(by_source[source]):
            path = path_of(trees[source], i) + path_of(top, place)
            tampered = row[1]
            if row[0] is not None and row[1] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                tampered = row[1].translate(LOWER)
            folded = leaf_of(row, tampered)
            for left, right in path:
                folded = h(left + folded + right)
            proof = h("".join(left + right for left, right in path))
            out.append((row[0], trees[source][0][i], trees[source][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return out


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, digest int, lo long, path string"
NAMES = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def check(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA)
    got = sorted((tuple(r[c] for c in NAMES) for r in manifest.audited(df).collect()), key=str)
    assert got == sorted(expected(rows), key=str)
    return got


def test_trees_of_several_heights(spark):
    rnd = random.Random(3)
    rows = []
    for source, n in [("hot", 300), ("one", 1), ("é", 16), ("z", 17), (None, 33), ("", 2), *[(f"s{k}", 1) for k in range(40)]]:
        for _ in range(n):
            text = rnd.choice([None, "", "Plain Text", "ünïcode Ä😀", "low only", "long Text " * 200])
            rows.append((rnd.randint(0, 10**6), text, rnd.choice(["en", None]), source, rnd.choice([None, 5])))
    rows += [(None, "A", "en", "hot", 1), (None, None, None, None, None), (7, "Rep", "en", "hot", 3), (7, "Rep", "en", "hot", 3), (7, "Other", "en", "hot", 3)]
    got = check(spark, rows)
    assert 0 < sum(not r[-1] for r in got) < len(got) / 3
    assert len({r[3] for r in got}) == 1


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257])
def test_single_source(spark, n):
    check(spark, [(k, f"Text {k}", "en", "s", k) for k in range(n)])


def test_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert manifest.audited(df).collect() == []


def test_labels_nest_and_untouched_rows_verify(spark):
    rows = [(k, f"Text {k}", "en", f"s{k % 3}", k) for k in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert manifest.manifest(df).filter("NOT verified").count() == 0
    leaves = manifest.ranked(df.select(F.col("source").alias("tree"), "doc_id", F.lit("x").alias("digest")), "tree", ["doc_id"])
    assert leaves.filter("hi - lo <> 1 OR lo < 0 OR hi > n").count() == 0
    levels = manifest.parents_of(leaves)
    assert [level.count() for level in levels] == [39, 3]
    for level, nodes in enumerate(levels, 1):
        for r in nodes.collect():
            assert (r["lo"], r["hi"]) == (r["children"][0]["lo"], r["children"][-1]["hi"])
            assert all(a["hi"] == b["lo"] for a, b in zip(r["children"], r["children"][1:]))
            assert r["hi"] - r["lo"] <= 16**level
