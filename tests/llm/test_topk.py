"""Top products against all products."""

import numpy as np
import pytest

from plumbline.llm import topk


def brute(rows, k, every):
    vectors = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        vectors.append((i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]))
    out = []
    asking = {}
    for i, v in vectors:
        if i % every == 0:
            asking[i] = min(v, asking.get(i, v))
    for q, x in asking.items():
        scored = sorted((-sum(a * b for a, b in zip(x, v)), i) for i, v in vectors if i != q)
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("shape", ["unit", "lengths", "ties", "large"])
def test_against_all_products(spark, shape, monkeypatch):
    monkeypatch.setattr(topk, "GROUP_VECTORS", 300)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 20)
    monkeypatch.setattr(topk, "SEEDS", 64)
    rnd = np.random.default_rng(len(shape))
    m = rnd.normal(size=(900, 12))
    if shape == "unit":
        m /= np.linalg.norm(m, axis=1, keepdims=True)
    if shape == "lengths":
        m *= np.exp(rnd.normal(0, 1.5, (900, 1)))
        m[:, 0] += 4
    if shape == "ties":
        m = np.round(m)
        m[:400] = m[0]
    if shape == "large":
        m *= 1e5
    rows = [(int(n), [float(x) for x in v]) for n, v in enumerate(m)]
    rows += [(1000, None), (2000, [1.0, None]), (3000, [float("nan")] * 12), (None, [1.0]), (4000, []), (5000, [1.0, 2.0]), (6001, [float("inf")])]
    rows += [rows[7], rows[100], (100, [0.0] * 12)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<float>, score int")
    got = sorted(tuple(r) for r in topk.top_products(df, 10, 20).collect())
    assert got == brute(rows, 10, 20)


def test_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (100, [-1.0, 0.5]), (3, [0.0, 0.0])], "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in topk.top_products(df).collect()) == brute([(0, [1.0, 2.0]), (100, [-1.0, 0.5]), (3, [0.0, 0.0])], 10, 100)
    assert topk.top_products(df.limit(0)).count() == 0
