"""Top-k against brute force with many ties, and the postings an early proof leaves unread."""

import numpy as np
import pytest

from lodestone.llm import topk

SCHEMA = "vec_id long, embedding array<double>"


def want(x, ids, k, every):
    out = {}
    for q in [i for i in ids if i % every == 0]:
        s = x @ x[ids.index(q)]
        out[q] = [(ids[j], int(s[j])) for j in sorted(range(len(ids)), key=lambda j: (-s[j], ids[j])) if ids[j] != q][:k]
    return out


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


@pytest.mark.parametrize("kind", ["ties", "copies", "spread", "huge"])
def test_against_brute_force(spark, kind):
    rng = np.random.default_rng(5)
    v = {"ties": rng.integers(-1, 2, (300, 6)) / 64, "copies": np.repeat(rng.standard_normal((4, 6)), 75, 0), "spread": rng.standard_normal((300, 6)) * np.exp(rng.standard_normal((300, 1)) * 2), "huge": rng.integers(-3, 4, (300, 6)) * 2.0**22}[kind]
    ids = [3 * i for i in range(300)]
    rows = [(i, [float(c) for c in x]) for i, x in zip(ids, v)]
    x = np.floor(64 * v).astype(object).astype(int).astype(object)
    assert got(topk.top_k(spark.createDataFrame(rows, SCHEMA), k=7, block=64)) == want(x, ids, 7, 20)


def test_empty_and_few(spark):
    assert not topk.top_k(spark.createDataFrame([], SCHEMA)).collect()
    assert [(r.query_id, r.vec_id) for r in topk.top_k(spark.createDataFrame([(0, [1.0]), (1, [2.0])], SCHEMA)).collect()] == [(0, 1)]


def test_fewer_postings_than_the_product():
    rng = np.random.default_rng(1)
    v = np.floor(64 * rng.standard_normal((8192, 64)) / 8).astype(np.int64)
    index = topk.ImpactIndex(np.arange(8192), v)
    index.search(np.arange(40), v[:40])
    assert index.read < 0.8 * index.total
