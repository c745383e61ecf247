"""Hard negatives against brute force: ties, copies of one vector, spread norms, numbers beyond doubles, defined cases, pruned buckets."""

import numpy as np
import pytest

from lodestone.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int"


def want(ids, x, labels, every, k=5):
    out = set()
    for a, i in enumerate(ids):
        if i % every:
            continue
        s = [int(t) for t in x @ x[a]]
        first = sorted((j for j in range(len(ids)) if j != a and labels[j] == labels[a]), key=lambda j: (-s[j], ids[j]))[:k]
        for p in first:
            far = sorted((j for j in range(len(ids)) if labels[j] != labels[a] and 80 * s[p] <= 100 * s[j] <= 100 * s[p]), key=lambda j: (-s[j], ids[j]))[:k]
            out |= {(i, ids[p], r + 1, ids[j], s[p], s[j]) for r, j in enumerate(far)}
    return out


@pytest.mark.parametrize("kind", ["ties", "copies", "spread", "huge"])
def test_against_brute_force(spark, kind):
    rng = np.random.default_rng(3)
    v = {"ties": rng.integers(-1, 3, (300, 6)) / 256, "copies": np.repeat(rng.random((5, 6)), 60, 0), "spread": rng.random((300, 6)) * np.exp(rng.standard_normal((300, 1)) * 2), "huge": rng.integers(0, 5, (300, 6)) * 2.0**19}[kind]
    ids, labels = [3 * i for i in range(300)], rng.integers(0, 3, 300).tolist()
    df = spark.createDataFrame([(i, [float(c) for c in x], n) for i, x, n in zip(ids, v, labels)], SCHEMA)
    got = [tuple(r) for r in hn.mined(df, every=10, block=48).collect()]
    expected = want(ids, np.floor(256 * v).astype(object).astype(int).astype(object), labels, 10)
    assert len(got) == len(set(got)) and set(got) == expected and expected


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.9, 0.0], 2), (3, None, 2), (4, [1.0, nan], 2), (5, [inf, 0.0], 2), (6, [1.0, None], 2), (7, [1.0, 0.0], None), (None, [1.0, 0.0], 2), (8, [1.0], 2), (9, [], 2), (11, [0.7, 0.0], 2)]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", score string")
    assert [tuple(r) for r in hn.mined(df).collect()] == [(0, 1, 1, 2, 65536, 256 * 230)]
    assert not hn.mined(spark.createDataFrame([], SCHEMA)).collect()
    assert not hn.mined(spark.createDataFrame([(0, [1.0], 1), (1, [-1.0], 1), (2, [-1.0], 2)], SCHEMA)).collect()  # a negative positive score: an empty window


def test_labels_of_sevenths_move(spark):
    df = spark.createDataFrame([(7, [1.0], 9), (8, [1.0], 9)], SCHEMA)
    assert {r.vec_id: r.label for r in hn.noised(df).collect()} == {7: 0, 8: 9}


def test_short_buckets_are_pruned():
    rng = np.random.default_rng(1)
    v = np.floor(rng.standard_normal((4096, 16)) * 64 * np.exp(-np.arange(4096) / 400)[:, None]).astype(np.int64)
    v = v[np.argsort(-(v**2).sum(1), kind="stable")]
    labels, win = np.zeros(4096, np.int64), np.array([[i, hn.LEAST, hn.MOST, hn.LEAST] for i in range(8)])
    (w, c, s), pruned = hn.best_in_block(np.arange(4096), labels, v, np.arange(8), labels[:8], v[:8], win, 5, True)
    for i in range(8):
        score = v @ v[i]
        score[i] = -(2**60)
        assert c[w == i].tolist() == sorted(range(4096), key=lambda j: (-score[j], j))[:5]
    assert pruned > 0
