"""Distances of the quality rules against a NumPy form of the same estimator, for large, small and single-row groups."""

import math
import random

import numpy as np
import pytest

from lodestone.llm import quality

SCHEMA = "doc_id long, text string, lang string, source string"


def text(rng, n, odd):
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) + ("#" * (6 if odd > 0.4 else 1) if rng.random() < odd else "") for _ in range(n)]
    return "\n".join(" ".join(words[i : i + 9]) for i in range(0, n, 9))


def bins(d):
    return np.floor(16 * np.log2(d + 1e-6)).astype(int)


def quantile(d, q):
    b = np.sort(bins(d))
    return b[math.ceil(q * len(b) - 1e-12) - 1]


def median(x):
    return np.sort(x, axis=0)[math.ceil(len(x) / 2) - 1]


def dist(x, m, s):
    y = x - m
    return np.einsum("ij,jk,ik->i", y, np.linalg.inv(s + np.diag(np.square(quality.FLOORS))), y)


def logdet(s):
    return np.linalg.slogdet(s + np.diag(np.square(quality.FLOORS)))[1]


def mcd(groups):
    est = {}
    for g, x in groups.items():
        med = median(x)
        starts = {"m": (med, np.diag((1.4826 * median(np.abs(x - med))) ** 2)), "c": (x.mean(0), np.cov(x.T, bias=True))}
        est[g] = starts
    for _ in range(quality.STEPS):
        new = {g: {} for g in groups}
        for g, x in groups.items():
            for s, (m, c) in est[g].items():
                d = dist(x, m, c)
                sub = x[bins(d) <= quantile(d, quality.SUBSET)]
                new[g][s] = (sub.mean(0), np.cov(sub.T, bias=True))
        done = all(abs(logdet(new[g][s][1]) - logdet(est[g][s][1])) <= quality.TOLERANCE for g in groups for s in "mc")
        est = new
        if done:
            break
    best = {g: min((e["m"], e["c"]), key=lambda v: logdet(v[1])) for g, e in est.items()}

    def pooled(values):
        out = {}
        for g in groups:
            same = [h for h in groups if h[0] == g[0]]
            p = sum(len(groups[h]) * values[h] for h in same) / sum(len(groups[h]) for h in same)
            out[g] = (len(groups[g]) * values[g] + quality.PRIOR * p) / (len(groups[g]) + quality.PRIOR)
        return out

    def scaled(est):
        m, c = pooled({g: e[0] for g, e in est.items()}), pooled({g: e[1] for g, e in est.items()})
        half = {g: max(2 ** ((quantile(dist(x, m[g], c[g]), 0.5) + 0.5) / 16) / quality.MEDIAN, 1.0) for g, x in groups.items()}
        return m, c, pooled(half)

    m, c, k = scaled(best)
    again = {}
    for g, x in groups.items():
        sub = x[dist(x, m[g], c[g]) <= quality.REWEIGHT * k[g]]
        again[g] = (sub.mean(0), np.cov(sub.T, bias=True)) if len(sub) else (np.zeros(4), np.zeros((4, 4)))
    m, c, k = scaled(again)
    return {g: dist(x, m[g], c[g]) / k[g] for g, x in groups.items()}


@pytest.mark.parametrize("seed", [1])
def test_distances_against_numpy(spark, seed):
    rng = random.Random(seed)
    sizes = {("en", "a"): 150, ("en", "b"): 12, ("en", None): 1, ("de", "a"): 40, (None, "b"): 3}
    rows = []
    for (lang, source), n in sizes.items():
        for _ in range(n):
            rows.append((len(rows), text(rng, rng.randint(55, 120), 0.5 if rng.random() < 0.05 else 0.04), lang, source))
    got = quality.judged(spark.createDataFrame(rows, SCHEMA), "doc_id", "lang", "source").collect()
    groups, ids = {}, {}
    for r in sorted(got, key=lambda r: r.doc_id):
        w, n = rows[r.doc_id][1].split(), r.n_words
        lines = rows[r.doc_id][1].split("\n")
        assert not r.base_failed and r.n_symbols == rows[r.doc_id][1].count("#") and r.n_dup_lines == len(lines) - len(set(lines)) and n == len(w)
        x = [math.log(r.word_chars / n), math.log1p(100 * r.n_symbols / n), math.log1p(100 * r.n_dup_lines / (len(lines) + 20)), math.log1p(100 * r.n_repeat_words / (n + 200))]
        groups.setdefault((r.lang, r.source), []).append(x)
        ids.setdefault((r.lang, r.source), []).append(r)
    want = mcd({g: np.array(x) for g, x in groups.items()})
    for g, d in want.items():
        assert [r.distance for r in ids[g]] == pytest.approx(list(d), rel=1e-6)
    assert any(not r.kept for r in got) and sum(r.kept for r in got) > 0.9 * len(got)
