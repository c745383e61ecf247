"""Scores against a brute-force Katz model of order three, and its normalisation, with and without hot histories."""

import math
import random
import zlib
from collections import Counter

import pytest

from lodestone.llm import katz

SCHEMA = "doc_id long, text string, k string"


def rows():
    rng = random.Random(9)
    out = []
    for i in range(400):
        n = rng.choice([0, 1, 2, 5, 30, 60])
        words = ["The"] if n else []
        while len(words) < n:
            words.append(f"w{int(60 * rng.random() ** 3)}" if rng.random() < 0.85 else rng.choice(["of", "the", "and", f"rare{rng.randrange(10**4)}"]))
        out.append((i, " ".join(words), "x"))
    return out + [(500, None, "x"), (None, "no id", "x"), (501, "w1 " * 3000, "x")] + out[:5]


class Brute:
    def __init__(self, docs):
        self.grams = {1: Counter(), 2: Counter(), 3: Counter()}
        for words in docs:
            t = ["<s>", "<s>", *words, "</s>"]
            for k in range(2, len(t)):
                for n in (1, 2, 3):
                    self.grams[n][tuple(t[k - n + 1 : k + 1])] += 1
        self.total = sum(self.grams[1].values())
        self.hist = {1: {(): self.grams[1]}}
        for n in (2, 3):
            by = {}
            for g, c in self.grams[n].items():
                by.setdefault(g[:-1], Counter())[g[-1:]] = c
            self.hist[n] = by
        self.d = {n: self.discounts(Counter(self.grams[n].values())) for n in (1, 2, 3)}

    @staticmethod
    def discounts(n):
        d, a = {}, 6 * n[6] / n[1] if n[1] else 1.0
        for r in range(1, 6):
            x = ((r + 1) * n[r + 1] / n[r] / r - a) / (1 - a) if n[r] and a != 1 else 0
            d[r] = x if 0 < x < 1 else (r - 0.5) / r
        return d

    def seen(self, n, h, w):
        r, c = self.hist[n][h][(w,)], sum(self.hist[n][h].values())
        low = sum((1 - self.d[n][k]) * k for k in self.hist[n][h].values() if k <= 5)
        return (c / (c + 1) if low / c < 1e-12 else 1) * self.d[n].get(r, 1) * r / c

    def p(self, n, h, w):
        if n == 1:
            left = 1 - sum(self.seen(1, (), x[0]) for x in self.grams[1])
            return self.seen(1, (), w) if self.grams[1][(w,)] else left
        if h not in self.hist[n]:
            return self.p(n - 1, h[1:], w)
        if self.hist[n][h][(w,)]:
            return self.seen(n, h, w)
        after = [x[0] for x in self.hist[n][h]]
        key = (n, h)
        if key not in self.__dict__.setdefault("memo", {}):
            self.memo[key] = (1 - sum(self.seen(n, h, x) for x in after)) / (1 - sum(self.p(n - 1, h[1:], x) for x in after))
        return self.memo[key] * self.p(n - 1, h[1:], w)


def words_of(text):
    return [w.lower() for w in (text or "").split()]


@pytest.fixture(scope="module")
def model():
    return Brute([words_of(t) for i, t, _ in rows() if i is not None and zlib.crc32(str(i).encode()) % 10])


@pytest.mark.parametrize("hot", [10**6, 25])
def test_scores_against_brute_force(spark, model, hot):
    got = sorted(katz.score(spark.createDataFrame(rows(), SCHEMA), part_bytes=4000, block_bytes=3000, hot=hot).collect(), key=lambda r: (r.doc_id is None, r.doc_id, r.score))
    texts = {i: words_of(t) for i, t, _ in rows()}
    assert len(got) == len(rows())
    for r in got:
        t = ["<s>", "<s>", *texts[r.doc_id], "</s>"]
        want = sum(math.log10(model.p(3, tuple(t[k - 2 : k]), t[k])) for k in range(2, len(t)))
        assert r.score == pytest.approx(want, rel=1e-9, abs=1e-9)
        v, n = len(model.grams[1]), model.total
        base = sum(math.log10((model.grams[1][(w,)] + 0.1) / (n + 0.1 * (v + 1))) for w in t[2:])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t) - 2, sum(model.grams[1][(w,)] > 0 for w in t[2:]), n) and r.base_score == pytest.approx(base)


def test_probabilities_sum_to_one(model):
    every = [g[0] for g in model.grams[1]] + ["never seen"]
    for n, h in [(1, ()), (2, ("the",)), (3, ("of", "the")), (3, ("<s>", "<s>")), (3, ("w1", "w1")), (3, ("never", "the")), (2, ("never",))]:
        assert sum(model.p(n, h, w) for w in every) == pytest.approx(1)


def test_tables_are_stored(spark):
    tables = {}
    katz.score(spark.createDataFrame(rows(), SCHEMA), part_bytes=4000, block_bytes=3000, tables=tables).count()
    assert {k: t.count() > 0 for k, t in tables.items()} == {"words": True, "bigrams": True, "trigrams": True}
