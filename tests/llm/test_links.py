"""Near-duplicate links that only the last round can find, and brute force over families near the threshold."""

import random

import pytest

from lodestone.llm import near_dup

SCHEMA = "doc_id long, text string"


def sets_of(texts):
    out = {}
    for i, t in texts.items():
        w = t.lower().split()
        out[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} or ({tuple(w)} if w else set())
    return out


def brute(texts, percent=85):
    sets, parent = sets_of(texts), {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in ids}


def got(spark, texts):
    return {r.doc_id: r.component_id for r in near_dup.near_duplicates(spark.createDataFrame(list(texts.items()), SCHEMA)).collect()}


def test_link_beyond_a_best_partner_that_failed(spark):
    base = [f"w{i}" for i in range(990)]
    spots = [30 + 58 * i for i in range(16)]
    two = [f"x{i}" if i in spots else w for i, w in enumerate(base)]
    three = [w if i in spots[:2] else t for i, (w, t) in enumerate(zip(base, two))]
    three[971] = "elsewhere"
    texts = {1: " ".join(base), 2: " ".join(two), 3: " ".join(three)}
    s = sets_of(texts)
    assert 100 * len(s[1] & s[2]) < 85 * len(s[1] | s[2]) and 100 * len(s[1] & s[3]) >= 85 * len(s[1] | s[3])
    assert got(spark, texts) == {1: 1, 2: 1, 3: 1}


@pytest.mark.parametrize("seed", [1, 2])
def test_families_near_the_threshold(spark, seed):
    rng = random.Random(seed)
    texts = {}
    for family in range(60):
        base = [f"f{family}w{rng.randrange(5000)}" for _ in range(rng.randint(300, 1200))]
        for _ in range(6):
            words = list(base)
            for spot in rng.sample(range(len(words)), max(1, int(len(words) * rng.uniform(0.005, 0.035)))):
                words[spot] = f"n{rng.randrange(10**9)}"
            texts[len(texts) if rng.random() < 0.5 else 10_000 + len(texts)] = " ".join(words)
    assert got(spark, texts) == brute(texts)
