"""Hot triggers of the substring dedup: dealt by phrase and string, with the results of the plain way and of brute force."""

import hashlib
import random

import numpy as np
import pytest

from lodestone.llm import suffix_dedup

SPAN = 50


def brute(rows):
    """Per row: removed bytes, removed runs, hash of the rest."""
    first = {}
    for i, t in rows:
        raw = (t or "").encode()
        for k in range(len(raw) - SPAN + 1):
            w = raw[k : k + SPAN]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - SPAN + 1):
            if first[raw[k : k + SPAN]] < i:
                gone[k : k + SPAN] = True
        runs = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(raw) else 0
        out.append((i, len(raw), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(raw, np.uint8)[~gone])).hexdigest()))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    """One heading in ever new surroundings, in a third of all texts and many times in one; longer passages, nulls, repeated rows."""
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(400)]

    def some(n):
        return " ".join(rng.choices(words, k=n))

    heading, passage = "Frequently asked questions", some(30)
    out = []
    for i in range(150):
        t = some(rng.randint(20, 60))
        if i % 3 == 0:
            t = f"{t} {heading} {some(20)}"
        if i % 10 == 0:
            t = f"{t} {passage} {heading} {some(5)}"
        out.append((i * 3, t))
    out.append((1000, " ".join(f"{some(2)} {heading}" for _ in range(60))))
    out += [(1001, out[0][1][5:] + " é" + heading), (1002, None), (1003, ""), (1004, "x" * 300), (1005, "y" + "x" * 120)]
    return out + [out[3]]


@pytest.mark.parametrize("least", [0, 2, 1 << 16])
def test_hot_triggers_equal_brute_force(spark, rows, least):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = suffix_dedup.remove_repeats(docs, part_bytes=4096, keep_text=False, least_hot=least)
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_hot_list_keeps_the_largest(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    every = suffix_dedup.hot_triggers(docs, least=2)
    assert len(every) > 3 and (np.diff(every.astype(object)) > 0).all()
    largest = suffix_dedup.hot_triggers(docs, least=2, most=3)
    assert len(largest) == 3 and set(largest) <= set(every)
    assert not len(suffix_dedup.hot_triggers(docs.limit(0)))
