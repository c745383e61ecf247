"""Mixing against a seat-by-seat Sainte-Lague and a block-by-block selection; shards shared in bundles; op2's repeated rows."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lodestone.llm import mixing, packing

SCHEMA = "doc_id long, text string, source string"


def seats(weights, total):
    """Seats given one by one to the highest weight / (2 s + 1), ties to the first."""
    got = [0] * len(weights)
    for _ in range(total if any(w > 0 for w in weights) else 0):
        i = min(range(len(weights)), key=lambda i: (-weights[i] / (2 * got[i] + 1), i))
        got[i] += 1
    return got


def targets(sizes, weights):
    """Capped proportional sharing by fixing one source after the other at its cap."""
    left, free, out = 1.5 * sum(sizes), set(range(len(sizes))), {}
    while free:
        level = left / sum(weights[i] for i in free)
        over = [i for i in free if weights[i] * level > 2 * sizes[i]]
        if not over:
            return [out.get(i, weights[i] * level) for i in range(len(sizes))]
        for i in over:
            out[i] = 2.0 * sizes[i]
            left -= out[i]
            free.discard(i)
    return [out[i] for i in range(len(sizes))]


@pytest.mark.parametrize("bundle", [4096, 2])
def test_quotas_and_blocks_against_brute_force(spark, bundle):
    rng = random.Random(6)
    names = ["a", "b", "B", "é", None]
    docs = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 40, 300])), rng.choices(names, [5, 1, 1, 1, 2])[0]) for i in range(400)]
    block, per, seed = 4, 16, 7
    df = spark.createDataFrame(docs, SCHEMA)
    got = {r.doc_id: r for r in mixing.mix(df, block=block, shard_docs=per, bundle=bundle).collect()}
    order = {r.doc_id: r.o for r in df.select("doc_id", F.xxhash64(F.lit(seed), "doc_id", F.xxhash64("text")).alias("o")).collect()}
    size = {i: len(t.split()) for i, t, _ in docs}
    by = sorted({s for *_, s in docs}, key=lambda s: (s is None, s))
    sizes = [sum(size[i] for i, _, s in docs if s == name) for name in by]
    want = targets(sizes, [(3, 1, 2)[k % 3] for k in range(len(by))])
    quotas = seats(want, round(sum(want) / block))
    for name, total, target, quota in zip(by, sizes, want, quotas):
        own = [i for i, _, s in docs if s == name]
        n = -(-len(own) // per)
        shards = {}
        for i in own:
            shards.setdefault(order[i] % n, []).append(i)
        keys = sorted(shards)
        words = {k: sum(size[i] for i in shards[k]) for k in keys}
        bundles = sorted({k // bundle for k in keys})
        share = dict(zip(bundles, seats([sum(words[k] for k in keys if k // bundle == b) for b in bundles], quota)))
        given = {}
        for b in bundles:
            inside = [k for k in keys if k // bundle == b]
            given |= dict(zip(inside, seats([words[k] for k in inside], share[b])))
        first = {r.k: r.h for r in spark.createDataFrame([(name, k) for k in keys], "source string, k long").select("k", F.xxhash64(F.lit(seed + 1), F.struct("source"), "k").alias("h")).collect()}
        for k in keys:
            line = [i for i in sorted(shards[k], key=lambda i: order[i]) for _ in range(size[i])]
            blocks = max(1, -(-len(line) // block))
            take = min(given[k], 2 * blocks)
            taken = Counter()
            for j in range(take):
                at = j // blocks * 0 + (j if j < take // blocks * blocks else first[k] % blocks + j) % blocks
                taken.update(line[at * block : at * block + block])
            for i in shards[k]:
                r = got[i]
                assert (r.size, r.source_size, r.taken) == (size[i], total, taken[i]) and abs(r.target - target) < 1e-6


def test_repeated_rows_are_packed_in_many_groups(spark):
    rows = [(7, "same words again", "s")] * 3000 + [(None, "no id", "s")] * 1500 + [(i, f"other {i}", "s") for i in range(100, 160)]
    pieces = packing.pack(spark.createDataFrame(rows, SCHEMA), group_docs=512).collect()
    assert Counter(r.doc_id for r in pieces) == Counter(r[0] for r in rows)
    per = Counter(r.sequence_id >> 32 for r in pieces)
    assert len(per) == 9 and max(per.values()) < 1000
