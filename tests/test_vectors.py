"""Blocked inner-product search against numpy: close unit vectors, ties, filters, grid of blocks, bad values; the retriever's filter sets."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.operators import search as Q
from lodestone.operators import vectors as V

SCHEMA = "chunk_id long, v array<double>, g long"


def best(v, ids, q, n, seen):
    score = {i: float(np.add.accumulate(v[k] * q)[-1]) for k, i in enumerate(ids) if seen(k)}
    return sorted(score.items(), key=lambda x: (-x[1], -x[0]))[:n]


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.search, r.rank)):
        out.setdefault(r.search, []).append((r.chunk_id, r.score))
    return out


@pytest.mark.parametrize("small", [V.SMALL_BYTES, 0])
@pytest.mark.parametrize("kind", ["close", "ties"])
def test_against_numpy(spark, small, kind):
    rng = np.random.default_rng(7)
    if kind == "close":  # unit vectors that differ in the third decimal
        v = 1 + rng.integers(-3, 4, (400, 12)) / 1000
        v /= np.sqrt((v * v).sum(1))[:, None]
    else:
        v = np.repeat(rng.standard_normal((8, 12)), 50, 0)
    ids, group = rng.permutation(4000)[:400].tolist(), rng.integers(0, 6, 400).tolist()
    group[3] = None
    q = v[rng.choice(400, 30)] * 1.5
    allow = [None if k % 3 == 0 else [] if k % 3 == 1 and k < 9 else rng.choice(8, 3, False).tolist() for k in range(30)]
    chunks = spark.createDataFrame([(i, x.tolist(), g) for i, x, g in zip(ids, v, group)], SCHEMA)
    asked = spark.createDataFrame([(k, x.tolist(), a) for k, (x, a) in enumerate(zip(q, allow))], "search long, q array<double>, allow array<long>")
    found = got(V.dense_top(chunks, asked, 7, small=small, rows=16, searches=8))
    for k in range(30):
        assert found.get(k, []) == best(v, ids, q[k], 7, lambda j: allow[k] is None or (group[j] is not None and group[j] in allow[k]))


def test_scores_are_not_rounded(spark):
    chunks = spark.createDataFrame([(1, [0.6, 0.8], 0), (2, [1.0, 0.0], 0), (3, [0.8, 0.6], 0)], SCHEMA)
    asked = spark.createDataFrame([("a", [0.6, 0.8])], "search string, q array<double>")
    assert [(r.chunk_id, round(r.score, 9)) for r in V.dense_top(chunks, asked, 3).orderBy("rank").collect()] == [(1, 1.0), (3, 0.96), (2, 0.6)]


def test_bad_values_and_empty_sides(spark):
    nan = float("nan")
    chunks = spark.createDataFrame([(1, [nan, 1.0], 0), (2, None, 0), (3, [1.0], 0), (4, [1.0, 1.0], 0), (5, [1e308, 1e308], 0)], SCHEMA)
    asked = spark.createDataFrame([(1, [1.0, 10.0]), (2, None)], "search long, q array<double>")
    assert got(V.dense_top(chunks, asked, 3)) == {1: [(4, 11.0)]}
    assert not V.dense_top(chunks, asked.limit(0), 3).collect() and not V.dense_top(chunks.limit(0), asked, 3).collect()
    names = spark.createDataFrame([("x", [1.0, 1.0], 0), ("y", [1.0, 1.0], 0)], "chunk_id string, v array<double>, g long")
    assert [r.chunk_id for r in V.dense_top(names, asked, 1).collect()] == ["y"]


def test_no_collect_of_vectors(spark):
    """Neither side's vectors pass through Python on the driver."""
    chunks = spark.createDataFrame([(i, [1.0 * i, 2.0], 0) for i in range(10)], SCHEMA)
    asked = chunks.select(F.col("chunk_id").alias("search"), F.col("v").alias("q"))
    plan = V.dense_top(chunks, asked, 2, small=0)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_filter_sets_against_the_rule(spark):
    rng = random.Random(3)
    some = lambda xs: rng.choice(xs)
    groups = [(i, some(["P1", "P2", None]), some(["ema", "fda", None]), some(["product", "guidance"]), some(["label", "review", None]), some(["Dosage", "Indications\x1fUse", ""])) for i in range(60)]
    filters = [(f, some(["P1", "P9", None]), some(["ema", None]), rng.random() < 0.3, rng.sample(["P1", "P2"], rng.randint(0, 2)), rng.sample(["label", "review"], rng.randint(0, 2)), some([[], ["dosage"], ["nothing"]])) for f in range(80)]
    g = spark.createDataFrame(groups, "g long, program_id string, agency string, doc_kind string, doc_type string, _path string")
    f = spark.createDataFrame(filters, "fid long, program_id string, agency string, guidance boolean, excluded array<string>, doc_types array<string>, label_sections array<string>")
    want = {}
    for fid, program, agency, guidance, out, types, secs in filters:
        rows = [r for r in groups if (program is None or r[1] == program) and (agency is None or r[2] == agency) and (not guidance or r[3] == "guidance") and (r[1] is None or r[1] not in out) and (not types or r[4] in types)]
        narrow = [r for r in rows if not secs or r[4] != "label" or any(s in r[5].lower() for s in secs)]
        if rows:
            want[fid] = sorted(r[0] for r in (narrow or rows))
    assert {r.fid: sorted(r.allow) for r in Q.visible(g, f).collect()} == want
