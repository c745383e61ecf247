"""The retriever as one plan against numpy, text repair and greedy election against plain loops."""

import random

import numpy as np

from lodestone.operators import search as Q
from lodestone.operators import selection


def test_retrieve_against_numpy(spark):
    rng = np.random.default_rng(3)
    v = rng.integers(-9, 9, (120, 6))
    kinds = [("P1", "ema", "product", "review"), ("P2", "fda", "product", "label"), (None, "ema", "guidance", "guidance")]
    chunks = [(i, v[i].tolist(), *kinds[i % 3], 1, f"k{i % 10}", ["Dosage" if i % 2 else "Indications"], f"own {i}", [1]) for i in range(120)]
    schema = "chunk_id long, v array<long>, program_id string, agency string, doc_kind string, doc_type string, index_document_id int, parent_key string, section_path array<string>, text string, pages array<int>"
    parents = spark.createDataFrame([(1, f"k{i}", f"parent {i}", [2]) for i in range(5)], "index_document_id int, parent_key string, text string, pages array<int>")
    asked = spark.createDataFrame([(1, "what about alpha"), (2, "nothing named")], "qid long, text string")
    q = {1: rng.integers(-9, 9, 6), 2: rng.integers(-9, 9, 6)}
    vectors = spark.createDataFrame([(i, x.tolist()) for i, x in q.items()], "qid long, q array<long>")
    none = spark.createDataFrame([], "chunk_id long, token string, w double")
    routing = Q.Routing(products=[("(?i)alpha", "P1")])
    got = Q.retrieve(asked, vectors, spark.createDataFrame(chunks, schema), parents, none, none.withColumnRenamed("chunk_id", "qid"), routing, k=5).collect()
    for qid, seen in ((1, [i for i in range(120) if i % 3 == 0]), (2, list(range(120)))):
        want = sorted(seen, key=lambda i: (-int(v[i] @ q[qid]), -i))[:5]
        rows = sorted((r for r in got if r.qid == qid), key=lambda r: r.place)
        assert [r.chunk_id for r in rows] == want
        assert [r.parent_text for r in rows] == [f"parent {i % 10}" if i % 10 < 5 else f"own {i}" for i in want]


def test_election_against_a_loop(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(f"file://{tmp_path}")
    rng = random.Random(2)
    pairs = {tuple(sorted(rng.sample(range(60), 2))) for _ in range(70)}
    near = {}
    for a, b in pairs:
        near.setdefault(b, []).append(a)
    reps, want = set(), {}
    for x in sorted({i for p in pairs for i in p}):
        first = min((a for a in near.get(x, []) if a in reps), default=None)
        reps |= {x} if first is None else set()
        want[x] = x if first is None else first
    got = selection.elected(spark.createDataFrame(sorted(pairs), "a long, b long"), spark.range(60).selectExpr("id AS doc_id", "id AS rank")).collect()
    assert {r.doc_id: r.representative for r in got} == want
