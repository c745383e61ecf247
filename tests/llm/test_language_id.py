"""Prediction by partial matching: code lengths against a dictionary model, probabilities that add up to one, held-out accuracy, defined cases."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from lodestone.llm import language_id as li

SCHEMA = "doc_id long, text string, lang string, source string"


def plain_model(texts, order):
    seen = defaultdict(Counter)
    for t in texts:
        t = b"\n" * order + t
        for i in range(order, len(t)):
            for k in range(order + 1):
                seen[t[i - k : i]][t[i]] += 1
    return seen


def plain_probability(seen, context, byte):
    p, out = 1.0, set()
    for k in range(len(context), -1, -1):
        f = seen.get(context[len(context) - k :])
        if not f:
            continue
        rest = {s: n for s, n in f.items() if s not in out}
        escape = len(rest) if len(f) < 256 else 0
        total = sum(rest.values()) + escape
        if byte in rest:
            return p * rest[byte] / total
        if escape:
            p *= escape / total
        out |= set(f)
    return p / (256 - len(out))


def tree_of(texts, order):
    _, g, n = li.grams_of([p for t in texts for p in li.pieces_of(t, order, 10**6)], order)
    g, at = np.unique(g, return_inverse=True)
    return li.ContextTree(g, np.bincount(at, n, len(g)), order)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_exact_code_lengths(order):
    rng = random.Random(order)
    learned = [bytes(rng.choice(b"abcd \xc3\xa9") for _ in range(rng.randint(0, 60))) for _ in range(20)]
    tree, seen = tree_of(learned, order), plain_model(learned, order)
    texts = [b"", b"abcabc", "né zz".encode(), learned[0], bytes(range(256)), b"ab" * 300]
    want = [-sum(math.log2(plain_probability(seen, (b"\n" * order + t)[i : i + order], t[i])) for i in range(len(t))) for t in texts]
    for batch in (7, 1 << 20):
        assert np.allclose(li.code_lengths(texts, [tree], order, batch)[:, 0], want)


def test_probabilities_add_up_to_one():
    rng = random.Random(5)
    learned = [bytes(rng.choice(b"abcdefgh ") for _ in range(400)), bytes(range(256))]
    for texts in (learned, learned[:1], []):
        tree = tree_of(texts, 3)
        for context in (b"abc", b"zzz", b"\n\n\n", b"\x01\x02\x03", b"ab "):
            base = int.from_bytes(context, "big") << 8
            assert abs(np.exp2(-tree.bits(np.arange(base, base + 256, dtype=np.uint64))).sum() - 1) < 1e-9


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = li.op13_language_id(spark, sf).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert held and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_defined_cases(spark, tmp_path):
    docs = [(0, "the cat sat on the mat. " * 30, "en", "a"), (1, "die katze sass auf der matte. " * 30, "de", "a"), (3, None, "en", "a"), (4, "", "en", "b"), (5, "123 ... 456", "de", "b"), (6, "the mat", None, "b"), (None, "die matte", None, "b"), (7, "der " * 500_000, "en", None)]
    spark.createDataFrame([(*d, 1.0) for d in docs], SCHEMA + ", score double").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in li.op13_language_id(spark, str(tmp_path)).collect()}
    assert {k: got[k].lang_pred for k in (0, 1, 3, 4, 5, 6, None)} == {0: "en", 1: "de", 3: "und", 4: "und", 5: "und", 6: "en", None: "de"}
    assert got[3].score == got[5].score == 0 and not got[None].held_out


def test_nothing_learned(spark):
    docs = spark.createDataFrame([(1, "abc", None, None)], SCHEMA)
    assert [tuple(r)[2:4] for r in li.identified(docs, li.fitted(docs.filter("lang IS NOT NULL"))).collect()] == [("und", 0.0)]
    assert not li.identified(spark.createDataFrame([], SCHEMA), {}).collect()


def test_sample_and_gram_bounds(spark):
    docs = spark.createDataFrame([(i, "".join(random.Random(i).choices("abcdefghijklmnop ", k=6000)), "en" if i % 2 else "de", None) for i in range(40)], SCHEMA)
    model = li.fitted(docs, most_grams=20_000)
    assert sorted(model) == ["de", "en"] and sum(len(li.unpack(g, np.uint64)) for g, _ in model.values()) <= 20_000
    assert li.fitted(docs) == li.fitted(docs)  # reruns agree
