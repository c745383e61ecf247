import random


import random

import pytest

import corpus_pipeline
from lodestone.llm import mixing, near_dup, quality, secrets

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stage_links_between_80_and_85(spark):
    base = [f"word{i}" for i in range(104)]  # 100 shingles
    near = base[:50] + ["other", "words"] + base[52:]  # shares 94 of 106
    far = base[:20] + ["x"] + base[21:60] + ["y"] + base[61:]  # shares 90 of 110: Jaccard 0.818
    far_two = [f"z{w}" for w in far]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (base, far)]
    assert 80 <= 100 * len(sets[0] & sets[1]) / len(sets[0] | sets[1]) < 85
    docs = spark.createDataFrame([(i, " ".join(w), "en", "a", 1) for i, w in enumerate((base, near, far, far_two))], SCHEMA)
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()} == {0, 3}
    assert {r.doc_id for r in near_dup.near_duplicates(docs).collect() if r.kept} == {0, 2, 3}


def prose(rng, n):
    return ["".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 8))) + str(rng.randint(0, 10**6)) for _ in range(n)]


@pytest.fixture(scope="module")
def verdicts(spark):
    rng = random.Random(7)
    texts = {i: " ".join(prose(rng, 80)) for i in range(300)}
    texts[1000] = " ".join(w * 4 for w in prose(rng, 80))  # long words
    texts[1001] = " ".join(w + "#" for w in prose(rng, 80))  # symbols
    texts[1002] = "\n".join(f"sep\n{' '.join(prose(rng, 5))}" for _ in range(16))  # 15 of 32 lines repeat, no window of words does
    passage = " ".join(prose(rng, 24))
    texts[1003] = f"{passage} {' '.join(prose(rng, 52))} {passage}"  # 48 of 100 words repeat, in one line
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in texts.items()], SCHEMA)
    return {r.doc_id: r for r in quality.judged(docs, "doc_id").collect()}


@pytest.mark.parametrize("i", range(4), ids=["word length", "symbols", "duplicate lines", "repeated words"])
def test_one_statistic_alone_is_an_outlier(verdicts, i):
    r = verdicts[1000 + i]
    assert not r.base_failed and not r.kept
    assert all(verdicts[i].kept for i in range(300))


def found(spark, rows):
    return {r.doc_id: r for r in secrets.find_secrets(spark.createDataFrame([(i, t, "en", s, 1) for i, t, s in rows], SCHEMA)).collect()}


def test_copies_of_one_text_leave_a_secret_live(spark):
    key = "Qw3rTyUiOpAsDfGhJk12L"
    got = found(spark, [(i, f"see {key}", f"s{i}") for i in range(12)] + [(100 + i, f"own {i} Zx8cVbNmAsDfGhJkL5qWe", f"s{i % 3}") for i in range(12)])
    assert all((got[i].spans, got[i].n_live, got[i].n_example) == ("owned:4:25", 1, 0) for i in range(12))
    assert all((got[100 + i].spans, got[100 + i].n_live, got[100 + i].n_example) == ("", 0, 1) for i in range(12))


def test_candidates_by_entropy(spark):
    keys = ["k3v9x2m8q5w7r1t6z4p0", "MZXW6YTBOI5QKRCHN2VD", "83920174655019382746", "qLwPzKdMxVbTnRgHsYcJ"]
    prose = ["internationalization", "losasmentementementemente", "aaaaaaaaaaaaaaaaaaaa", "state-of-the-art-and-so-on"]
    assert all(map(secrets.credential_like, keys)) and not any(map(secrets.credential_like, prose))
    got = found(spark, [(i, f"see {k}", "a") for i, k in enumerate(keys + prose)])
    assert [got[i].n_live for i in range(8)] == [1] * 4 + [0] * 4


def test_tied_sources_share_the_whole_mix(spark):
    sizes = spark.createDataFrame([(s, 1, 1200) for s in "abcdef"], "source string, n_docs long, source_size long")
    got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    assert sum(got.values()) == pytest.approx(1.5 * 6 * 1200)
    assert got["b"] == pytest.approx(1000) and got["a"] == got["d"] == 2400
