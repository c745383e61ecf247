"""Quotes by seeds and near-duplicate classes against brute force."""

import random

import pytest

from lodestone.operators import containment as CT
from lodestone.operators import near_duplicates as ND


@pytest.mark.parametrize("keyed", [False, True])
def test_quotes_of_every_length(spark, keyed):
    rng = random.Random(5)
    letters = ["a", "b", "c", "é", "漢"]
    texts = [(i, i % 3, "".join(rng.choices(letters[: 3 + 2 * (i % 2)], k=rng.choice([0, 1, 3, 20, 200, 3000])))) for i in range(40)] + [(40, 0, None)]
    quotes = []
    for j in range(200):
        t = rng.choice(texts)[2] or "zz"
        at, n = rng.randrange(max(1, len(t))), rng.choice([1, 2, 3, 5, 8, 15, 16, 17, 26, 27, 28, 60])
        quotes.append((j, rng.randrange(3), t[at : at + n] if rng.random() < 0.8 else "".join(rng.choices(letters, k=n))))
    quotes += [(200, 0, None), (201, 0, ""), (202, None, "a"), quotes[0]]
    want = {(i, j) for i, k, t in texts for j, m, q in quotes if t is not None and q and q in t and (not keyed or k == m)}
    got = CT.contained(spark.createDataFrame(texts, "text_id long, k long, body string"), spark.createDataFrame(quotes, "quote_id long, k long, quote string"), "k" if keyed else None).collect()
    assert len(got) == len(set(got)) and {(r.text_id, r.quote_id) for r in got} == want and want


def test_no_quotes_or_texts(spark):
    texts, quotes = spark.createDataFrame([(1, "abc")], "text_id long, body string"), spark.createDataFrame([(1, "b")], "quote_id long, quote string")
    assert not CT.contained(texts, quotes.limit(0)).collect() and not CT.contained(texts.limit(0), quotes).collect()
    assert [tuple(r) for r in CT.contained(texts, quotes).collect()] == [(1, 1)]


def sets(text, k=5):
    import re

    w = re.findall("[a-z]{3,}", text.lower())
    return frozenset(" ".join(w[i : i + k]) for i in range(len(w) - k + 1))


def test_classes_and_links(spark, tmp_path):
    rng = random.Random(2)
    base = [[f"w{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(40)] for _ in range(6)]
    docs = []
    for i in range(150):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            words[rng.randrange(len(words))] = f"x{chr(97 + rng.randrange(26))}q"
        docs.append((i, rng.choice(["en", "de"]), " ".join(words)))
    docs += [(150, "en", ""), (151, "en", None), (152, None, docs[0][2])]
    df = spark.createDataFrame(docs, "doc_id long, lang string, text string")
    of = {i: (lang, sets(t or "")) for i, lang, t in docs}
    linked = lambda a, b: of[a][0] == of[b][0] and of[a][0] and of[a][1] and of[b][1] and len(of[a][1] & of[b][1]) >= 0.6 * len(of[a][1] | of[b][1])
    got = {r.doc_id: r for r in ND.counted(*ND.near_classes(df)).collect()}
    assert len(got) == len(docs)
    for i in of:
        assert got[i].n_links == sum(1 for j in of if j != i and linked(i, j))
        same = [j for j in of if of[j] == of[i]] if of[i][1] else [i]
        assert (got[i].class_id, got[i].class_size) == (min(same), len(same))


def test_a_family_of_copies_is_one_row_each(spark):
    text = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    df = spark.range(10_000).selectExpr("id AS doc_id", "'en' AS lang", f"'{text}' AS text")
    member, between = ND.near_classes(df)
    assert between.isEmpty() and ND.counted(member, between).selectExpr("count(*) AS n", "min(n_links) AS lo", "max(n_links) AS hi", "max(class_id) AS c").head() == (10_000, 9_999, 9_999, 0)
