"""Small cases of the findings of round 5, each against the query's SQL or a plain version."""

import pandas as pd
from test_findings_r04 import same_as_sql

from lodestone import catalog


def test_words_without_a_place_come_last(spark, tmp_path):
    l = pd.DataFrame({"l_orderkey": [1, 1, 1, 1, 2, 2, 3, 3], "l_partkey": [None, 5, 9, 60, None, None, 7, 13], "l_quantity": [4.0, 4.0, None, 1.0, 1.0, 2.0, 5.5, 1.0]}).astype({"l_partkey": "Int64"})
    got = same_as_sql(spark, tmp_path, "merged_columns", lineitem=l)
    assert len(got) == 6


def families(n: int):
    """Texts in families of near and equal copies, a line that all share, texts without a shingle, of no language and of one long word."""
    import random

    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(3, 6)))
    line, bases = " ".join(word() for _ in range(12)), [[word() for _ in range(40)] for _ in range(n // 12)]
    rows = []
    for i in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
            w[rng.randrange(len(w))] = word()
        rows.append((i * 7 % n, rng.choice(["en", "de", None]), rng.choice(["", "É1 ab "]) + " ".join(w).title() + ". " + line * rng.randint(0, 1)))
    rows += [(n, "en", "one two three four"), (n + 1, "en", None), (n + 2, "de", ""), (n + 3, "en", "x" * 5000 + " " + line), (n + 4, "en", line)]
    return pd.DataFrame(rows, columns=["doc_id", "lang", "text"])


def test_near_duplicates_in_buckets_as_sql(spark, tmp_path, monkeypatch):
    from lodestone.operators import near_duplicates as ND

    monkeypatch.setattr(ND, "TASK_SHINGLES", 1000)
    monkeypatch.setattr(ND, "HELD", 300)
    docs = families(240)
    pairs = same_as_sql(spark, tmp_path, "near_dup_pairs", documents=docs)
    assert (pairs.jaccard < 1).sum() > 50 and pairs.lang.isna().sum() > 0  # copies of no language are a class too
    for name in ("near_dup_classes", "near_dup_reps"):
        same_as_sql(spark, tmp_path, name, documents=docs)


def test_sets_that_share_too_little_go_no_further(spark):
    from lodestone.operators import near_duplicates as ND

    line = "alpha beta gamma delta epsilon zeta theta"
    own = lambda i: " ".join(f"w{chr(97 + i)}{chr(97 + j)}x" for j in range(20))
    texts = [f"{own(i)} {line}" for i in range(9)] + [own(3) + " omega"]
    sets = ND.written(ND.shingle_sets(spark.createDataFrame([(i, "en", x) for i, x in enumerate(texts)], "doc_id long, lang string, text string")))
    some = ND.shared(sets.select("u", "n", "set"), 0.6, 200).join(sets.select("u", "doc_id"), "u").collect()
    assert {r.doc_id for r in some} == {3, 9}  # the line alone brings no one together


def test_texts_of_a_repeated_id_are_one_set(spark):
    from lodestone.operators import near_duplicates as ND

    rows = [(1, "en", "one two three four five"), (1, "en", "six seven eight nine ten"), (2, "en", "six seven eight nine ten"), (3, "en", "one two three four five. six"), (3, "de", "one two three four five")]
    rows = [(i, lang, x.replace("one", "uno").replace("two", "due").replace("six", "sei").replace("ten", "dieci")) for i, lang, x in rows]
    member, between = ND.near_classes(spark.createDataFrame(rows, "doc_id long, lang string, text string"))
    assert sorted((r.doc_id, r.rep, r.n) for r in member.collect()) == [(1, 1, 2), (2, 2, 1), (3, 3, 1), (3, 3, 2)] and between.isEmpty()


def test_codes_and_studies_are_never_broadcast(spark, tmp_path):
    part = pd.DataFrame({"p_partkey": range(300), "p_name": [None if i % 50 == 0 else f"Sb {i % 7} lace-{i}" for i in range(300)]})
    supplier = pd.DataFrame({"s_suppkey": [*range(60), 5, 5, 1234567]})
    assert len(same_as_sql(spark, tmp_path, "trial_search", part=part[part.p_name.notna()], supplier=supplier)) > 300
    plan = catalog.queries()["trial_search"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "ShuffledHashJoin" in plan


def test_mentions_against_a_plain_search(spark):
    import random

    from lodestone.operators import containment as CT

    rng = random.Random(3)
    some = lambda n: "".join(rng.choices("abé☃1", k=n))
    texts = [(f"t{i}", some(rng.randint(0, 120))) for i in range(3000)] + [("null", None)]
    quotes = {some(rng.randint(1, 9)) for _ in range(200)} | {b[5:75] for _, b in texts[:300] if len(b) > 80} | {"", "zz", "z" * 90}
    got = CT.mentioned(spark.createDataFrame(texts, "text_id string, body string"), spark.createDataFrame([(q,) for q in sorted(quotes) * 2] + [(None,)], "quote string")).collect()
    assert sorted(map(tuple, got)) == sorted((t, q) for t, b in texts if b for q in quotes if q and q in b)
    none = spark.createDataFrame([("",)], "quote string")
    assert CT.mentioned(spark.createDataFrame(texts, "text_id string, body string"), none).isEmpty()
