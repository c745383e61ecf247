"""Findings of round 4 on growth: what a step holds or repeats, beside the same results."""

import random

import numpy as np
from pyspark.sql import functions as F

from lodestone.functions import repair as RP
from lodestone.operators import claims as C
from lodestone.operators import containment as CT


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_prompt_budget_is_one_stream(spark):
    """no list per search, and the blocks are read once."""
    rng = random.Random(3)
    rows = [(rng.randrange(4), i, rng.choice("ABC"), rng.randrange(1, 60)) for i in range(600)]
    rows += [(9, 1000, None, None), (9, 1001, "A", 5)]
    questions = spark.createDataFrame([(s, "q" * 8) for s in [0, 1, 2, 3, 9]], "search long, question string")
    out = C.within_budget(spark.createDataFrame(rows, "search long, first_rank long, product string, cost long"), questions, 900, 100)
    want = {}
    for s in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == s), key=lambda r: r[1])
        met, nth, items, used = {}, {}, [], 102
        for _, rank, product, cost in own:
            met.setdefault(product, rank)
            nth[product] = nth.get(product, 0) + 1
            items.append((nth[product], met[product], rank, cost))
        for _, _, rank, cost in sorted(items, key=lambda x: x[:3]):
            want[rank] = cost is not None and used + cost <= 900
            used += cost if want[rank] else 0
    assert {r.first_rank: r.admitted for r in out.collect()} == want and len(set(want.values())) == 2
    assert "collect_list" not in plan(out)


def test_lost_letters_in_place(spark, monkeypatch):
    """a reading that differs in nothing but lost letters needs no alignment, and gives what the alignment gives."""
    rng = random.Random(4)
    pairs = []
    for _ in range(400):
        other = "".join(rng.choices("abv vvc", k=rng.choice([1, 3, 8, 40, 120])))
        pairs.append((other.replace("v", RP.LOST), other))
    quick = [RP.filled(*p) for p in pairs]
    with monkeypatch.context() as m:
        m.setattr(RP, "ALIGNED", 0)
        assert quick == [RP.filled(*p) for p in pairs] and len({x is None for x in quick}) == 2
    monkeypatch.setattr(RP, "segments", None)
    assert RP.filled(f"Begin {RP.LOST}ery long end", "Begin very long end") == "Begin very long end"


def test_stretches_by_pieces(spark, monkeypatch):
    """long texts are hashed piece by piece and stretches handed on in parts."""
    raw = np.frombuffer("".join(random.Random(5).choices("abcd", k=3000)).encode(), np.uint8)
    for gram, span, _ in CT.LEVELS:
        whole = CT.stretch_hashes(raw, gram, span)
        for size in (1, 7, 500, 2999):
            monkeypatch.setattr(CT, "PIECE", size)
            assert (CT.stretch_hashes(raw, gram, span) == whole).all()
            assert all((CT.stretch_hashes(raw[:n], gram, span) == CT._piece_hashes(raw[:n].astype(np.uint64), gram, span)).all() for n in range(60))
        monkeypatch.undo()


def test_garble_suspicion_joins_nothing(spark, tmp_path):
    """texts are not shuffled to meet their own scores; repeated ids stay as often as they come."""
    from lodestone import catalog

    rows = [(i, "plain words of a sentence that stand here") for i in range(20)] + [(20, "xq zz kk wq bcdfg hjklm xq zz"), (21, "ab"), (20, "xq zz kk wq bcdfg hjklm xq zz"), (22, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = catalog.queries()["garble_suspicion"](spark, str(tmp_path))
    assert "Join" not in plan(out)
    assert sorted((r.doc_id, r.garbled) for r in out.collect()) == sorted((i, i == 20) for i, _ in rows)
