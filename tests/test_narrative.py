"""Chunks against a loop over blocks, long blocks between short ones included; CJK words; the retriever on unit vectors."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from lodestone.functions import text as X
from lodestone.operators import narrative as N
from lodestone.operators import search as Q

SCHEMA = "doc int, pos int, page int, type string, label string, text string, path array<string>, speaker string, status string, attached boolean"
TARGET, MOST = 20, 40


def tokens(t):
    return max(1, (len(t) + 3) // 4)


def loop(blocks):
    """(first_pos, part, text, pages, n_blocks): buffers flushed one block at a time."""
    out, buf, size = [], [], 0

    def flush():
        if buf:
            out.append((buf[0]["pos"], 0, "\n".join(b["text"] for b in buf), sorted({b["page"] for b in buf}), len(buf)))
        buf.clear()

    for b in blocks:
        if b["type"] == "table":
            flush()
            size = 0
            continue
        if not b["text"].strip():
            continue
        n, key = tokens(b["text"].strip()), (b["path"], b["speaker"])
        if buf and (key != (buf[0]["path"], buf[0]["speaker"]) or size + n > TARGET):
            flush()
            size = 0
        if n > MOST:
            parts, cur = [], []
            for s in re.split(r"(?<=[.;:])\s+(?=[A-Z(\[])", b["text"].strip()):
                if cur and sum(map(tokens, cur)) + tokens(s) > TARGET:
                    parts.append(" ".join(cur))
                    cur = []
                cur.append(s)
            out.extend((b["pos"], k, t, [b["page"]], 1) for k, t in enumerate([*parts, " ".join(cur)]))
            continue
        buf.append(b)
        size += n
    flush()
    return [o for o in out if len(o[2].split()) >= 3]


def test_chunks_against_a_loop(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for doc in range(30):
        blocks = []
        for pos in range(25):
            long = rng.random() < 0.15
            text = ". ".join(" ".join(rng.choices(["Alpha", "beta", "gamma", "delta"], k=rng.randint(3, 7))).capitalize() for _ in range(12 if long else 1)) + "." if rng.random() > 0.08 else "  "
            blocks.append(dict(pos=pos, page=pos // 4, type="table" if rng.random() < 0.07 else "text", text=text, path=[f"S{pos // 9}"], speaker="ab"[pos // 13]))
        rows += [(doc, b["pos"], b["page"], b["type"], "text", b["text"], b["path"], b["speaker"], "ok", False) for b in blocks]
        want[doc] = sorted(loop(blocks))
    got = {}
    for r in N.chunks(spark.createDataFrame(rows, SCHEMA), target=TARGET, most=MOST).collect():
        got.setdefault(r.doc, []).append((r.first_pos, r.part, r.text, r.pages, r.n_blocks))
    assert {d: sorted(x) for d, x in got.items()} == want
    assert any(part for x in want.values() for _, part, *_ in x)


def test_short_long_short_is_not_joined(spark):
    block = lambda pos, text: (1, pos, pos, "text", "text", text, ["S"], "a", "ok", False)
    rows = [block(1, "first block here"), block(2, "Long words. " * 30), block(3, "second block here")]
    got = [r.text for r in N.chunks(spark.createDataFrame(rows, SCHEMA), target=TARGET, most=MOST).orderBy("first_pos", "part").collect()]
    assert got[0] == "first block here" and got[-1] == "second block here" and len(got) > 3


def test_letters_without_case_are_judged(spark):
    got = spark.createDataFrame([("x-漢字-y HPLC ab-CD word",)], "t string").select(X.judged_words(F.col("t"))).head()[0]
    assert got == ["x", "漢字", "y", "ab", "word"]


def test_retrieve_on_unit_vectors(spark):
    """Dense and sparse scores add up as doubles: vectors that differ in the third decimal keep their order."""
    rng = np.random.default_rng(5)
    v = 1 + rng.integers(-4, 5, (90, 8)) / 1000
    v /= np.sqrt((v * v).sum(1))[:, None]
    kinds = [("P1", "ema", "product", "review"), ("P2", "fda", "product", "label"), (None, "ema", "guidance", "guidance")]
    chunks = [(i, v[i].tolist(), *kinds[i % 3], 1, f"k{i % 4}", ["Dosage"], f"own {i}", [1]) for i in range(90)]
    schema = "chunk_id long, v array<double>, program_id string, agency string, doc_kind string, doc_type string, index_document_id int, parent_key string, section_path array<string>, text string, pages array<int>"
    parents = spark.createDataFrame([], "index_document_id int, parent_key string, text string, pages array<int>")
    asked = spark.createDataFrame([(1, "about alpha"), (2, "nothing named")], "qid long, text string")
    q = {1: v[3] * 1.0, 2: v[8] * 1.0}
    vectors = spark.createDataFrame([(k, x.tolist()) for k, x in q.items()], "qid long, q array<double>")
    tokens_of = [(i, f"t{i % 5}", 0.001 * (i % 7)) for i in range(90)]
    words = [(1, "t1", 1.0), (1, "t2", 0.5), (2, "t3", 1.0)]
    routing = Q.Routing(products=[("(?i)alpha", "P1")])
    got = Q.retrieve(asked, vectors, spark.createDataFrame(chunks, schema), parents, spark.createDataFrame(tokens_of, "chunk_id long, token string, w double"), spark.createDataFrame(words, "qid long, token string, w double"), routing, k=6).collect()
    for qid in (1, 2):
        share = {t: w for k, t, w in words if k == qid}
        score = {i: float(np.add.accumulate(v[i] * q[qid])[-1]) + 0.3 * tokens_of[i][2] * share.get(tokens_of[i][1], 0.0) for i in range(90) if qid == 2 or i % 3 == 0}
        want = sorted(score, key=lambda i: (-score[i], -i))[:6]
        rows = sorted((r for r in got if r.qid == qid), key=lambda r: r.place)
        assert [r.chunk_id for r in rows] == want and len({round(score[i], 9) for i in want}) == 6


def test_garble_suspicion(spark):
    """Too few letters, a bad window of the letter model, a run of broken words, and neither."""
    rows = [("ab cd 12", -9.0, False), ("a plain sentence of words", -9.0, True), ("a plain sentence of words", -2.0, False), ("ne rei t e rst pd fo i ts xq zz kk wq", -2.0, True), (None, -9.0, False), ("a plain sentence of words", None, False)]
    df = spark.createDataFrame(rows, "t string, worst double, want boolean")
    assert all(r.want == r.got for r in df.withColumn("got", X.looks_garbled(F.col("t"), F.col("worst"))).collect())


def test_garbled_window_against_a_loop(spark):
    rng = random.Random(6)
    good, bad = ["table", "dose", "result", "onion"], ["xq", "bcdfg", "zz", "wq"]
    rows, want = [], []
    for i in range(200):
        flags = [rng.random() < rng.choice([0.1, 0.4, 0.8]) for _ in range(rng.randint(0, 14))]
        rows.append((i, " ".join(rng.choice(bad if f else good) for f in flags)))
        n = len(flags)
        want.append(False if n < 3 else sum(flags) / n >= 0.4 if n < 6 else any(sum(flags[k : k + 6]) >= 3 for k in range(n - 5)))
    got = spark.createDataFrame(rows, "i int, t string").orderBy("i").select(X.garbled_window(F.col("t"))).collect()
    assert [r[0] for r in got] == want and len(set(want)) == 2
