"""Line dedup against brute force at every line length."""

import random

from lodestone.llm import line_dedup

SCHEMA = "doc_id long, text string, k string"


def edit(a, b):
    """Word edit distance, by the plain table."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_every_length_against_brute_force(spark):
    rng = random.Random(4)
    texts = {}
    pool = [[f"v{rng.randrange(60)}" for _ in range(n)] for n in list(range(1, 16)) * 4]
    for i in range(120):
        lines = []
        for _ in range(rng.randint(0, 6)):
            words = list(rng.choice(pool))
            roll = rng.random()
            if roll < 0.25:
                words[rng.randrange(len(words))] = f"u{rng.randrange(10**6)}"
            elif roll < 0.4:
                words.insert(rng.randrange(len(words) + 1), f"u{rng.randrange(10**6)}")
            elif roll < 0.55 and len(words) > 1:
                del words[rng.randrange(len(words))]
            lines.append("  ".join(words) if rng.random() < 0.1 else " ".join(words))
        texts[i] = "\n".join(lines)
    places = [(i, pos, x.split()) for i, t in texts.items() for pos, x in enumerate(t.split("\n")) if x.split()]
    want = {}
    for n, (i, pos, words) in enumerate(places):
        gone = any(e == words or (max(len(e), len(words)) >= 3 and edit(e, words) <= 1) for _, _, e in places[:n])
        if gone:
            want.setdefault(i, []).append(pos)
    rows = list(texts.items())
    got = line_dedup.dedup_lines(spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)).collect()
    assert sum(len(x) for x in want.values()) > 100
    for r in got:
        lines = texts[r.doc_id].split("\n")
        assert r.n_dropped == len(want.get(r.doc_id, []))
        assert r.text == "\n".join(x for pos, x in enumerate(lines) if pos not in want.get(r.doc_id, []))


def test_an_earlier_line_outside_the_bound_hides_no_link(spark):
    """alpha gamma stands first but is no partner of a line of two words; alpha beta delta is."""
    docs = [(1, "alpha gamma", "x"), (2, "alpha beta delta", "x"), (3, "alpha beta", "x")]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert got == {1: "alpha gamma", 2: "alpha beta delta", 3: ""}


def test_small_vocabulary_against_brute_force(spark):
    """Short lines over few words, where many candidates of one line differ in length."""
    rng = random.Random(9)
    texts = {i: "\n".join(" ".join(rng.choices("abcdefg", k=rng.choice([1, 2, 2, 3, 3, 4]))) for _ in range(3)) for i in range(60)}
    places = [(i, pos, x.split()) for i, t in texts.items() for pos, x in enumerate(t.split("\n"))]
    want = {(i, pos) for n, (i, pos, words) in enumerate(places) if any(e == words or (max(len(e), len(words)) >= 3 and edit(e, words) <= 1) for _, _, e in places[:n])}
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame([(i, t, "x") for i, t in texts.items()], SCHEMA)).collect()}
    assert got == {i: "\n".join(x for pos, x in enumerate(t.split("\n")) if (i, pos) not in want) for i, t in texts.items()}
