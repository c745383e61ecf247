"""Alignment, repair of shifted and lost characters, votes over readings, text metrics: against plain versions and on cases with known results."""

import random
from difflib import SequenceMatcher

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.functions import alignment as AL
from lodestone.functions import repair as RP
from lodestone.functions import text as X
from lodestone.operators import metrics as M
from lodestone.operators import readings as RD
from lodestone.operators import trigrams

ENGLISH = """the patients in the study were given a dose of the product and the results of the trial are shown in the table below with the
number of events for each group the safety of the product was similar to that of the reference product in this population and no new
signals were found between the two groups of patients that were treated at the start of the study group results is a recombinant human antibody that binds to the
receptor and was approved for the treatment of adults by the agency on the basis of data from two large trials"""


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last, row = row, [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
    return row[-1]


@pytest.fixture(scope="module")
def logs(spark):
    return trigrams.log_table(trigrams.counts(spark.createDataFrame([(ENGLISH,)], "text string")))


def up(text, *words):
    """The text with these words (all without) in the shifted encoding."""
    return " ".join(RP.shifted(w) if not words or w in words else w for w in text.split(" "))


def test_common_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ("".join(rng.choices("abcé漢", k=rng.randint(0, 70))) for _ in range(2))
        assert AL.lcs_length(a, b) == plain_lcs(a, b)
    assert AL.likeness("", "") == 1 and AL.likeness("abcd", "abed") == 0.75


def test_stands_in_against_all_stretches():
    rng = random.Random(2)

    def plain(n, h):
        if len(n) > len(h):
            n, h = h, n
        m = len(n)
        spans = {h[max(0, s) : s + m] for s in range(1 - m, len(h))}
        return max(2 * plain_lcs(n, w) / (m + len(w)) for w in spans) >= 0.95 - 1e-9

    seen = set()
    for _ in range(150):
        h = "".join(rng.choices("abcd ", k=rng.randint(20, 160)))
        at, n = rng.randrange(len(h)), rng.choice([5, 20, 40, 60])
        x = list(h[at : at + n])
        for _ in range(rng.choice([0, 1, 2, 3, 5])):
            k = rng.randrange(len(x) + 1)
            if rng.random() < 0.5:
                x.insert(k, "z")
            elif x:
                x.pop(min(k, len(x) - 1))
        x = "".join(x)
        if x:
            want = plain(x, h)
            seen.add(want)
            assert AL.stands_in(x, h) == want, (x, h)
    assert seen == {True, False} and not AL.stands_in("", "abc") and not AL.stands_in("abc", "")


def test_segments_rebuild_both_texts():
    rng = random.Random(3)
    for _ in range(200):
        a = "".join(rng.choices("abcdef ", k=rng.randint(0, 120)))
        b = list(a)
        for _ in range(rng.randint(0, 6)):
            k = rng.randrange(len(b) + 1)
            b[k : k + rng.randint(0, 2)] = rng.choices("xyz", k=rng.randint(0, 3))
        b = "".join(b)
        parts = AL.segments(a, b)
        assert "".join(x for _, x, _ in parts) == a and "".join(y for *_, y in parts) == b
        assert all(x == y for same, x, y in parts if same)
        assert all(p[0] != q[0] for p, q in zip(parts, parts[1:]))
        assert len(a) < 40 or sum(len(x) for same, x, _ in parts if same) >= 0.7 * SequenceMatcher(None, a, b, autojunk=False).ratio() * (len(a) + len(b)) / 2


@pytest.mark.parametrize(
    "coded,want",
    [
        (up("the results of the trial are shown"), "the results of the trial are shown"),
        ("plain words " + up("and the safety of the product") + " 26.4% of 34", "plain words and the safety of the product 26.4% of 34"),
        ("study (" + up("the number of patients") + "), " + up("and the results"), "study (the number of patients), and the results"),
        ("were 26. 34.3% " + RP.shifted("and") + " 34.3% " + RP.shifted("in") + " " + RP.shifted("the") + " treatment", "were 26. 34.3% and 34.3% in the treatment"),
        ("the dose of \x14\x13 mg " + up("was given at the start"), "the dose of 10 mg was given at the start"),
        ("HPLC, SAF and NYHA of PK AUC CD4+ in 12%", "HPLC, SAF and NYHA of PK AUC CD4+ in 12%"),  # capitals without a shifted function word
        ("nothing shifted here", "nothing shifted here"),
        ("", ""),
        (None, None),
    ],
)
def test_shifted_words(spark, logs, coded, want):
    df = spark.createDataFrame([(coded,)], "text string")
    assert df.select(RP.decode_shifted(F.col("text"), logs)).head()[0] == want


def test_capitals_beside_shifted_words_stay(spark, logs):
    text = "PK and AUC of group A " + up("were similar to that of the reference product") + " (PK, AUC)"
    got = spark.createDataFrame([(text,)], "text string").select(RP.decode_shifted(F.col("text"), logs)).head()[0]
    assert got == "PK and AUC of group A were similar to that of the reference product (PK, AUC)"


def test_control_codes(spark):
    got = spark.createDataFrame([("\x01a\x02\x03 \x14\x1a\x1b\x11\x08 BSA \x95 10 \x94 \t\n\r",)], "t string").select(X.decode_controls(F.col("t"))).head()[0]
    assert got == "\x01a\x02\x03 178.% BSA ≥ 10 ≤ \t\n\r"


@pytest.mark.parametrize(
    "text,other,want",
    [
        ("body weight of �� kg in all", "body weight of 70 kg in all", "body weight of 70 kg in all"),
        ("stu�y of Gui�ance for industry", "study of Guidance for industry", "study of Guidance for industry"),
        ("in the 0% confidence interval of both", "in the 90% confidence interval of both", "in the 90% confidence interval of both"),
        ("the first reading has wo�ds of its own", "another text with nothing alike in it at all", None),
        ("stu�y of a short text", "study of a short text that goes on elsewhere", "study of a short text"),  # what only the other has at the end is not ours to add
        ("a value of � here we read", "a value of an inserted sentence that is far too long here we read", None),
        ("same text here", "same text here", None),
        (None, "x", None),
        ("x", None, None),
    ],
)
def test_lost_characters(spark, text, other, want):
    assert RP.filled(text, other) == want
    got = spark.createDataFrame([(text, other)], "a string, b string").select(RP.fill_lost(F.col("a"), F.col("b"))).head()[0]
    assert got == (text if want is None else want)


def test_whole_repair(spark, logs):
    rows = [("�� ��", "the lost text"), (up("the number of ") + RP.LOST + up("events"), None), ("stu�y \x14\x13", "study 10")]
    df = spark.createDataFrame(rows, "a string, b string").select(RP.repaired(F.col("a"), F.col("b"), logs))
    assert [r[0] for r in df.collect()] == ["the lost text", "the number of events", "study 10"]


BROKEN = "ne rei t e rst pd fo i ts xq zz kk wq"


def vote(first, second, rereads, logs):
    """Plain version of the vote."""
    import re

    def seen(t):
        return "".join((t or "").split())

    def numbers(t):
        return tuple(re.findall(r"\d+(?:[.,]\d+)?", t))

    broken = lambda t: t == BROKEN or "   " in t  # noqa: E731  the texts of the test are broken in these ways only
    a, b = seen(first), seen(second)
    if a == b:
        return first, "kept"
    near = bool(b) and 2 * plain_lcs(a, b) / (len(a) + len(b)) >= 0.95
    doubt = broken(first) or (b and not near) or (b and 0.8 * len(a) <= len(b) <= 1.25 * len(a) and numbers(first) != numbers(second))
    if not doubt:
        return first, "kept"
    usable = [first] + [t for t in ([second] + (rereads if broken(first) else [])) if t and seen(t) and len(seen(t)) >= 0.8 * len(a)]
    mean = lambda t: float(logs[c].mean()) if len(c := trigrams.codes(" " + re.sub("[^a-z]+", " ", t.lower()).strip() + " ")) else 0.0
    odd = lambda t: 9 if t == BROKEN else 0
    best = min(usable, key=lambda t: (broken(t), odd(t), -mean(t)))
    if broken(best) or (len({numbers(t) for t in usable}) > 1 and best is first):
        return best, "needs_review"
    return best, "kept" if best is first else "reread"


def test_votes(spark, logs):
    good, cases = "the results of the study are shown", {}
    cases["same but for space"] = (good, "the results of the  study areshown", [])
    cases["close enough"] = (good + " and more of it in the table", good + " and more of it in the tables", [])
    cases["second is better"] = (BROKEN, good + " ab", [])
    cases["short second"] = (BROKEN, "the", [])
    cases["reread helps"] = (BROKEN, "the", [None, "of", good, BROKEN])
    cases["numbers differ, first kept"] = ("the dose of 10 mg was given in the trial", "the dose of 16 mg was gvn in the trjal", [])
    cases["numbers differ, close"] = ("the dose of the product was 10 mg at the start of the trial in adults", "the dose of the product was 16 mg at the start of the trial in adults", [])
    cases["no second"] = (good, None, [])
    cases["no second, broken"] = (BROKEN, None, [good])
    cases["gaps"] = ("the results   of   the study", "the results of the study are", [])
    cases["not read again"] = (good, "zzqx wrong text altogether here x", ["never asked for"])
    cases["empty first"] = ("", good, [])
    rows = [(k, n, t) for k, (a, b, more) in cases.items() for n, t in enumerate([a, b, *more]) if t is not None or n == 0]
    asked = []

    class Reader:
        def read(self, block, scale):
            asked.append(block)
            more = cases[block][2]
            k = RD.SCALES.index(scale)
            return more[k] if k < len(more) else None

    readings = spark.createDataFrame([r for r in rows if r[1] < 2], "block string, ord int, text string")
    got = {r.block: (r.text, r.status) for r in RD.voted(readings, logs, Reader).collect()}
    want = {k: vote(*c, logs) for k, c in cases.items()}
    assert got == want
    given = {r.block: (r.text, r.status) for r in RD.voted(spark.createDataFrame(rows, "block string, ord int, text string"), logs).collect()}
    assert given == want  # rereads that are there already
    assert set(want[k][1] for k in want) == {"kept", "reread", "needs_review"}
    ask = RD.requests(RD.doubted(readings, logs)).collect()
    assert {(r.block, r.ord, r.scale) for r in ask} == {(k, n + 2, s) for k, c in cases.items() if c[0] == BROKEN or "   " in c[0] for n, s in enumerate(RD.SCALES)}


def test_text_metrics(spark):
    text = "the results of the whole study are shown in the table on the next page of this report"
    page = lambda rows: spark.createDataFrame(rows, "page int, pos int, text string")
    gold = page([(1, 0, text), (1, 1, text[:40]), (1, 2, "not there at all"), (2, 0, "alone"), (3, 0, text)])
    found = page([(1, 0, text.replace("whole", "whote")), (1, 1, "Page 3 of 9"), (1, 2, BROKEN), (3, 0, "the results of the whole study are shown")])
    cells = page([(1, 0, "12.5"), (1, 1, "n = 7"), (1, 2, "word"), (2, 0, "3")])
    out = M.text_metrics(gold, cells, found, page([(1, 5, "12 .5"), (1, 6, "8")]), page([(1, 0, "page 3 OF 9"), (1, 1, "other")]))
    got = {r.page: (r.text_n, r.text_hit, r.num_n, r.num_in_text, r.garbled, r.furniture_leak) for r in out.collect()}
    assert got == {1: (3, 2, 2, 1, 1, 1), 2: (1, 0, 1, 0, 0, 0), 3: (1, 1, 0, 0, 0, 0)}
    routes = spark.createDataFrame([(1, "DIGITAL"), (2, "IMAGE"), (3, "DIGITAL")], "page int, route string")
    ratio = {r.route: (r.pages, r.text_recall, r.num_in_text, r.garbled, r.furniture_leak) for r in M.text_ratios(out.join(routes, "page"), "route").collect()}
    assert ratio == {"DIGITAL": (2, 75.0, 50.0, 1, 1), "IMAGE": (1, 0.0, 0.0, 0, 0)}
