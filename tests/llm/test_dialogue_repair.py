"""Conversation repair against an exhaustive least (cost, audit) search, with pieces cut after a few rows."""

import hashlib
import random
import zlib

import pytest

from lodestone.llm import dialogue_repair as dr

SCHEMA = "conv_id long, turn long, role string, text string"
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}


def least(rows):
    """rows: (role, text, fault). The least (cost, audit, repaired lines) by trying everything, pruned by cost at (row, state)."""
    best, stack = (10**9, "", []), [(0, "", 0, 0, [])]
    seen = {}
    while stack:
        cost, audit, i, state, lines = stack.pop()
        if seen.get((i, state), (10**9,)) < (cost, audit):
            continue
        seen[i, state] = (cost, audit)
        if i == len(rows) and state in (0, 3) and (cost, audit) < best[:2]:
            best = (cost, audit, lines)
        for c, name in (("u", "user"), ("a", "assistant")):
            if (state, c) in STEP:
                stack.append((cost + 5, audit + "I", i, STEP[state, c], lines + [f"{name}:"]))
        if i < len(rows):
            role, text, fault = rows[i]
            stack.append((cost + 2, audit + "D", i + 1, state, lines))
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                if (state, role[:1]) in STEP:
                    stack.append((cost + more, audit + "K", i + 1, STEP[state, role[:1]], lines + [f"{role}:{text}"]))
                for c, name in (("u", "user"), ("a", "assistant")):
                    if (state, c) in STEP:
                        stack.append((cost + more + 1, audit + "R", i + 1, STEP[state, c], lines + [f"{name}:{text}"]))
    return best


def judged(rows):
    out, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(" \t\n\v\f\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def want(rows):
    out = {}
    for key in {r[0] for r in rows}:
        kept = []
        for c, turn, role, text in rows:
            if c != key:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            code = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            if code:
                text = "" if code == 1 else "".join(x for x in text if x not in ".!?") if code == 2 else text
                kept += [(turn, "user" if code == 4 else role, text)] * (1 + (code == 3))
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        marks = judged(kept)
        turns = [t for t, *_ in kept if t is not None]
        cost, audit, lines = least(marks)
        n = {f: sum(m[2] == f for m in marks) for f in ("blank", "duplicate", "truncated")}
        bad = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marks, marks[1:]))
        out[key] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *n.values(), bad, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def sample(seed, convs, longest):
    rng, rows = random.Random(seed), []
    for c in [*range(convs), None]:
        for _ in range(rng.randint(1, longest)):
            rows.append((c, rng.choice([None, *range(9)]), rng.choice(["user", "user", "assistant", "assistant", "system", "tool", "", None]), rng.choice(["a.", "b!", "c", "d? \n", "", " \t", None, "é.", "x" * 3000 + "."])))
    return rows


@pytest.mark.parametrize("seed,longest,span", [(1, 8, 12), (2, 40, 1), (3, 25, 2), (4, 60, 3)])
def test_against_all_edits(spark, tmp_path, monkeypatch, seed, longest, span):
    rows = sample(seed, 12, longest)
    spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", seg int").write.parquet(f"{tmp_path}/conversations.parquet")
    whole = dr.solved
    monkeypatch.setattr(dr, "solved", lambda marks: whole(marks, span))
    got = {r[0]: tuple(r)[1:] for r in dr.op12_repair_conversations(spark, str(tmp_path)).collect()}
    assert got == want(rows)


def test_empty(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert not dr.op12_repair_conversations(spark, str(tmp_path)).collect()


def test_repaired_rows_fit_the_pattern(spark):
    import re

    rows = dr.ordered(spark.createDataFrame(sample(7, 20, 12), SCHEMA))
    edits = dr.solved(dr.faults(rows))
    found = {}
    for r in sorted(dr.repaired(rows, edits).collect(), key=lambda r: (r.conv, r.seg, r.step)):
        found.setdefault(r.conv, []).append(r)
    for steps in found.values():
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[:1] for r in steps if r.edit != "D"))
        assert all((r.pos is None) == (r.edit == "I") for r in steps)
