"""Conversation structure repair: shortest edit paths by Dial's bucket queue.

A conversation is a chain of rows; a repaired one has the role initials (s?(ua)+)?. A node of the search is (rows consumed, state of that pattern); its arcs are
Delete, Insert, Keep and Rerole with costs of 0 to 6, so distances are found with a circular queue of seven buckets instead of a heap. Distances run from
the end backwards; the audit is then read off from the front, taking the least letter of all tight arcs (distance = cost + distance behind) at each node.

Rows are put in order by one range partitioning over (conversation, turn, role, text), which also splits a conversation that holds a large
part of the table, and get positions. Windows of 4096 positions are the unit of work. A conversation that begins and ends inside
one is solved there. One that crosses a border is cut there: each piece gives the 4 x 4 costs between its states, the pieces of a conversation are
chained by these (16 numbers for up to 4096 rows), every piece then walks from each state it may be entered in, and the chain of the states picks
the walks. No task ever holds a conversation's rows or texts as a whole; only the digest of its repaired text, which SHA-256 defines as
one stream, is read through in order by one task that keeps nothing.

Defined cases: a null conv_id, turn, role or text counts as one space where it is part of a string; null turns come first and take no part
in gaps; a null conv_id is a conversation of its own; rows of one turn are ordered by role, then text; repeated rows are duplicates (the first stays); an empty role
has no initial and can only be changed or deleted; a conversation without rows after the damage has zeros, an empty audit and the empty text's digest; an
empty table gives no rows; columns beyond conv_id, turn, role and text are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, discard, parts_for, table

ROWS, SPAN_BITS = 50_000, 12
NEXT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}  # states: nothing yet, after s, after u, after a
FILL = (2, 2, 3, 2)  # the state that a user or assistant row leads to
BEHIND = ((), (), (0, 1, 3), (2,))  # the states it comes from
DELETE, INSERT, REROLE, CUT_OFF = 2, 5, 1, 5
BUCKETS = REROLE + CUT_OFF + 1
TAIL = ("", "II", "I", "")  # what completes each state at a conversation's end
END = tuple(INSERT * len(t) for t in TAIL)
FAR = 1 << 60


def damaged(rows: DataFrame) -> DataFrame:
    """Damages a table of conversations by a checksum of conversation and turn: 0 of 20 drops a row, 1 empties it, 2 takes its ends of sentences, 3 repeats it, 4 makes it the user's."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat_ws(":", text("conv_id"), text("turn"))) % 20
    rows = rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), code.alias("_code")).filter("_code <> 0")
    rows = rows.withColumn("text", F.when(F.col("_code") == 1, "").when(F.col("_code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    rows = rows.withColumn("role", F.when(F.col("_code") == 4, "user").otherwise(F.col("role")))
    return rows.withColumn("_copy", F.explode(F.when(F.col("_code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("_code", "_copy")


def ordered(rows: DataFrame) -> DataFrame:
    """(pos, conv, turn, role, text, digest), stored: pos follows the order of conversations and turns; conv is the conversation as a string, a null as a space."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select(text("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"))
    parts = max(parts_for(rows.count(), ROWS), rows.sparkSession.sparkContext.defaultParallelism)
    near = rows.repartitionByRange(parts, "conv", F.col("turn").asc_nulls_first(), "role", F.substring("text", 1, 32))
    return cut(near.sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text").withColumn("pos", F.monotonically_increasing_id()).withColumn("digest", F.unhex(F.sha2("text", 256))))


def faults(rows: DataFrame) -> DataFrame:
    """(pos, conv, turn, role, fault): fault is blank, duplicate, truncated or null. rows: a table of `ordered`."""
    firsts = rows.groupBy("conv", "role", "digest").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("_first"))
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    cut_off = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    seen = rows.select("pos", "conv", "turn", "role", blank.alias("_blank"), cut_off.alias("_cut")).join(firsts, "pos", "left")
    return seen.select("pos", "conv", "turn", "role", F.when(F.col("_blank"), "blank").when(F.col("_first").isNull(), "duplicate").when(F.col("_cut"), "truncated").alias("fault"))


def codes(roles: list[str], fault: list) -> str:
    """A letter per row: x must go; else the role's initial (o for others), in upper case if the text is cut off."""
    out = []
    for r, f in zip(roles, fault):
        c = r[0] if r and r[0] in "sua" else "o"
        out.append("x" if f in ("blank", "duplicate") else c.upper() if f == "truncated" else c)
    return "".join(out)


def distances(code: str, end) -> list[int]:
    """Least cost from each node 4 * i + state to the costs `end` of the states behind the last row, by Dial's bucket queue run backwards.

    The border behind the last row has no inserts: they belong to the piece that begins there, or to TAIL.
    """
    n = len(code)
    dist = [FAR] * (4 * n + 4)
    base = min(end)
    queue: list[list[int]] = [[] for _ in range(BUCKETS)]
    later = sorted((d, t) for t, d in enumerate(end) if d < FAR)  # ends of other costs enter when their turn comes
    waiting, at, d = 0, 0, base
    while waiting or at < len(later):
        while at < len(later) and later[at][0] <= d:
            node = 4 * n + later[at][1]
            if d < dist[node]:
                dist[node] = d
                queue[d % BUCKETS].append(node)
                waiting += 1
            at += 1
        bucket = queue[d % BUCKETS]
        while bucket:
            node = bucket.pop()
            waiting -= 1
            if dist[node] != d:
                continue
            i, t = node >> 2, node & 3
            arcs = [(4 * i + s, INSERT) for s in BEHIND[t]] if i < n else []
            if i:
                c = code[i - 1]
                low = 4 * (i - 1)
                arcs.append((low + t, DELETE))
                if c != "x":
                    more = CUT_OFF if c.isupper() else 0
                    arcs += [(low + s, REROLE + more) for s in BEHIND[t]]
                    if (to := NEXT.get(c.lower())) is not None:
                        arcs += [(low + s, more) for s in range(4) if to[s] == t]
            for to, cost in arcs:
                if d + cost < dist[to]:
                    dist[to] = d + cost
                    queue[(d + cost) % BUCKETS].append(to)
                    waiting += 1
        d += 1
        if not waiting and at < len(later):
            d = max(d, later[at][0])
    return dist


def walk(code: str, dist: list[int], state: int) -> tuple[str, str, int]:
    """Edits and the initials they leave (- for none), by the least letter of the tight arcs from the front; and the state behind the last row."""
    n, i, edits, roles = len(code), 0, [], []
    while i < n:
        d, c = dist[4 * i + state], code[i]
        here, behind = 4 * i, 4 * i + 4
        more = CUT_OFF if c.isupper() else 0
        to, keep = FILL[state], (NEXT.get(c.lower()) or (None,) * 4)[state]
        if dist[behind + state] + DELETE == d:
            edits.append("D"), roles.append("-")
            i += 1
        elif dist[here + to] + INSERT == d:
            edits.append("I"), roles.append("ua"[to - 2])
            state = to
        elif c != "x" and keep is not None and dist[behind + keep] + more == d:
            edits.append("K"), roles.append(c.lower())
            state, i = keep, i + 1
        else:
            edits.append("R"), roles.append("ua"[to - 2])
            state, i = to, i + 1
    return "".join(edits), "".join(roles), state


def finished(edits: str, roles: str, state: int) -> tuple[str, str]:
    return edits + TAIL[state], roles + ("ua"[-len(TAIL[state]) :] if TAIL[state] else "")


def bad_pairs(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


PIECE = "conv string, seg long, start long, code string, whole boolean, costs array<long>, illegal long, head string, tail string, edits string, roles string, cost long"


def _pieces(key, pdf):
    """The parts of conversations in one window of positions; those inside it are solved, those at its borders give their costs between states."""
    import pandas as pd

    pdf = pdf.sort_values("pos")
    conv, out = pdf["conv"].to_numpy(), []
    heads = np.concatenate([[0], np.nonzero(conv[1:] != conv[:-1])[0] + 1, [len(pdf)]])
    for a, b in zip(heads[:-1].tolist(), heads[1:].tolist()):
        part = pdf.iloc[a:b]
        roles, fault = part["role"].tolist(), part["fault"].tolist()
        initials, code = [r[:1] for r in roles], codes(roles, fault)
        row = [conv[a], key[0], int(part["pos"].iloc[0]), code, a > 0 and b < len(pdf), None, bad_pairs(initials), initials[0], initials[-1], None, None, None]
        if row[4]:
            dist = distances(code, END)
            row[9], row[10] = finished(*walk(code, dist, 0))
            row[11] = dist[0]
        else:
            row[5] = [x for t in range(4) for x in distances(code, [0 if s == t else FAR for s in range(4)])[:4]]
        out.append(row)
    return pd.DataFrame(out, columns=[c.split()[0] for c in PIECE.split(", ")])


def _ends(key, pdf):
    """For each piece of a conversation the costs from the states behind it to the end, and the pairs of initials across its border."""
    import pandas as pd

    pdf, behind, out, head = pdf.sort_values("seg"), list(END), [], None
    for seg, costs, first, last in list(zip(pdf["seg"], pdf["costs"], pdf["head"], pdf["tail"]))[::-1]:
        across = 0 if head is None else bad_pairs([last, head])
        out.append((key[0], seg, behind, across, head is None))
        behind, head = [min(FAR, *(int(costs[4 * t + s]) + behind[t] for t in range(4))) for s in range(4)], first
    out = [(*x, i == len(out) - 1, behind[0]) for i, x in enumerate(out)]
    return pd.DataFrame(out, columns=["conv", "seg", "behind", "across", "last", "first", "total"])


def _walks(batches):
    """The walk of each piece from every state in which it may be entered."""
    import pyarrow as pa

    for b in batches:
        rows = []
        for r in b.to_pylist():
            dist = distances(r["code"], r["behind"])
            found = [walk(r["code"], dist, s) if dist[s] < FAR else ("", "", 0) for s in ((0,) if r["first"] else range(4))]
            if r["last"]:
                found = [(*finished(*w), w[2]) for w in found]
            rows.append({"conv": r["conv"], "seg": r["seg"], "edits": [w[0] for w in found], "roles": [w[1] for w in found], "leaves": [w[2] for w in found]})
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("conv", pa.string()), ("seg", pa.int64()), ("edits", pa.list_(pa.string())), ("roles", pa.list_(pa.string())), ("leaves", pa.list_(pa.int32()))]))


def _entered(key, pdf):
    import pandas as pd

    pdf, state, out = pdf.sort_values("seg"), 0, []
    for seg, leaves in zip(pdf["seg"], pdf["leaves"]):
        out.append((key[0], seg, state))
        state = int(leaves[state])
    return pd.DataFrame(out, columns=["conv", "seg", "entered"])


def solved(marks: DataFrame, span_bits: int = SPAN_BITS) -> DataFrame:
    """(conv, seg, start, edits, roles, illegal, cost), stored: the edits of each piece; illegal and cost add up to the conversation's. marks: pos, conv, role, fault."""
    seg = F.shiftright("pos", span_bits)
    pieces = cut(marks.select("pos", "conv", "role", "fault", seg.alias("seg")).groupBy("seg").applyInPandas(_pieces, PIECE))
    parts = pieces.filter("NOT whole")
    ends = cut(parts.select("conv", "seg", "costs", "head", "tail").groupBy("conv").applyInPandas(_ends, "conv string, seg long, behind array<long>, across long, last boolean, first boolean, total long"))
    walks = cut(parts.select("conv", "seg", "code").join(ends, ["conv", "seg"]).select("conv", "seg", "code", "behind", "first", "last").mapInArrow(_walks, "conv string, seg long, edits array<string>, roles array<string>, leaves array<int>"))
    entered = walks.select("conv", "seg", "leaves").groupBy("conv").applyInPandas(_entered, "conv string, seg long, entered int")
    taken = walks.join(entered, ["conv", "seg"]).select("conv", "seg", F.element_at("edits", F.col("entered") + 1).alias("edits"), F.element_at("roles", F.col("entered") + 1).alias("roles"))
    rest = parts.drop("edits", "roles", "cost", "illegal").join(taken, ["conv", "seg"]).join(ends, ["conv", "seg"]).join(parts.select("conv", "seg", "illegal"), ["conv", "seg"])
    rest = rest.select("conv", "seg", "start", "edits", "roles", (F.col("illegal") + F.col("across")).alias("illegal"), F.when(F.col("first"), F.col("total")).otherwise(0).alias("cost"))
    out = cut(pieces.filter("whole").select("conv", "seg", "start", "edits", "roles", "illegal", "cost").unionByName(rest))
    discard(pieces, ends, walks)
    return out


def repaired(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """conv, seg, step, edit, pos, turn, role, text: the edits in order (seg, step) with the rows they leave; a deleted row keeps its role and text beside its D.

    rows: a table of `ordered`; edits: a table of `solved`.
    """

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for r in b.to_pylist():
                pos, got = r["start"], []
                for step, (e, role) in enumerate(zip(r["edits"], r["roles"])):
                    got.append((r["conv"], r["seg"], step, e, {"u": "user", "a": "assistant"}.get(role) if e in "IR" else None, None if e == "I" else pos))
                    pos += e != "I"
                kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*got) if got else [[]] * 6, kinds)], ["conv", "seg", "step", "edit", "given", "pos"])

    steps = edits.select("conv", "seg", "start", "edits", "roles").mapInArrow(run, "conv string, seg long, step int, edit string, given string, pos long")
    return steps.join(rows.select("pos", "turn", "role", "text"), "pos", "left").select("conv", "seg", "step", "edit", "pos", "turn", F.coalesce("given", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def digests(kept: DataFrame) -> DataFrame:
    """(conv, repaired_sha256) of the newline-joined role:text lines in order. A task reads its sorted rows as a stream and keeps one running digest."""

    def run(batches):
        import pyarrow as pa

        conv, state, done = None, None, []
        for b in batches:
            for c, line in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if c != conv:
                    if state:
                        done.append((conv, state.hexdigest()))
                    conv, state = c, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(line.encode())
            if len(done) > 1000:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*done)], ["conv", "repaired_sha256"])
                done = []
        if state:
            done.append((conv, state.hexdigest()))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*done)], ["conv", "repaired_sha256"])

    lines = kept.select("conv", F.concat_ws(":", "role", "text").alias("_line"), "seg", "step").repartition("conv").sortWithinPartitions("conv", "seg", "step")
    return lines.select("conv", "_line").mapInArrow(run, "conv string, repaired_sha256 string")


def op12_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = ordered(damaged(source))
    marks = cut(faults(rows))
    edits = solved(marks)
    n = lambda kind: F.sum(F.when(F.col("fault") == kind, 1).otherwise(0)).alias(kind)
    turns = marks.groupBy("conv", "turn").agg(n("blank"), n("duplicate"), n("truncated"))
    counts = turns.groupBy("conv").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"), *[F.sum(k).alias(k) for k in ("blank", "duplicate", "truncated")])
    audits = edits.groupBy("conv").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), F.sort_array(F.collect_list(F.struct("seg", "edits"))).alias("_e")).withColumn("audit", F.array_join("_e.edits", "")).drop("_e")
    digest = digests(repaired(rows, edits).filter("edit <> 'D'"))
    every = source.select("conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("conv")).distinct()
    found = every.join(counts, "conv", "left").join(audits, "conv", "left").join(digest, "conv", "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


OP12_SQL = """
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda s: ascii(s)::BIGINT)),
           lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda i: i)),
             lambda r, i: xor(r >> 1, CASE WHEN r & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END)))) % 20 AS code
  FROM conversations),
hit AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
         CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN code = 3 THEN [0, 1] ELSE [0] END) AS copy FROM keyed WHERE code <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM hit),
marked AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE 'none' END AS fault,
    lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair FROM placed),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM marked GROUP BY conv_id),
none AS (SELECT {'c': 1000000000, 'a': '', 't': ''} AS x),
-- four states (nothing yet, after s, after u, after a), each the least (cost, audit) and the repaired text; inserts may follow every step
steps AS (
  SELECT conv_id, n, 0 AS i, {'c': 0, 'a': '', 't': ''} AS p0, none.x AS p1, {'c': 5, 'a': 'I', 't': chr(10) || 'user:'} AS p2,
         {'c': 10, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'} AS p3 FROM counts, none
  UNION ALL
  SELECT conv_id, n, i, p0, p1, q2, least(p3, {'c': q2.c + 5, 'a': q2.a || 'I', 't': q2.t || chr(10) || 'assistant:'}) FROM (
    SELECT *, least(p2, {'c': p0.c + 5, 'a': p0.a || 'I', 't': p0.t || chr(10) || 'user:'}, {'c': p1.c + 5, 'a': p1.a || 'I', 't': p1.t || chr(10) || 'user:'}, {'c': p3.c + 5, 'a': p3.a || 'I', 't': p3.t || chr(10) || 'user:'}) AS q2 FROM (
      SELECT s.conv_id, s.n, s.i + 1 AS i,
        {'c': p0.c + 2, 'a': p0.a || 'D', 't': p0.t} AS p0,
        least({'c': p1.c + 2, 'a': p1.a || 'D', 't': p1.t}, {'c': p0.c + m.k_s, 'a': p0.a || 'K', 't': p0.t || m.own}) AS p1,
        least({'c': p2.c + 2, 'a': p2.a || 'D', 't': p2.t}, {'c': p0.c + m.k_u, 'a': p0.a || 'K', 't': p0.t || m.own}, {'c': p1.c + m.k_u, 'a': p1.a || 'K', 't': p1.t || m.own}, {'c': p3.c + m.k_u, 'a': p3.a || 'K', 't': p3.t || m.own},
          {'c': p0.c + m.r, 'a': p0.a || 'R', 't': p0.t || m.u}, {'c': p1.c + m.r, 'a': p1.a || 'R', 't': p1.t || m.u}, {'c': p3.c + m.r, 'a': p3.a || 'R', 't': p3.t || m.u}) AS p2,
        least({'c': p3.c + 2, 'a': p3.a || 'D', 't': p3.t}, {'c': p2.c + m.k_a, 'a': p2.a || 'K', 't': p2.t || m.own}, {'c': p2.c + m.r, 'a': p2.a || 'R', 't': p2.t || m.a}) AS p3
      FROM steps s JOIN (
        SELECT conv_id, i, chr(10) || role || ':' || text AS own, chr(10) || 'user:' || text AS u, chr(10) || 'assistant:' || text AS a, CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000000 WHEN fault = 'truncated' THEN 6 ELSE 1 END AS r,
          CASE WHEN fault IN ('blank', 'duplicate') OR role[1] <> 's' THEN 1000000000 WHEN fault = 'truncated' THEN 5 ELSE 0 END AS k_s,
          CASE WHEN fault IN ('blank', 'duplicate') OR role[1] <> 'u' THEN 1000000000 WHEN fault = 'truncated' THEN 5 ELSE 0 END AS k_u,
          CASE WHEN fault IN ('blank', 'duplicate') OR role[1] <> 'a' THEN 1000000000 WHEN fault = 'truncated' THEN 5 ELSE 0 END AS k_a FROM marked) m
      ON s.conv_id IS NOT DISTINCT FROM m.conv_id AND m.i = s.i + 1))),
ended AS (SELECT conv_id, least(p0, p3) AS e FROM steps WHERE i = n)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
       coalesce(e.c, 0)::BIGINT AS cost, coalesce(e.a, '') AS audit, sha256(coalesce(substr(e.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ended d ON o.conv_id IS NOT DISTINCT FROM d.conv_id
"""
