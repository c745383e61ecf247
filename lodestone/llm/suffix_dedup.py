"""Exact substring dedup by prefix-free parsing: every byte of a 50-byte string that also starts in a document with a smaller id goes.

A rolling hash marks triggers: of the 20-byte strings within any 50 bytes, the one of least hash. So a trigger
depends on those 50 bytes alone, and equal strings have equal triggers. The start positions that share a trigger make a
phrase; its text runs to the end of its last 50-byte string, so neighbouring phrases overlap and no phrase is a
proper prefix of another at the same trigger (the parse is prefix-free).

1. Parse: each document becomes phrases (trigger hash, phrase hash, document, position). A phrase that has appeared in a
   smaller document of the same block goes at once; one record per distinct phrase goes on, so frequent phrases stay small.
2. Dictionary: records meet by trigger. Occurrences of a phrase outside its smallest document go whole. A trigger with one
   phrase is settled; of one with several phrases the text is asked for, once per distinct phrase.
3. The documents with their replies: settled documents are finished, others send the asked phrases.
4. Suffix order: per trigger, the 50-byte suffix prefixes of the dictionary's phrases are sorted with their documents
   (the parse after a phrase lies within its overlap), so equal strings stand together, smallest document first.
5. The rest is finished.

Hot triggers (a common heading in ever new surroundings) are counted first. Their phrases are dealt by phrase instead of by
trigger and always asked for; their 50-byte strings then go out one by one, dealt by a hash of the string, one per block and
string. So no task holds all phrases of a hot trigger, and the result is the same on either way.

Blocks of records are numpy columns in zstd blobs, so a position costs about one byte of shuffle. Phrase identity is
96 bits of hash. A trigger's group holds its distinct phrases of each block only, whatever the number of copies.

Defined cases: null text is empty: no bytes, no spans, the hash of nothing; texts under 50 bytes stay whole; rows with one
doc_id never match each other; a null doc_id counts as smaller than all; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NULL_ID, chunks, cut, mix, pack, parts_for, table, unpack

SPAN, GRAM = 50, 20
PART_BYTES, BLOCK_BYTES = 8 << 20, 8 << 20
BASE = 0x9E3779B97F4A7C15
BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
PIECE = 1 << 19
HOT, MOST_HOT = 1 << 16, 1 << 20  # phrases that make a trigger hot; hot triggers that tasks are told of (8 MB)
LOW48 = np.uint64((1 << 48) - 1)


def _times(power: int) -> np.uint64:
    return np.uint64(pow(BASE, power, 1 << 64))


def _hashes(buf: np.ndarray, n: int, known: dict[int, np.ndarray]) -> np.ndarray:
    """Polynomial hashes of all n-byte strings of buf, by doubling."""
    if n not in known:
        half = 1 << ((n - 1).bit_length() - 1)
        a, b = _hashes(buf, half, known), _hashes(buf, n - half, known)
        size = len(buf) - n + 1
        known[n] = a[:size] * _times(n - half) + b[half : half + size]
    return known[n]


def _least(x: np.ndarray, n: int) -> np.ndarray:
    """The least of every n neighbours."""
    size, m, w = len(x) - n + 1, x, 1
    while 2 * w <= n:
        m = np.minimum(m[:-w], m[w:])
        w *= 2
    return np.minimum(m[:size], m[n - w : n - w + size])


def phrases(texts: list[bytes], span: int = SPAN, gram: int = GRAM):
    """Columns of all phrases: text index, first start, last start - first, trigger hash and phrase hash (48 bits each), in order."""
    out: list[tuple] = []
    buf: list[bytes] = []
    own: list[tuple[int, int, int]] = []  # text, offset in it, bytes

    def flush():
        raw = np.frombuffer(b"".join(buf), np.uint8)
        if len(raw) >= span:
            known = {1: BYTES[raw]}
            g, s = _hashes(raw, gram, known), _hashes(raw, span, known)
            g = mix(g)
            low = np.uint64((1 << 20) - 1)
            order = (g & ~low) | np.arange(len(g), dtype=np.uint64)
            trigger = (_least(order, span - gram + 1) & low).astype(np.int64)
            sizes = np.array([n for _, _, n in own])
            ends = np.cumsum(sizes)
            index = np.repeat(np.arange(len(own)), sizes)[: len(s)]
            valid = ends[index] - np.arange(len(s)) >= span
            trigger[~valid] = -1
            first = np.concatenate([[True], (trigger[1:] != trigger[:-1]) | (index[1:] != index[:-1])])
            a = np.nonzero(first)[0]
            b = np.concatenate([a[1:], [len(s)]]) - 1
            keep = trigger[a] >= 0
            a, b = a[keep], b[keep]
            t = trigger[a]
            whole = mix(s[a] * np.uint64(3) + mix(s[b]) + ((t - a) * 64 + (b - a)).astype(np.uint64))
            at = index[a]
            place = a - (ends - sizes)[at] + np.array([o for _, o, _ in own])[at]
            out.append((np.array([d for d, _, _ in own])[at], place, b - a, g[t] & LOW48, whole & LOW48))
        buf.clear()
        own.clear()

    size = 0
    for d, text in enumerate(texts):
        for at in range(0, max(1, len(text) - span + 1), PIECE - span + 1):
            piece = text[at : at + PIECE]
            if len(piece) < span:
                continue
            if size + len(piece) > 2 * PIECE:
                flush()
                size = 0
            buf.append(piece)
            own.append((d, at, len(piece)))
            size += len(piece)
    if buf:
        flush()
    return [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)] * 2


def _heads(*sorted_keys: np.ndarray) -> np.ndarray:
    """True where any of the keys, sorted together, changes."""
    new = np.ones(len(sorted_keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in sorted_keys])
    return new


def hot_triggers(docs: DataFrame, span: int = SPAN, gram: int = GRAM, least: int = HOT, most: int = MOST_HOT) -> np.ndarray:
    """Sorted triggers with more than `least` phrases, distinct within a block; a block's only phrase of a trigger is not counted.

    Of more than `most` such triggers the largest are returned: all others have less than one phrase in `most` each, and go the
    plain way. So the list has a fixed bound and neither way loses a phrase.
    """

    def run(batches):
        import pyarrow as pa

        for _, texts in chunks(batches, ["doc_id", "text"], BLOCK_BYTES):
            trigger, phrase = phrases([t or b"" for t in texts], span, gram)[3:]
            order = np.lexsort((phrase, trigger))
            trigger, phrase = trigger[order], phrase[order]
            trigger = trigger[_heads(trigger, phrase)] if len(trigger) else trigger
            at = np.nonzero(_heads(trigger))[0] if len(trigger) else np.zeros(0, np.int64)
            n = np.diff(at, append=len(trigger))
            at, n = at[n > 1], n[n > 1]
            yield pa.RecordBatch.from_arrays([pa.array(trigger[at].view(np.int64)), pa.array(n.astype(np.int64))], ["trigger", "n"])

    counted = docs.mapInArrow(run, "trigger long, n long").groupBy("trigger").agg(F.sum("n").alias("n"))
    found = counted.filter(F.col("n") > least).orderBy(F.desc("n"), "trigger").limit(most).collect()
    return np.sort(np.array([r[0] for r in found], np.int64)).view(np.uint64)


def _windows(body: np.ndarray, n: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All span-byte strings of phrases of n bytes that stand one after another in body: phrase, offset in it, string."""
    starts = n - span + 1
    own = np.repeat(np.arange(len(n)), starts)
    shift = np.arange(starts.sum()) - np.repeat(np.cumsum(starts) - starts, starts)
    place = (np.cumsum(n) - n)[own] + shift
    return own, shift, np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(body, span)[place])


def _block_of(ids: np.ndarray, blocks: int) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64) + np.uint64(77)) % np.uint64(blocks)).astype(np.int64)


def _split(key: np.ndarray):
    """(value, rows) for each distinct value of key."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    cuts = np.nonzero(np.concatenate([[True], k[1:] != k[:-1]]))[0] if len(k) else []
    for a, b in zip(cuts, [*cuts[1:], len(k)]):
        yield int(k[a]), order[a:b]


def _gaps(at: np.ndarray) -> np.ndarray:
    return np.diff(at.astype(np.int64), prepend=0).astype(np.int64)


RECORD = "part long, ids binary, at binary, more binary, trigger binary, phrase binary"
REPLY = "block long, ids binary, a binary, n binary, part binary, trigger binary"


def _reply(block, ids, a, n, part, trigger):
    return (block, pack(ids), pack(a), pack(n), pack(part), pack(trigger))


def parse(docs: DataFrame, parts: int, blocks: int, span: int = SPAN, gram: int = GRAM, hot: np.ndarray = np.zeros(0, np.uint64)) -> DataFrame:
    """Blobs of phrases by trigger part, of hot triggers by phrase (from `parts` on), and (below 0) removals settled within a batch by document block."""

    def run(batches):
        import pyarrow as pa

        for ids, texts in chunks(batches, ["doc_id", "text"], BLOCK_BYTES):
            names = np.array([NULL_ID if i is None else i for i in ids], np.int64)
            by_id = np.argsort(names, kind="stable")
            d, a, n, trigger, phrase = phrases([texts[i] or b"" for i in by_id], span, gram)
            if not len(d):
                continue
            own = names[by_id][d]
            order = np.lexsort((trigger, phrase))
            t, p, o = trigger[order], phrase[order], own[order]
            head = np.concatenate([[True], (t[1:] != t[:-1]) | (p[1:] != p[:-1])])
            least = o[np.nonzero(head)[0]][np.cumsum(head) - 1]
            gone = np.zeros(len(d), bool)
            gone[order] = o != least
            rows = []
            home = (trigger % np.uint64(parts)).astype(np.int64)
            if len(hot):
                spread = parts + (mix(phrase ^ (trigger << np.uint64(16))) % np.uint64(parts)).astype(np.int64)
                home = np.where(np.isin(trigger, hot), spread, home)
            for part, at in _split(np.where(gone, -1 - _block_of(own, blocks), home)):
                if part < 0:
                    rows.append((part, pack(own[at]), pack(a[at]), pack(n[at] + span), None, None))
                else:
                    six = lambda x: pack(x[at].view(np.uint8).reshape(-1, 8)[:, :6].ravel())
                    rows.append((part, pack(_gaps(own[at])), pack(_gaps(a[at])), pack(n[at].astype(np.uint8)), six(trigger), six(phrase)))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), [pa.int64()] + [pa.binary()] * 5)], RECORD.replace(" long", "").replace(" binary", "").split(", "))

    return docs.mapInArrow(run, RECORD)


def _wide(blob: bytes) -> np.ndarray:
    six = unpack(blob, np.uint8).reshape(-1, 6)
    return np.concatenate([six, np.zeros((len(six), 2), np.uint8)], 1).view(np.uint64).ravel()


def settle(records: DataFrame, parts: int, blocks: int, span: int = SPAN) -> DataFrame:
    """Replies by document block: removals (part -1) and asked phrases (their part, which is `parts` or more for hot triggers)."""

    def run(key, pdf):
        import pandas as pd

        if key[0] < 0:
            rows = []
            for r in pdf.itertuples(index=False):
                ids = unpack(r.ids, np.int64)
                rows.append(_reply(-1 - r.part, ids, unpack(r.at, np.int64), unpack(r.more, np.int64), np.full(len(ids), -1, np.int64), np.zeros(len(ids), np.uint64)))
            return pd.DataFrame(rows, columns=["block", "ids", "a", "n", "part", "trigger"])
        ids, at, more, trigger, phrase = [], [], [], [], []
        for r in pdf.itertuples(index=False):
            ids.append(np.cumsum(unpack(r.ids, np.int64)))
            raw = unpack(r.more, np.uint8)
            more.append(raw.astype(np.int64))
            at.append(np.cumsum(unpack(r.at, np.int64)))
            trigger.append(_wide(r.trigger))
            phrase.append(_wide(r.phrase))
        ids, at, more, trigger, phrase = map(np.concatenate, (ids, at, more, trigger, phrase))
        order = np.lexsort((ids, phrase, trigger))
        ids, at, more, trigger, phrase = (x[order] for x in (ids, at, more, trigger, phrase))
        new_t, new_p = _heads(trigger), _heads(trigger, phrase)
        least = ids[np.nonzero(new_p)[0]][np.cumsum(new_p) - 1]
        gone = ids != least
        group = np.cumsum(new_t) - 1
        n_phrases = np.bincount(group, new_p)
        lo, hi = np.full(len(n_phrases), 2**63 - 1), np.full(len(n_phrases), -(2**63))
        np.minimum.at(lo, group, ids)
        np.maximum.at(hi, group, ids)
        ask = ~gone & ((n_phrases > 1) & (lo < hi))[group] if key[0] < parts else ~gone  # the phrases of a hot trigger lie apart
        keep = gone | ask
        part = np.where(gone, -1, key[0])[keep]
        ids, a, n, trigger = ids[keep], at[keep], more[keep] + span, trigger[keep]
        rows = [_reply(b, ids[x], a[x], n[x], part[x], trigger[x]) for b, x in _split(_block_of(ids, blocks))]
        return pd.DataFrame(rows, columns=["block", "ids", "a", "n", "part", "trigger"])

    return records.groupBy("part").applyInPandas(run, REPLY)


def _merged(a: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Intervals joined where they touch: starts, ends."""
    if not len(a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(a, kind="stable")
    s, e = a[order], np.maximum.accumulate((a + n)[order])
    head = np.concatenate([[True], s[1:] > e[:-1]])
    at = np.nonzero(head)[0]
    return s[at], e[np.concatenate([at[1:], [len(s)]]) - 1]


def _finish(name, text: bytes, s: np.ndarray, e: np.ndarray):
    if not len(s):
        return (name, len(text), 0, 0, hashlib.sha256(text).hexdigest(), text)
    kept, at = [], 0
    for x, y in zip(s.tolist(), e.tolist()):
        kept.append(text[at:x])
        at = y
    left = b"".join([*kept, text[at:]])
    return (name, len(text), int((e - s).sum()), len(s), hashlib.sha256(left).hexdigest(), left)


OUT = ["kind", "block", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes", "s", "e", "part", "ids", "at"]
OUT_SCHEMA = "kind string, block long, doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_bytes binary, s binary, e binary, part long, ids binary, at binary"


def _by_doc(pdf) -> dict[int, np.ndarray]:
    """Reply columns (a, n, part, trigger) of each document."""
    if not len(pdf):
        return {}
    cols = [np.concatenate([unpack(x, k) for x in pdf[c]]) for c, k in (("ids", np.int64), ("a", np.int64), ("n", np.int64), ("part", np.int64), ("trigger", np.uint64))]
    return {name: [c[at] for c in cols[1:]] for name, at in _split(cols[0])}


def remove_repeats(docs: DataFrame, span: int = SPAN, gram: int = GRAM, part_bytes: int = PART_BYTES, keep_text: bool = True, least_hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, unless keep_text is off, kept_bytes."""
    import pandas as pd

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = docs.select(F.sum(F.octet_length("text"))).head()[0] or 0
    parts = blocks = parts_for(total, part_bytes)
    hot = hot_triggers(docs, span, gram, least_hot)
    replies = cut(settle(parse(docs, parts, blocks, span, gram, hot), parts, blocks, span))

    # Replies know a document's block by numpy's hash; the texts get the same number.
    def placed(batches):
        import pyarrow as pa

        for b in batches:
            ids = np.array([NULL_ID if i is None else i for i in b.column(0).to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(_block_of(ids, blocks)), *b.columns], ["block", "doc_id", "text"])

    def blobs(kind, ids, rows, texts):
        """Asked phrases of one block by part."""
        out = []
        part = np.concatenate([r[0] for r in rows])
        a, n = (np.concatenate([r[i] for r in rows]) for i in (2, 3))
        own = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
        for p, at in _split(part):
            body = [texts[own[i]][a[i] : a[i] + n[i]] for i in at]
            out.append({"kind": kind, "block": 0, "part": p, "ids": pack(ids[own[at]]), "at": pack(a[at]), "s": pack(n[at]), "e": pack(np.frombuffer(b"".join(body), np.uint8))})
        return out

    def spread(rows, ids, texts, opened):
        """Strings of hot triggers in one block: equal ones of larger documents go at once, one each goes on, dealt by its hash."""
        own = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
        a, n = (np.concatenate([r[i] for r in rows]) for i in (2, 3))
        body = np.frombuffer(b"".join(texts[o][x : x + y] for o, x, y in zip(own, a, n)), np.uint8)
        phrase, shift, strings = _windows(body, n, span)
        own, a = own[phrase], a[phrase] + shift
        keys = strings.view(f"S{span}").ravel()
        order = np.lexsort((ids[own], keys))
        head = _heads(keys[order])
        gone = ids[own[order]] != ids[own[order[head]]][np.cumsum(head) - 1]
        for o, at in _split(own[order[gone]]):
            r, new = opened[o], a[order[gone]][at]
            r["s"], r["e"] = _merged(np.concatenate([r["s"], new]), np.concatenate([r["e"] - r["s"], np.full(len(new), span)]))
        at = order[~gone]  # equal strings of one document all go on: each may have to go
        h = np.zeros(len(at), np.uint64)
        for i in range(span):
            h = h * np.uint64(BASE) + BYTES[strings[at, i]]
        for p, x in _split(parts + (mix(h) % np.uint64(parts)).astype(np.int64)):
            x = at[x]
            yield {"kind": "ask", "block": 0, "part": p, "ids": pack(ids[own[x]]), "at": pack(a[x]), "s": pack(np.full(len(x), span, np.int64)), "e": pack(strings[x].ravel())}

    def first(_, text_pdf, reply_pdf):
        found = _by_doc(reply_pdf)
        out, asks, ids, texts, opened = [], [], [], [], []
        for name, text in zip(text_pdf["doc_id"].astype("Int64"), text_pdf["text"]):
            raw = b"" if text is None else text.encode()
            key, name = (NULL_ID, None) if name is pd.NA else (int(name), int(name))
            a, n, part, trigger = found.get(key, [np.zeros(0, np.int64)] * 4)
            s, e = _merged(a[part < 0], n[part < 0])
            ask = part >= 0
            ask &= a + n <= len(raw)  # rows with one doc_id may differ in length
            if not ask.any():
                r = _finish(name, raw, *(x[s < len(raw)] for x in (s, np.minimum(e, len(raw)))))
                out.append(dict(zip(OUT, ("final", 0, *r[:5], r[5] if keep_text else None))))
            else:
                opened.append({"kind": "open", "block": int(_block_of(np.array([key]), blocks)[0]), "doc_id": name, "kept_bytes": raw, "s": s, "e": e})
                asks.append((part[ask], trigger[ask], a[ask], n[ask]))
                ids.append(key)
                texts.append(raw)
        if asks:
            ids = np.array(ids, np.int64)
            cool, warm = ([tuple(c[m(r[0])] for c in r) for r in asks] for m in (lambda p: p < parts, lambda p: p >= parts))
            if any(len(r[0]) for r in cool):
                out += blobs("ask", ids, cool, texts)
            if any(len(r[0]) for r in warm):
                out += spread(warm, ids, texts, opened)
            out += [r | {"s": pack(r["s"]), "e": pack(r["e"])} for r in opened]
        return pd.DataFrame(out, columns=OUT).astype({c: "Int64" for c in ("block", "doc_id", "n_bytes", "n_removed", "n_spans", "part")})

    with_block = docs.mapInArrow(placed, "block long, doc_id long, text string")
    stage = cut(with_block.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(first, OUT_SCHEMA))

    def ordered(_, pdf):
        ids, at, n, body = (np.concatenate([unpack(x, k) for x in pdf[c]]) for c, k in (("ids", np.int64), ("at", np.int64), ("s", np.int64), ("e", np.uint8)))
        # All suffixes of the phrases with span bytes and more, cut to span bytes.
        own, shift, strings = _windows(body, n, span)
        suffix = strings.view(f"S{span}").ravel()
        order = np.lexsort((ids[own], suffix))
        s, d = suffix[order], ids[own][order]
        head = _heads(s)
        gone = d != d[np.nonzero(head)[0]][np.cumsum(head) - 1]
        rows = order[gone]
        ids, a = ids[own[rows]], at[own[rows]] + shift[rows]
        return pd.DataFrame([_reply(b, ids[x], a[x], np.full(len(x), span, np.int64), np.full(len(x), -1, np.int64), np.zeros(len(x), np.uint64)) for b, x in _split(_block_of(ids, blocks))], columns=["block", "ids", "a", "n", "part", "trigger"])

    late = stage.filter("kind = 'ask'").select("part", "ids", "at", "s", "e").groupBy("part").applyInPandas(ordered, REPLY)

    def last(_, text_pdf, reply_pdf):
        found = _by_doc(reply_pdf)
        out = []
        for name, raw, s, e in zip(text_pdf["doc_id"].astype("Int64"), text_pdf["kept_bytes"], text_pdf["s"], text_pdf["e"]):
            key, name = (NULL_ID, None) if name is pd.NA else (int(name), int(name))
            s, e = unpack(s, np.int64), unpack(e, np.int64)
            a, n, *_ = found.get(key, [np.zeros(0, np.int64)] * 4)
            s, e = _merged(np.concatenate([s, a]), np.concatenate([e - s, n]))
            r = _finish(name, raw, s, e)
            out.append(r if keep_text else (*r[:5], None))
        return pd.DataFrame(out, columns=OUT[2:8]).astype({"doc_id": "Int64"})

    final = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_bytes binary"
    rest = stage.filter("kind = 'open'").select("block", "doc_id", "kept_bytes", "s", "e").groupBy("block").cogroup(late.groupBy("block")).applyInPandas(last, final)
    done = stage.filter("kind = 'final'").select(*[c.split()[0] for c in final.split(", ")]).unionByName(rest)
    return done if keep_text else done.drop("kept_bytes")


def op3_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), keep_text=False)
