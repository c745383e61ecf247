"""LM scoring: Katz backoff with Good-Turing discounts and exactly normalised backoff weights, of order three.

Documents are bounded by start symbols and an end token. Learnt from the training documents, for histories h of two and of one word:

  P(w | h) = d(r) r / c(h)              for an n-gram of count r
           = alpha(h) P(w | shorter h)  otherwise, recursively; alpha(h) = 1 where h was never seen
  P(w)     = d(r) r / N                 for a word of count r, the rest of the mass for the one unknown class

d(r) is Katz's Good-Turing discount for r <= 5, from counts of counts of that order; alpha(h) is (1 - sum of P(w | h) over the words seen after h) /
(1 - sum of P(w | shorter h) over them), so P(. | h) sums to 1 over all words and the unknown class. Where a history
leaves no mass (no count below 6), its probabilities are scaled by c(h) / (c(h) + 1) first.

Flow: documents become blocks (dictionary and stream of local word ids, zstd). Each block sends its word counts to partitions by word hash, which
answer with a global id and count per word; then its distinct bigrams and then its distinct trigrams to partitions by history, which
answer with counts and, where a block meets an unseen n-gram, with what alpha needs. Partitions keep their part of the n-gram
tables (words, bigrams, trigrams), so the model is stored partitioned, and tokens are scored in their blocks. Blobs of numpy columns travel, not a row
per token. A block knows each history's count, so it knows the hot ones (more than `hot` tokens): their n-grams are dealt by
history and word, every part sums its share of what alpha needs, and these sums, one small row per hot history, are
joined back to the blocks that hold it. So neither the start symbol nor a frequent word or pair gathers its successors in one task.

Words are known by 64-bit hashes. Defined cases: null text is empty (one end token); a null doc_id is held out; repeated
rows count as often as they come; very long texts are blocks of their own; an empty table gives no rows; without training documents every token
is unknown and scores log10 1 = 0, and the base uses c = N = V = 0; extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, cut, discard, mix, pack, parts_for, release, skew_join, table, unpack, word_hashes

R, BLOCK_BYTES, PART_BYTES, HELD_OUT, HOT = 5, 6 << 20, 8 << 20, 10, 1_000_000
END, START = 0, 1  # local ids; words follow


def held_out(doc_id, folds: int = HELD_OUT) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds == 0


def blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """block, doc_ids, ends (of each document in the stream), held (1 per document), hashes (of local ids 2...), stream."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 32
        for ids, texts in chunks(batches, ["doc_id", "text"], block_bytes):
            hashes, n = word_hashes(texts)
            del texts
            known, local = np.unique(hashes, return_inverse=True)
            stream = np.insert(local.astype(np.uint32) + 2, np.cumsum(n), END)
            held = np.array([held_out(i) for i in ids], np.uint8)
            names = np.array([-(2**63) if i is None else i for i in ids], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([base]), *(pa.array([pack(x)], pa.binary()) for x in (names, np.cumsum(n + 1), held, known, stream))], ["block", "doc_ids", "ends", "held", "hashes", "stream"])
            base += 1
            del local, stream, hashes, known
            release()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "block long, doc_ids binary, ends binary, held binary, hashes binary, stream binary")


def _train(stream: np.ndarray, ends: np.ndarray, held: np.ndarray) -> np.ndarray:
    return np.repeat(held == 0, np.diff(ends, prepend=0))


def word_requests(b: DataFrame, parts: int) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for r in batch.to_pylist():
                hashes, stream, ends, held = unpack(r["hashes"], np.uint64), unpack(r["stream"], np.uint32), unpack(r["ends"], np.int64), unpack(r["held"], np.uint8)
                count = np.bincount(stream[_train(stream, ends, held)], minlength=len(hashes) + 2)[2:]
                rows = []
                for p, at in _split((hashes % np.uint64(parts)).astype(np.int64)):
                    rows.append((p, r["block"], pack(at.astype(np.uint32)), pack(hashes[at]), pack(count[at].astype(np.uint32))))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()])], ["part", "block", "at", "hashes", "count"])

    return b.select("block", "hashes", "stream", "ends", "held").mapInArrow(run, "part long, block long, at binary, hashes binary, count binary")


def _split(key):
    order = np.argsort(key, kind="stable")
    k = key[order]
    cuts = np.nonzero(np.concatenate([[True], k[1:] != k[:-1]]))[0] if len(k) else []
    for a, b in zip(cuts, [*cuts[1:], len(k)]):
        yield int(k[a]), order[a:b]


def _spectrum(count: np.ndarray, r: int = R) -> np.ndarray:
    return np.bincount(count[(count > 0) & (count <= r + 1)], minlength=r + 2)[: r + 2].astype(np.int64)


WORDS_OUT = "kind string, block long, at binary, id binary, count binary, n long, v long, spectrum array<long>"


def word_replies(requests: DataFrame, parts: int) -> DataFrame:
    """Per block the global ids and counts of its words; per part its table and sums."""

    def run(key, pdf):
        import pandas as pd

        hashes = [unpack(x, np.uint64) for x in pdf["hashes"]]
        counts = [unpack(x, np.uint32) for x in pdf["count"]]
        known, where = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(where, np.concatenate(counts), len(known)).astype(np.int64)
        rank = np.empty(len(known), np.int64)
        rank[np.argsort(-total, kind="stable")] = np.arange(len(known))
        ids = (rank * parts + int(key[0]) + 2).astype(np.uint64)  # frequent words get small ids
        out, at = [], 0
        for block, place, h in zip(pdf["block"], pdf["at"], hashes):
            w = where[at : at + len(h)]
            at += len(h)
            out.append(("reply", block, place, pack(ids[w]), pack(total[w]), 0, 0, None))
        out.append(("table", int(key[0]), pack(known), pack(ids), pack(total), int(total.sum()), int((total > 0).sum()), _spectrum(total).tolist()))
        return pd.DataFrame(out, columns=[c.split()[0] for c in WORDS_OUT.split(", ")])

    return requests.groupBy("part").applyInPandas(run, WORDS_OUT)


def discounts(spectrum: list[int], r: int = R) -> np.ndarray:
    """Katz's d(0..r): (r*/r - A) / (1 - A) with r* = (r + 1) n[r+1] / n[r] and A = (r_max + 1) n[r_max+1] / n[1]; (r - 1/2) / r where that isn't in (0, 1)."""
    n = [float(x) for x in spectrum]
    d = np.ones(r + 1)
    a = (r + 1) * n[r + 1] / n[1] if n[1] else 1.0
    for c in range(1, r + 1):
        x = ((c + 1) * n[c + 1] / n[c] / c - a) / (1 - a) if n[c] and a != 1 else 0.0
        d[c] = x if 0 < x < 1 else (c - 0.5) / c
    return d


def unigram(count: np.ndarray, n: int, d: np.ndarray, seen_mass: float) -> np.ndarray:
    """P(w) by count; count 0 is the unknown class."""
    if not n:
        return np.ones(len(count))
    p = count * np.where(count <= R, d[np.minimum(count, R)], 1.0) / n
    short = seen_mass >= 1 - 1e-12
    p = p * (n / (n + 1) if short else 1.0)
    return np.where(count > 0, p, 1 / (n + 1) if short else 1 - seen_mass)


def narrow(x: np.ndarray) -> bytes:
    """Whole numbers from 0 on as a blob of the least width that holds them."""
    top = int(x.max()) if len(x) else 0
    width = next(k for k in (1, 2, 4, 8) if k == 8 or top < 1 << (8 * k))
    return bytes([width]) + pack(x.astype(f"<u{width}"), 1)


def wide(blob: bytes) -> np.ndarray:
    return unpack(blob[1:], f"<u{blob[0]}").astype(np.uint64)


def frame(rows: list[tuple], schema: str):
    import pandas as pd

    return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])


NUMBERED = "block long, doc_ids binary, ends binary, held binary, stream binary, ids binary, counts binary"
COUNTED = NUMBERED + ", count2 binary, alpha2 binary, none2 binary"


def numbered(b: DataFrame, replies: DataFrame, train_docs: int) -> DataFrame:
    """Blocks with the global id and count of each local id instead of hashes."""

    def run(_, own, words):
        out = []
        for r in own.to_dict("records"):
            size = len(unpack(r["hashes"], np.uint64)) + 2
            ids, counts = np.zeros(size, np.uint64), np.zeros(size, np.int64)
            ids[START], counts[END], counts[START] = 1, train_docs, train_docs
            for place, i, c in zip(words["at"], words["id"], words["count"]):
                at = unpack(place, np.uint32).astype(np.int64) + 2
                ids[at], counts[at] = unpack(i, np.uint64), unpack(c, np.int64)
            out.append((*(r[c] for c in ("block", "doc_ids", "ends", "held", "stream")), narrow(ids), narrow(counts)))
        release()
        return frame(out, NUMBERED)

    return b.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(run, NUMBERED)


def _slim(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint32) if not len(x) or x.max() < 2**32 else x


def _long(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64)


def _runs(new: np.ndarray) -> np.ndarray:
    """Number of the run of each row, from marks of first rows."""
    return (np.cumsum(new) - 1).astype(np.int32)


class Grams:
    """Distinct n-grams of one block: bigrams, and trigrams once bigram counts are known, with their histories, parts and order of travel (by part, history, word)."""

    def __init__(self, r: dict, order: int, parts: int, hot: int):
        self.parts, self.order = parts, order
        self.ends, self.held = unpack(r["ends"], np.int64), unpack(r["held"], np.uint8)
        stream = unpack(r["stream"], np.uint32).astype(np.int64)
        self.stream, self.ids, self.counts = stream.astype(np.int32), _slim(wide(r["ids"])), wide(r["counts"]).astype(np.int64)
        self.train = np.repeat(self.held == 0, np.diff(self.ends, prepend=0))
        starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        key = np.concatenate([[START], stream[:-1]])
        key[starts] = START
        key <<= 32
        key |= stream
        pairs, where = np.unique(key, return_inverse=True)
        del key
        self.where2, n2 = where.astype(np.int32), len(pairs)
        self.v2, self.w2 = (pairs >> 32).astype(np.int32), (pairs & (2**32 - 1)).astype(np.int32)
        del pairs, where
        self.hist2 = _runs(_heads(self.v2))
        if order == 2:
            self.where, self.v, self.w, self.hist = self.where2, self.ids[self.v2], self.ids[self.w2], self.hist2
            self.u = np.zeros(n2, np.uint8)
            self.total = self.counts[self.v2]
            self.spread = self.total > hot
            deal, place = mix(_long(self.v)), np.arange(n2)
        else:
            self.count2 = wide(r["count2"]).astype(np.int64)
            key = np.concatenate([[0], self.where2[:-1]]).astype(np.int64)
            key[starts] = n2  # two start symbols
            key <<= 32
            key |= stream
            grams, where = np.unique(key, return_inverse=True)
            del key, stream
            self.where = where.astype(np.int32)
            p, w = (grams >> 32).astype(np.int32), (grams & (2**32 - 1)).astype(np.int32)
            del grams, where
            u_of, v_of = np.append(self.v2, START), np.append(self.w2, START)
            self.u, self.v, self.w, self.hist = self.ids[u_of[p]], self.ids[v_of[p]], self.ids[w], _runs(_heads(p))
            self.total = np.append(self.count2, self.counts[START])[p]
            self.spread = self.total > hot
            self.short = np.zeros(len(p), np.int32)  # the bigram (v, w) of each trigram
            self.short[self.where] = self.where2
            deal = np.where(self.counts[v_of[p]] <= hot, mix(_long(self.v)), mix(_long(self.v) * np.uint64(31) + _long(self.u)))
            rank = np.empty(n2 + 1, np.int64)
            rank[np.argsort((v_of.astype(np.int64) << 32) | u_of)] = np.arange(n2 + 1)
            place = rank[p]
        if self.spread.any():
            deal = np.where(self.spread, mix(deal ^ mix(_long(self.w) + np.uint64(7))), deal)
        self.part = (deal % np.uint64(parts)).astype(np.int64)
        del deal
        self.sorted = np.argsort(self.part * (n2 + 1) + place, kind="stable").astype(np.int32)

    def by_part(self):
        key = self.part[self.sorted]
        cuts = np.nonzero(_heads(key))[0]
        for a, b in zip(cuts, [*cuts[1:], len(key)]):
            yield int(key[a]), self.sorted[a:b]


def _steps(x: np.ndarray) -> tuple[bytes, bytes]:
    """Values in runs as a blob of their heads and one of run lengths."""
    at = np.nonzero(_heads(x))[0]
    return narrow(x[at]), narrow(np.diff(np.append(at, len(x))))


def _from_steps(values: bytes, runs: bytes) -> np.ndarray:
    return np.repeat(wide(values), wide(runs).astype(np.int64))


REQUEST = "part long, block long, v binary, runs binary, u binary, w binary, train binary, low binary, lowc binary, spread binary"
ANSWER = "kind string, block long, part long, count binary, none binary, small binary, sums binary, v long, u long, l1 long, l2 long, l3 long, l4 long, l5 long, sum double, spectrum array<long>, tv binary, tu binary, tw binary"


def gram_requests(b: DataFrame, order: int, parts: int, hot: int) -> DataFrame:
    """By part: a block's distinct n-grams with their training counts and what the shorter probability of their word needs."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for r in batch.to_pylist():
                g = Grams(r, order, parts, hot)
                train = np.bincount(g.where, g.train, len(g.v)).astype(np.int64)
                if order == 2:
                    low, lowc = np.where(train > 0, g.counts[g.w2], 0), np.zeros(len(g.v), np.int64)
                else:
                    none = unpack(r["none2"], np.uint8)[g.hist2]
                    low = np.where(train > 0, g.count2[g.short], 0)
                    lowc = np.where(train > 0, 2 * g.counts[g.v2[g.short]] + none[g.short], 0)
                rows = [(p, r["block"], *_steps(g.v[at]), narrow(g.u[at]), narrow(g.w[at]), narrow(train[at]), narrow(low[at]), narrow(lowc[at]), narrow(g.spread[at])) for p, at in g.by_part()]
                kinds = [pa.int64(), pa.int64()] + [pa.binary()] * 8
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], [c.split()[0] for c in REQUEST.split(", ")])
                del g, train, low, lowc, rows
                release()

    return b.mapInArrow(run, REQUEST)


def _heads(*keys: np.ndarray) -> np.ndarray:
    new = np.zeros(len(keys[0]), bool)
    if len(new):
        new[0] = True
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
    return new


def _order(v: np.ndarray, u: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Order by (v, u, w): two plain sorts of one number where the ids allow, as they are much faster than a stable one by several keys."""
    if max(v.max(), u.max(), w.max()) >= 2**32:
        return np.lexsort((w, u, v))
    key = (v << np.uint64(32)) | u
    order = np.argsort(key)
    rank = np.empty(len(key), np.uint64)
    rank[order] = np.cumsum(_heads(key[order])) - 1
    return np.argsort((rank << np.uint64(32)) | w)


def gram_answers(requests: DataFrame, shorter, tasks: int) -> DataFrame:
    """Per block and part the counts of its n-grams and, per history, whether it leaves no mass and what alpha needs; per hot history a part's share of that; per part its table. `shorter` gives P(w | shorter history) from (low, lowc)."""

    def run(key, pdf):
        joined = lambda c: np.concatenate([wide(x) for x in pdf[c]])
        each = [_from_steps(x, n) for x, n in zip(pdf["v"], pdf["runs"])]
        v, u, w, sizes = np.concatenate(each), joined("u"), joined("w"), [len(x) for x in each]
        del each
        order = _order(v, u, w)
        v, u, w = v[order], u[order], w[order]
        new = _heads(v, u, w)
        gram = np.cumsum(new) - 1
        where = np.empty(len(order), np.int64)
        where[order] = gram
        n = int(new.sum())
        count = np.bincount(where, joined("train"), n).astype(np.int64)
        low, lowc = np.zeros(n, np.int64), np.zeros(n, np.int64)
        np.maximum.at(low, where, joined("low").astype(np.int64))
        np.maximum.at(lowc, where, joined("lowc").astype(np.int64))
        v, u, w = v[new], u[new], w[new]
        first = _heads(v, u)
        hist = np.cumsum(first) - 1
        k = int(first.sum())
        few = np.stack([np.bincount(hist, count == r, k).astype(np.int64) for r in range(1, R + 1)])
        sums = np.bincount(hist, np.where(count > 0, shorter(low, lowc), 0.0), k)
        hot = np.zeros(n, bool)
        hot[where[joined("spread").astype(bool)]] = True
        none = few.sum(0) == 0
        out, at = [], 0
        blank = (None,) * 12
        for block, size in zip(pdf["block"], sizes):
            own = where[at : at + size]
            at += size
            h = hist[own]
            lead = _heads(h)
            group = np.cumsum(lead) - 1
            unseen = np.bincount(group, count[own] == 0, int(lead.sum())) > 0
            mine = h[lead]
            out.append(("reply", block, int(key[0]), narrow(count[own]), pack(none[mine].astype(np.uint8)), narrow((few[:, mine] * unseen).ravel()), pack(np.where(unseen, sums[mine], 0.0)), *blank))
        for x in np.unique(hist[hot]):
            at = int(np.nonzero(first)[0][x])
            out.append(("hot", 0, int(key[0]), None, None, None, None, int(v[at]), int(u[at]), *(int(c) for c in few[:, x]), float(sums[x]), None, None, None, None))
        kept = count > 0
        out.append(("table", 0, int(key[0]), narrow(count[kept]), None, None, None, *(None,) * 8, _spectrum(count).tolist(), narrow(np.diff(v[kept], prepend=np.uint64(0))), narrow(u[kept]), narrow(w[kept])))
        release()
        found = frame(out, ANSWER)
        return found.astype({c: "Int64" for c in ("v", "u", "l1", "l2", "l3", "l4", "l5")}).astype({"sum": "float64"})

    return requests.repartition(tasks, "part").groupBy("part").applyInPandas(run, ANSWER)


LOWS = [f"l{r}" for r in range(1, R + 1)]
BACK = "what long, block long, part long, count binary, none binary, small binary, sums binary, v long, u long, l1 long, l2 long, l3 long, l4 long, l5 long, sum double"


def answers_by_block(b: DataFrame, answers: DataFrame, order: int, parts: int, hot: int) -> DataFrame:
    """Replies and, for the hot histories that a block holds, their summed rows, all keyed by block."""

    def held(batches):
        import pyarrow as pa

        for batch in batches:
            for r in batch.to_pylist():
                g = Grams(r, order, parts, hot)
                at = np.nonzero(g.spread)[0]
                at = at[np.unique(g.hist[at], return_index=True)[1]]
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array([r["block"]] * len(at), pa.int64()), pa.array(g.v[at].astype(np.int64)), pa.array(g.u[at].astype(np.int64))], ["block", "v", "u"])

    replies = answers.filter("kind = 'reply'").select(F.lit(0).cast("long").alias("what"), "block", "part", "count", "none", "small", "sums", *[F.lit(None).cast(t).alias(c) for c, t in [("v", "long"), ("u", "long"), *[(x, "long") for x in LOWS], ("sum", "double")]])
    shares = cut(answers.filter("kind = 'hot'").groupBy("v", "u").agg(*[F.sum(x).alias(x) for x in LOWS], F.sum("sum").alias("sum")))
    if shares.isEmpty():
        return replies
    needs = cut(b.mapInArrow(held, "block long, v long, u long"))
    rows = skew_join(needs, shares, ["v", "u"], "inner")
    return replies.unionByName(rows.withColumn("what", F.lit(1).cast("long")), allowMissingColumns=True).select(*[c.split()[0] for c in BACK.split(", ")])


def gathered(g: Grams, back, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per n-gram its count; per history (g.hist) whether it leaves no mass, and alpha where the block needs it (else 1)."""
    k = int(g.hist.max()) + 1 if len(g.hist) else 0
    count, none, sums, few = np.zeros(len(g.v), np.int64), np.zeros(k, bool), np.zeros(k), np.zeros((R, k), np.int64)
    at_part = dict(g.by_part())
    for x in back[back["what"] == 0].to_dict("records"):
        at = at_part[int(x["part"])]
        count[at] = wide(x["count"])
        mine = g.hist[at][_heads(g.v[at], g.u[at])]
        none[mine], sums[mine], few[:, mine] = unpack(x["none"], np.uint8).astype(bool), unpack(x["sums"], np.float64), wide(x["small"]).astype(np.int64).reshape(R, -1)
    hot = back[back["what"] == 1]
    if len(hot):
        rows = np.nonzero(g.spread)[0]
        rows = rows[np.unique(g.hist[rows], return_index=True)[1]]
        place = {(int(a), int(b)): g.hist[i] for a, b, i in zip(g.v[rows], g.u[rows], rows)}
        for x in hot.to_dict("records"):
            h = place[int(x["v"]), int(x["u"])]
            few[:, h], sums[h] = [int(x[c]) for c in LOWS], x["sum"]
            none[h] = few[:, h].sum() == 0
    c = np.zeros(k, np.int64)
    c[g.hist] = g.total
    return count, none, alphas(c, none, few, sums, d)


def alphas(c: np.ndarray, none: np.ndarray, few: np.ndarray, sums: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Backoff weights of histories: left mass over the shorter distribution's mass of unseen words; 1 for histories never seen."""
    c1 = np.maximum(c, 1)
    left = np.where(none, 1 / (c1 + 1), sum((1 - d[r]) * r * few[r - 1] for r in range(1, R + 1)) / c1)
    return np.where(c > 0, left / np.maximum(1 - sums, 1e-12), 1.0)


def seen(count: np.ndarray, c: np.ndarray, none: np.ndarray, d: np.ndarray) -> np.ndarray:
    """P(w | h) of n-grams that were counted."""
    c1 = np.maximum(c, 1)
    return np.where(none, c1 / (c1 + 1), 1.0) * d[np.minimum(count, R)] ** (count <= R) * count / c1


def counted(b: DataFrame, back: DataFrame, parts: int, hot: int, d2: np.ndarray) -> DataFrame:
    """Blocks with the counts of their bigrams and the alphas of their histories of one word."""

    def run(_, own, replies):
        out = []
        for r in own.to_dict("records"):
            g = Grams(r, 2, parts, hot)
            count, none, alpha = gathered(g, replies, d2)
            out.append((*(r[c.split()[0]] for c in NUMBERED.split(", ")), narrow(count), pack(alpha), pack(none.astype(np.uint8))))
        release()
        return frame(out, COUNTED)

    return b.groupBy("block").cogroup(back.groupBy("block")).applyInPandas(run, COUNTED)


def _spectra(answers: DataFrame) -> list[int]:
    found = answers.filter("kind = 'table'").agg(*[F.sum(F.col("spectrum")[r]) for r in range(R + 2)]).head()
    return [int(x or 0) for x in found]


def score(docs: DataFrame, part_bytes: int = PART_BYTES, block_bytes: int = BLOCK_BYTES, hot: int = HOT, tables: dict | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. `tables`, if given, gets the stored tables of words, bigrams and trigrams."""
    total = docs.select(F.sum(F.octet_length("text"))).head()[0] or 0
    parts, tasks = parts_for(total, part_bytes), parts_for(total, 2 * part_bytes)  # a task holds about two parts whatever the session's settings
    b = cut(blocks(docs, block_bytes))
    train_docs = b.select("held").mapInArrow(_count_train, "n long").agg(F.sum("n")).head()[0] or 0
    words = cut(word_replies(word_requests(b, parts), parts))
    vocabulary = cut(words.filter("kind = 'table'"))
    sums = vocabulary.agg(F.sum("n"), F.sum("v"), *[F.sum(F.col("spectrum")[r]) for r in range(R + 2)]).head()
    spectrum = [int(x or 0) for x in sums[2:]]
    if 0 < train_docs <= R + 1:
        spectrum[train_docs] += 1
    n, v = int(sums[0] or 0) + train_docs, int(sums[1] or 0) + (train_docs > 0)
    d1 = discounts(spectrum)
    mass = 1 - sum((1 - d1[r]) * r * spectrum[r] for r in range(1, R + 1)) / max(n, 1)
    b2 = cut(numbered(b, words.filter("kind = 'reply'").select("block", "at", "id", "count"), train_docs))
    discard(b, words)

    def by_word(low, lowc):
        return unigram(low, n, d1, mass)

    second = cut(gram_answers(gram_requests(b2, 2, parts, hot), by_word, tasks))
    d2 = discounts(_spectra(second))
    bigrams = cut(second.filter("kind = 'table'").select("part", "count", "tv", "tw"))
    b3 = cut(counted(b2, answers_by_block(b2, second, 2, parts, hot), parts, hot, d2))
    discard(b2, second)

    def by_bigram(low, lowc):
        return np.where(low > 0, seen(low, lowc >> 1, (lowc & 1) == 1, d2), 0.0)

    third = cut(gram_answers(gram_requests(b3, 3, parts, hot), by_bigram, tasks))
    d3 = discounts(_spectra(third))
    if tables is not None:
        tables |= {"words": vocabulary, "bigrams": bigrams, "trigrams": third.filter("kind = 'table'").select("part", "count", "tv", "tu", "tw")}

    def run(_, own, replies):
        import pandas as pd

        out = []
        for r in own.to_dict("records"):
            g = Grams(r, 3, parts, hot)
            count, none, alpha = gathered(g, replies, d3)
            p1 = unigram(g.counts[g.w2], n, d1, mass)
            none2, alpha2 = unpack(r["none2"], np.uint8).astype(bool)[g.hist2], unpack(r["alpha2"], np.float64)[g.hist2]
            p2 = np.where(g.count2 > 0, seen(g.count2, g.counts[g.v2], none2, d2), alpha2 * p1)
            p3 = np.where(count > 0, seen(count, g.total, none[g.hist], d3), alpha[g.hist] * p2[g.short])
            q = np.log10(p3)[g.where]
            own_count = g.counts[g.stream]
            base = np.log10((own_count + 0.1) / (n + 0.1 * (v + 1)))
            starts = np.concatenate([[0], g.ends[:-1]])
            each = lambda x, starts=starts: np.add.reduceat(x, starts)
            names = [None if i == -(2**63) else int(i) for i in unpack(r["doc_ids"], np.int64)]
            out.append(pd.DataFrame({"doc_id": pd.array(names, "Int64"), "held_out": g.held == 1, "n_tokens": g.ends - starts, "n_known": each((own_count > 0).astype(np.int64)), "train_tokens": n, "base_score": each(base), "score": each(q)}))
        release()
        return pd.concat(out) if out else pd.DataFrame({c: [] for c in ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")})

    back = answers_by_block(b3, third, 3, parts, hot)
    return b3.groupBy("block").cogroup(back.groupBy("block")).applyInPandas(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _count_train(batches):
    import pyarrow as pa

    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([int((unpack(x, np.uint8) == 0).sum()) for x in batch.column(0).to_pylist()], pa.int64())], ["n"])


def op5_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
