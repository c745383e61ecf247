"""Language identification by prediction by partial matching over bytes.

Per language a tree of byte contexts of 0 to `order` bytes counts which byte followed; the counts are frozen once learned. A byte's code length is that of
its longest known context, with escapes to shorter ones: in a context seen T times with D distinct followers a follower seen n times has probability
n / (T + D) and the escape D / (T + D); bytes already refused by a longer context are excluded from T and D of the shorter ones, and what no context
knows is uniform over the bytes the empty context has not seen. The probabilities of all 256 bytes add up to one in every context, so the summed code
length of a text is exact. The language whose tree gives the shortest code is the prediction, its score the share of its probability among all
languages' (2^-bits, normalised).

Every text counts as preceded by `order` newlines, so each byte has a full context and the shorter contexts' counts are sums of the longest ones': a
model is one table (lang, gram, n) of grams of order + 1 bytes. Texts are scored by their distinct grams, whose code lengths are computed
once per batch. Work a byte grows with the number of languages; nothing else does.

The classifier is fitted on a bounded sample of the labelled rows: pieces of 4096 bytes, chosen by a hash, of about `sample_bytes` in all, shared evenly by the languages
(a smaller language is taken whole). The sample is halved until its grams are at most `most_grams`; only then is the model (that many rows of
12 bytes at most) broadcast. Every text is predicted whole.

Defined cases: a null text, or one without a letter, is `und` with score 0; so is every text if nothing was learned; nulls in lang take no part in learning;
ties go to the least lang by code points; repeated rows count as often as they stand there; doc_id, lang and source are never read by a prediction; an
empty table gives no rows; other columns are ignored. A null doc_id is not held out.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, cut, discard, pack, table, unpack

ORDER, SAMPLE_BYTES, MOST_GRAMS, PIECE, MOST_LANGS = 3, 48_000_000, 4_000_000, 4096, 2000
BATCH = 4 << 20
UNKNOWN = "und"


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def pieces_of(text: bytes, order: int, size: int) -> list[bytes]:
    """A text in pieces of `size` bytes, each behind the `order` bytes before it."""
    text = b"\n" * order + text
    return [text[a : a + order + size] for a in range(0, max(1, len(text) - order), size)]


def grams_of(pieces: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (piece, gram) pairs in order and how often they stand; the first `order` bytes of a piece are context only."""
    raw = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    wide = raw.astype(np.uint64)
    gram = wide[order:].copy()
    for k in range(1, order + 1):
        gram |= wide[order - k : len(wide) - k] << np.uint64(8 * k)
    own = np.ones(len(raw), bool)
    for k in range(order):
        own[np.cumsum(sizes) - sizes + k] = False
    key = gram[own[order:]] | (np.repeat(np.arange(len(pieces), dtype=np.uint64), sizes - order) << np.uint64(8 * order + 8))
    key.sort()
    heads = np.nonzero(np.concatenate([[True], key[1:] != key[:-1]]))[0] if len(key) else np.zeros(0, np.int64)
    n = np.diff(np.append(heads, len(key)))
    key = key[heads]
    return (key >> np.uint64(8 * order + 8)).astype(np.int64), key & np.uint64((1 << (8 * order + 8)) - 1), n


class ContextTree:
    """Frozen counts of one language. Per context length k: sorted grams g of k + 1 bytes with counts n; sorted contexts c with T, D and, for exclusion, M:
    what a context's followers weigh in the next shorter context."""

    def __init__(self, grams: np.ndarray, n: np.ndarray, order: int):
        self.levels, grams, n = [], grams.astype(np.uint64), n.astype(np.float64)
        for k in range(order, -1, -1):
            g, at = np.unique(grams & np.uint64((1 << (8 * k + 8)) - 1), return_inverse=True)
            grams, n = g, np.bincount(at, n, len(g))
            c, of = np.unique(g >> np.uint64(8), return_inverse=True)
            self.levels.append({"k": k, "g": g, "n": n, "c": c, "of": of, "T": np.bincount(of, n, len(c)), "D": np.bincount(of, minlength=len(c)).astype(np.float64)})
        for high, low in zip(self.levels, self.levels[1:]):
            at = np.searchsorted(low["g"], high["g"] & np.uint64((1 << (8 * low["k"] + 8)) - 1))
            high["M"] = np.bincount(high["of"], low["n"][at], len(high["c"]))
        for level in self.levels:
            level.pop("of")

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """Code length in bits of each gram's last byte behind the bytes before it."""
        bits, m, d = (np.zeros(len(grams)) for _ in range(3))
        left = np.arange(len(grams))
        for level in self.levels:
            if not len(left) or not len(level["g"]):
                continue
            g = grams[left] & np.uint64((1 << (8 * level["k"] + 8)) - 1)
            c = np.minimum(np.searchsorted(level["c"], g >> np.uint64(8)), len(level["c"]) - 1)
            known = level["c"][c] == g >> np.uint64(8)  # an unknown context costs nothing: the next shorter one is asked without exclusions
            who, g, c = left[known], g[known], c[known]
            escape = np.where(level["D"][c] < 256, level["D"][c] - d[who], 0)
            total = level["T"][c] - m[who] + escape
            at = np.minimum(np.searchsorted(level["g"], g), len(level["g"]) - 1)
            hit = level["g"][at] == g
            mass = np.where(hit, level["n"][at], escape)
            paid = mass > 0  # no follower is left to escape from: the escape is certain
            bits[who[paid]] += np.log2(total[paid] / mass[paid])
            m[who], d[who] = (level["M"][c] if "M" in level else 0), level["D"][c]
            left = np.sort(np.concatenate([left[~known], who[~hit]]))
        bits[left] += np.log2(256 - d[left])
        return bits


def sampled_grams(labelled: DataFrame, order: int, share: dict[str, float]) -> DataFrame:
    """(lang, gram, n), stored: counts over the pieces that a hash of document and piece takes with each language's share."""

    def run(batches):
        import pyarrow as pa
        import xxhash

        for seeds, langs, texts in chunks(batches, ["seed", "lang", "text"], BATCH):
            taken: dict[bytes, list[bytes]] = {}
            for seed, lang, text in zip(seeds, langs, texts):
                least = int(share[lang.decode()] * 2**64)
                own = taken.setdefault(lang, [])
                for j, piece in enumerate(pieces_of(text, order, PIECE) if text else []):
                    if xxhash.xxh3_64_intdigest(f"{seed}:{j}") < least:
                        own.append(piece)
            for lang, pieces in taken.items():
                if pieces:
                    _, gram, n = grams_of(pieces, order)
                    gram, at = np.unique(gram, return_inverse=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang.decode()] * len(gram)), pa.array(gram.astype(np.int64)), pa.array(np.bincount(at, n, len(gram)).astype(np.int64))], ["lang", "gram", "n"])

    rows = labelled.select(F.xxhash64("doc_id", "text").alias("seed"), "lang", "text")
    return cut(rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def fitted(labelled: DataFrame, order: int = ORDER, sample_bytes: int = SAMPLE_BYTES, most_grams: int = MOST_GRAMS) -> dict[str, tuple[bytes, bytes]]:
    """Packed grams and counts of each language, `most_grams` in all at most. labelled: doc_id, lang, text, without nulls in lang and text."""
    sizes = labelled.groupBy("lang").agg(F.sum(F.octet_length("text").cast("double")).alias("n")).limit(MOST_LANGS + 1).collect()
    if len(sizes) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} values of lang")
    if not sizes:
        return {}
    while True:
        share = {r["lang"]: min(1.0, sample_bytes / len(sizes) / max(r["n"], 1.0)) for r in sizes}
        model = sampled_grams(labelled, order, share)
        if model.count() <= most_grams:
            break
        discard(model)
        sample_bytes //= 2

    def run(key, pdf):
        import pandas as pd

        pdf = pdf.sort_values("gram")
        return pd.DataFrame({"lang": [key[0]], "grams": [pack(pdf["gram"].to_numpy(np.uint64))], "n": [pack(pdf["n"].to_numpy(np.int64))]})

    packed = {r["lang"]: (bytes(r["grams"]), bytes(r["n"])) for r in model.groupBy("lang").applyInPandas(run, "lang string, grams binary, n binary").collect()}
    discard(model)
    none = (pack(np.zeros(0, np.uint64)), pack(np.zeros(0, np.int64)))
    return {r["lang"]: packed.get(r["lang"], none) for r in sizes}


_TREES: dict = {}


def _trees(key: int, model: dict, order: int) -> tuple[list[str], list[ContextTree]]:
    """The trees of a model, built once per worker."""
    if key not in _TREES:
        _TREES.clear()
        names = sorted(model)
        _TREES[key] = names, [ContextTree(unpack(model[k][0], np.uint64), unpack(model[k][1], np.int64), order) for k in names]
    return _TREES[key]


def code_lengths(texts: list[bytes], trees: list[ContextTree], order: int, batch: int = BATCH) -> np.ndarray:
    """Bits of each text under each tree."""
    out = np.zeros((len(texts), len(trees)))
    waiting, owner, size = [], [], 0

    def settle():
        piece, gram, n = grams_of(waiting, order)
        kinds, at = np.unique(gram, return_inverse=True)
        doc = np.array(owner)[piece]
        for j, tree in enumerate(trees):
            out[:, j] += np.bincount(doc, tree.bits(kinds)[at] * n, len(texts))
        waiting.clear(), owner.clear()

    for i, text in enumerate(texts):
        for piece in pieces_of(text, order, batch):
            waiting.append(piece)
            owner.append(i)
            size += len(piece)
            if size >= batch:
                settle()
                size = 0
    if waiting:
        settle()
    return out


def identified(docs: DataFrame, model: dict[str, tuple[bytes, bytes]], order: int = ORDER) -> DataFrame:
    """doc_id, held_out, lang_pred, score, bits (of the predicted language, per byte) for each row of docs, from its text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = id(model) ^ shared._jbroadcast.id()

    def run(batches):
        import pyarrow as pa

        names, trees = _trees(key, shared.value, order)
        kinds = [pa.int64(), pa.bool_(), pa.string(), pa.float64(), pa.float64()]
        for ids, held, letter, texts in chunks(batches, ["doc_id", "held_out", "letter", "text"], BATCH):
            judged = [i for i, ok in enumerate(letter) if ok and names]
            pred, score, rate = [UNKNOWN] * len(ids), [0.0] * len(ids), [None] * len(ids)
            if judged:
                bits = code_lengths([texts[i] for i in judged], trees, order)
                best = bits.argmin(1)
                low = bits[np.arange(len(judged)), best]
                share = 1 / np.exp2(np.maximum(low[:, None] - bits, -1000)).sum(1)
                for i, b, p, s in zip(judged, best, share, low):
                    pred[i], score[i], rate[i] = names[b], float(p), float(s) / len(texts[i])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((ids, held, pred, score, rate), kinds)], ["doc_id", "held_out", "lang_pred", "score", "bits"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letter"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, bits double")


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return identified(docs, fitted(docs.filter(~held_out()).filter("lang IS NOT NULL AND text IS NOT NULL")))
