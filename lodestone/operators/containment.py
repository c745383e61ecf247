"""Which texts contain which quotes, by seeds: a join on hashes of short stretches, then an exact test.

A text's stretches are its runs of `gram` bytes; of every `span` neighbouring runs only the one with the least hash is kept. A quote that stands in a text
brings all its windows along, so the stretches kept for a quote of gram + span - 1 bytes or more are kept for the text too. Each quote looks for its
rarest kept stretch only, by counts over all texts (of stretches that some quote has), so a common phrase draws no candidates. Shorter
quotes are looked up by runs of their own length class (16, 8, 4, 2 or 1 bytes), all kept. Pairs that share a seed, and a key if there is one, are
confirmed by an exact substring test; nothing passes through the driver, and texts are scanned once whatever the number of quotes. Under a key of
few quotes the exact test alone is less work: such keys join directly, and texts of other keys give stretches of their own quotes' levels only.

Defined cases: null or empty quotes and null texts meet nothing; repeated rows are one pair; quotes that no text can hold are dropped before the join.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.operators.shared import removed, written

GRAM, SPAN = 16, 12
PIECE, HELD = 1 << 18, 1 << 17  # bytes hashed at once; stretches handed on together
FEW = 16  # quotes of a key that are searched for one by one
LEVELS = ((16, 12, 27), (16, 1, 16), (8, 1, 8), (4, 1, 4), (2, 1, 2), (1, 1, 1))  # gram, span, least length of a quote


def stretch_hashes(raw: np.ndarray, gram: int, span: int) -> np.ndarray:
    """Distinct hashes of the kept runs of a byte array, piece by piece; gram is a power of two."""
    more = gram + span - 2
    pieces = [_piece_hashes(raw[at : at + PIECE + more].astype(np.uint64), gram, span) for at in range(0, max(1, len(raw) - more), PIECE)]
    return pieces[0] if len(pieces) == 1 else np.unique(np.concatenate(pieces))


def _piece_hashes(raw: np.ndarray, gram: int, span: int) -> np.ndarray:
    if len(raw) < gram:
        return np.zeros(0, np.uint64)
    h, size, factor = raw + np.uint64(1), 1, 0x100000001B3
    while size < gram:  # runs of twice the size from two neighbours
        h = h[:-size] * np.uint64(factor) + h[size:]
        size, factor = 2 * size, factor * factor % (1 << 64)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    width = 1
    while width < span:  # the least of `span` neighbours, by doubling
        step = min(width, span - width)
        if len(h) <= step:
            break
        h = np.minimum(h[:-step], h[step:])
        width += step
    return np.unique(h[np.concatenate([[True], h[1:] != h[:-1]])])  # neighbours share their least run


def _stretches(rows: DataFrame, cols: list[str], text: str, level: str) -> DataFrame:
    """(cols, level, sh) for each kept stretch of a text at each of its levels (an array column)."""
    kinds = dict(rows.dtypes)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            which, lv, sh, held = [], [], [], 0
            for i in range(b.num_rows):  # a text and its stretches are held as numbers for itself only
                raw = np.frombuffer(b.column(len(cols))[i].as_buffer() or b"", np.uint8)
                for k in b.column(len(cols) + 1)[i].as_py():
                    found = stretch_hashes(raw, *LEVELS[k][:2])
                    which.append(np.full(len(found), i, np.int32))
                    lv.append(np.full(len(found), k, np.int32))
                    sh.append(found.view(np.int64))
                    held += len(found)
                if sh and (held > HELD or i == b.num_rows - 1):
                    at = pa.array(np.concatenate(which))
                    yield pa.RecordBatch.from_arrays([b.column(c).take(at) for c in range(len(cols))] + [pa.array(np.concatenate(lv)), pa.array(np.concatenate(sh))], [*cols, "level", "sh"])
                    which, lv, sh, held = [], [], [], 0

    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in cols), "level int", "sh long"])
    return rows.select(*cols, text, level).mapInArrow(run, schema)


def contained(texts: DataFrame, quotes: DataFrame, key: str | None = None, norm: Callable[[Column], Column] | None = None) -> DataFrame:
    """(text_id, quote_id): texts that contain a quote, of the same key if one is named. texts: text_id, body and key; quotes: quote_id, quote and key; ids of any type.

    Both are compared in the form that `norm` gives them; give raw texts, so that only texts with a candidate are brought into it a second time."""
    keys = [key] if key else []
    norm = norm or (lambda c: c)
    q = quotes.withColumn("quote", norm(F.col("quote"))).filter("quote != ''").select("quote_id", "quote", *keys).distinct()
    size = F.octet_length("quote")
    level = F.lit(len(LEVELS) - 1)
    for k in range(len(LEVELS) - 2, -1, -1):
        level = F.when(size >= LEVELS[k][2], k).otherwise(level)
    if key:  # a key of few quotes needs no seeds: each of its texts is searched for each of them
        few = q.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        q = written(q.join(few, key).withColumn("_levels", F.array(level.cast("int"))))
        pool = texts.filter("body IS NOT NULL")
        near = q.filter(F.col("_n") <= FEW)
        direct = pool.select("text_id", norm(F.col("body")).alias("body"), key).join(near.select("quote_id", "quote", key), key).filter(F.contains("body", "quote")).select("text_id", "quote_id").distinct()
        q = q.filter(F.col("_n") > FEW).drop("_n")
        texts = pool.join(q.groupBy(key).agg(F.array_sort(F.collect_set(F.col("_levels")[0])).alias("_levels")), key)
    else:
        direct, q = None, written(q.withColumn("_levels", F.array(level.cast("int"))))
    have = q.select(F.explode("_levels").alias("k")).distinct()
    levels = sorted(r["k"] for r in have.collect())  # six values at most
    if not levels and direct is not None:
        return direct
    wanted = _stretches(q, ["quote_id", *keys], "quote", "_levels")
    asked_levels = F.col("_levels") if key else F.array(*map(F.lit, levels)).cast("array<int>")
    seen = _stretches(texts.filter("body IS NOT NULL").withColumn("body", norm(F.col("body"))).withColumn("_levels", asked_levels), ["text_id", *keys], "body", "_levels") if levels else None
    if seen is None:
        removed(q)
        return texts.select("text_id").limit(0).crossJoin(quotes.select("quote_id").limit(0))
    wanted = written(wanted)
    on = [*keys, "level", "sh"]
    asked = wanted.select(*on).distinct()
    hits = written(seen.join(asked, on, "left_semi"))  # stretches that some quote has
    counts = hits.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    # A quote one of whose kept stretches no text has stands nowhere.
    met = wanted.join(counts, on, "left").groupBy("quote_id", *keys).agg(F.min_by(F.struct("level", "sh"), F.struct("_n", "sh")).alias("_s"), F.min(F.coalesce("_n", F.lit(0))).alias("_least"))
    seeds = met.filter("_least > 0").select("quote_id", *keys, "_s.level", "_s.sh")
    pairs = written(hits.join(seeds, on).select("text_id", "quote_id", *keys).distinct())
    bodies = texts.select("text_id", "body", *keys).filter("body IS NOT NULL").join(pairs.select("text_id", *keys).distinct(), ["text_id", *keys], "left_semi").withColumn("body", norm(F.col("body")))
    both = pairs.join(q.select("quote_id", "quote", *keys), ["quote_id", *keys]).join(bodies, ["text_id", *keys])
    removed(wanted, hits)
    found = both.filter(F.contains("body", "quote")).select("text_id", "quote_id").distinct()
    return found if direct is None else found.unionByName(direct).distinct()


BITS, CHUNK = 1 << 23, 1 << 20  # marks of quotes; how many of them travel together
LONGEST, DEALT = 64, 8  # bytes of a short quote; parts that the texts of one quote are dealt to


def _marks(raw: np.ndarray, left: np.ndarray, sizes: list[int], at: np.ndarray):
    """(size, places, marks) for each size: numbers below BITS for the runs that begin at the places and have so many bytes left."""
    h = np.zeros(len(at), np.uint64)
    for j in range(sizes[-1]):
        go = left[at] > j
        if not go.all():
            at, h = at[go], h[go]
        h = (h ^ (raw[at + j] + np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        if j + 1 in sizes:
            keep = yield j + 1, at, ((h ^ (h >> np.uint64(32))) & np.uint64(BITS - 1)).astype(np.int64)
            if keep is not None:
                at, h = at[keep], h[keep]


def _together(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of a column's values end to end; where each value begins; how many bytes its value has from each place on."""
    values = column.to_pylist()
    size = np.array([len(v) for v in values], np.int64)
    end = np.cumsum(size)
    return np.frombuffer(b"".join(values), np.uint8), end - size, np.repeat(end, size) - np.arange(end[-1] if len(end) else 0)


def _bits(quotes: DataFrame, sizes: list[int], least: int) -> np.ndarray:
    """Marks of all quotes and of their first `least` bytes, as one field of BITS bits: what reaches the driver does not grow with the quotes."""

    def run(batches):
        import pyarrow as pa

        bits = np.zeros(BITS, bool)
        for b in batches:
            if b.num_rows:
                raw, start, left = _together(b.column(0))
                for n, at, mark in _marks(raw, left, sizes, start):
                    bits[mark if n == least else mark[left[at] == n]] = True
        has = [i for i in range(BITS // CHUNK) if bits[i * CHUNK : (i + 1) * CHUNK].any()]
        yield pa.RecordBatch.from_arrays([pa.array(has, pa.int32()), pa.array([np.packbits(bits[i * CHUNK : (i + 1) * CHUNK]).tobytes() for i in has], pa.binary())], ["chunk", "bits"])

    def one(chunk):
        import pyarrow as pa

        return pa.table({"chunk": chunk["chunk"][:1], "bits": pa.array([np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in chunk["bits"].to_pylist()]).tobytes()], pa.binary())})

    bits = np.zeros(BITS // 8, np.uint8)
    for r in quotes.mapInArrow(run, "chunk int, bits binary").groupBy("chunk").applyInArrow(one, "chunk int, bits binary").collect():  # BITS / 8 bytes at most
        bits[r["chunk"] * CHUNK // 8 : (r["chunk"] + 1) * CHUNK // 8] = np.frombuffer(r["bits"], np.uint8)
    return bits


def mentioned(texts: DataFrame, quotes: DataFrame) -> DataFrame:
    """(text_id, quote): texts that contain a quote. texts: text_id, body; quotes: quote; for many short quotes (codes, names).

    A text's runs of the quotes' sizes are joined with the quotes as they are; a field of marks, of one size however many quotes there are, keeps back nearly
    all other runs. Joins are shuffled and a quote's texts dealt to several tasks, so neither quotes nor hits reach the driver. Quotes of more than LONGEST bytes go by seeds."""
    q = quotes.filter("quote != ''").select("quote").distinct()
    size = F.octet_length("quote")
    sizes = sorted(r["n"] for r in q.select(F.least(size, F.lit(LONGEST + 1)).alias("n")).distinct().collect())  # 65 values at most
    longer = contained(texts, q.filter(size > LONGEST).select(F.col("quote").alias("quote_id"), "quote")).select("text_id", F.col("quote_id").alias("quote")) if sizes and sizes[-1] > LONGEST else None
    sizes = [n for n in sizes if n <= LONGEST]
    if not sizes:
        return texts.select("text_id").limit(0).crossJoin(q.limit(0)) if longer is None else longer
    short, least, kind = q.filter(size <= LONGEST), sizes[0], dict(texts.dtypes)["text_id"]
    bits = _bits(short.select(F.col("quote").cast("binary")), sizes, least)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for i in range(0, b.num_rows, 2048):
                part = b.slice(i, 2048)
                raw, start, left = _together(part.column(1))
                rows, found = [], []
                search = _marks(raw, left, sizes, np.arange(len(raw)))
                try:
                    n, at, mark = next(search)
                    while True:
                        hit = (bits[mark >> 3] >> (7 - (mark & 7)).astype(np.uint8)) & 1 == 1
                        whole = raw.tobytes() if not rows else whole
                        rows.append(np.searchsorted(start, at[hit], "right") - 1)
                        found += [whole[x : x + n] for x in at[hit].tolist()]
                        n, at, mark = search.send(hit if n == least else None)  # no quote begins otherwise
                except StopIteration:
                    pass
                if found:
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(np.concatenate(rows))), pa.array(found, pa.binary())], ["text_id", "run"])

    runs = texts.filter("body != ''").select("text_id", F.col("body").cast("binary")).mapInArrow(run, f"text_id {kind}, run binary")
    dealt = runs.withColumn("_d", F.pmod(F.xxhash64("text_id"), F.lit(DEALT)))
    known = short.select("quote", F.col("quote").cast("binary").alias("run"), F.explode(F.array(*(F.lit(i).cast("long") for i in range(DEALT)))).alias("_d"))
    found = dealt.join(known.hint("shuffle_hash"), ["run", "_d"]).select("text_id", "quote").distinct()
    return found if longer is None else found.unionByName(longer)
