"""MinHash near-dedup with HyperMinHash registers.

A document's set is its distinct 5-word shingles as 64-bit hashes. Hashes fall in 128 buckets; a register keeps
the least hash of its bucket compressed to a leading-zero count and 10 mantissa bits. Four registers make a band,
32 bands make candidates (at Jaccard 0.85 all bands differ once in 10^10 pairs; sets that touch few buckets
share all bands but those with a differing shingle). Candidates pass a collision-corrected estimate with five standard errors to spare and are then
confirmed on full sets rebuilt from the whole texts.

Equal sets collapse to one representative first. A band bucket is never expanded into pairs: members are tried
against the bucket's smallest id; buckets that still hold several components are compared in tiles, first each
member with its best partner per foreign component, and at last every plausible pair
between different components, so no link that joins components is lost. Parity bitmaps bound from below how much two sets
differ, so most pairs of a large family that stays below the threshold are ruled out for certain within the tile.

Defined cases: null, empty or wordless text has an empty set, n_shingles 0, its own component; fewer than five words make
one shingle of the whole sequence; rows repeated with one doc_id are equal documents; a null doc_id links with nothing and is
returned with a null component and kept true; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WordIds, as_long, chunks, cut, discard, mix, parts_for, release, sized_join, skew_join, table

WORDS, BUCKETS, MANTISSA, PERCENT = 5, 128, 10, 85
EMPTY = np.uint16(0xFFFF)
TILE, ODD_BITS, WORDS_KEPT = 512, 1024, 200_000
STEP = np.uint64(0x9E3779B97F4A7C15)  # sets the bands apart


def shingle_sets(texts: list[bytes | None], words: WordIds, k: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words.trim()
    split = [t.lower().split() if t else [] for t in texts]
    ids = words.ids([w for s in split for w in s])
    own = words.table()[ids] if len(ids) else np.zeros(0, np.uint64)
    if len(own) >= k:
        acc = own[: len(own) - k + 1] * np.uint64(0x9E3779B97F4A7C15)
        for j in range(1, k):
            acc = mix(acc) + own[j : len(own) - k + 1 + j] * np.uint64(0x9E3779B97F4A7C15 + 2 * j)
        acc = mix(acc)
    out, at = [], 0
    for s in split:
        n = len(s)
        if n >= k:
            out.append(np.unique(acc[at : at + n - k + 1]))
        elif n:
            x = np.array([n], np.uint64)
            for w in own[at : at + n]:
                x = mix(x * np.uint64(31) + w)
            out.append(x)
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def registers(sets: list[np.ndarray], buckets: int = BUCKETS, mantissa: int = MANTISSA) -> np.ndarray:
    """HyperMinHash registers, one row per set; EMPTY marks a bucket without elements."""
    bits = buckets.bit_length() - 1
    lens = np.fromiter(map(len, sets), np.int64, len(sets))
    out = np.full(len(sets) * buckets, EMPTY, np.uint16)
    if lens.sum():
        flat = np.concatenate(sets)
        place = np.repeat(np.arange(len(sets)), lens) * buckets + (flat >> np.uint64(64 - bits)).astype(np.int64)
        first = np.concatenate([[True], place[1:] != place[:-1]])  # sets are sorted: the first of a bucket is its least
        rest = flat[first] & np.uint64((1 << (64 - bits)) - 1)
        part, power = np.frexp(np.maximum(rest, 1).astype(np.float64))
        zeros = np.clip(64 - bits - power, 0, 62)
        out[place[first]] = (zeros << mantissa) | np.minimum(((part - 0.5) * (2 << mantissa)).astype(np.int64), (1 << mantissa) - 1)
    return out.reshape(len(sets), buckets)


def odd_sketches(sets: list[np.ndarray], bits: int = ODD_BITS) -> np.ndarray:
    """Parity bitmaps: bits in which two sketches differ are at most the elements in which the sets differ."""
    lens = np.fromiter(map(len, sets), np.int64, len(sets))
    flat = mix(np.concatenate(sets) ^ np.uint64(0xA5A5A5A5)) % np.uint64(bits) if lens.sum() else np.zeros(0, np.uint64)
    odd = np.bincount(np.repeat(np.arange(len(sets)), lens) * bits + flat.astype(np.int64), minlength=len(sets) * bits) & 1
    return np.packbits(odd.astype(np.uint8).reshape(len(sets), bits), axis=1)


def estimate(a: np.ndarray, b: np.ndarray, mantissa: int = MANTISSA) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of rows of a with rows of b, corrected for registers that agree by chance, and the buckets in use."""
    both = (a != EMPTY) | (b != EMPTY)
    used = both.sum(1)
    same = (both & (a == b)).sum(1)
    # Two unrelated minima agree where the leading zeros agree (about 1/3) and the mantissa does.
    chance = 1 / 3 / (1 << mantissa)
    return (same - used * chance) / np.maximum(used * (1 - chance), 1), used


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, f1, f2, sig): f1 and f2 fingerprint the set."""

    def run(batches):
        import pyarrow as pa

        words = WordIds(bound=WORDS_KEPT)
        for ids, texts in chunks(batches, ["doc_id", "text"], 4 << 20):
            sets = shingle_sets(texts, words)
            sig = registers(sets)
            lens = np.fromiter(map(len, sets), np.int64, len(sets))
            f1 = np.array([int(mix(s).sum()) & (2**64 - 1) for s in sets], np.uint64)
            f2 = np.array([int(mix(s + np.uint64(0x5851F42D4C957F2D)).sum()) & (2**64 - 1) for s in sets], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lens), pa.array(as_long(f1)), pa.array(as_long(f2)), pa.array([r.tobytes() + o.tobytes() for r, o in zip(sig, odd_sketches(sets))], pa.binary())], ["doc_id", "n_shingles", "f1", "f2", "sig"])
        del words
        release()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_shingles long, f1 long, f2 long, sig binary")


def _columns(sigs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Registers, band keys (four registers as one number) and parity words of signatures."""
    raw = np.frombuffer(b"".join(sigs), np.uint8).reshape(len(sigs), -1)
    head = np.ascontiguousarray(raw[:, : 2 * BUCKETS])
    return head.view(np.uint16), head.view(np.uint64), np.ascontiguousarray(raw[:, 2 * BUCKETS :]).view(np.uint64)


def band_rows(reps: DataFrame) -> DataFrame:
    """(band, rep): one row for each band of registers that are not all empty."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            if not b.num_rows:
                continue
            keys = _columns(b.column(1).to_pylist())[1]
            full = keys != np.uint64(2**64 - 1)
            keys = mix(keys + np.arange(keys.shape[1], dtype=np.uint64) * STEP)
            at = np.nonzero(full)
            yield pa.RecordBatch.from_arrays([pa.array(as_long(keys[at])), b.column(0).take(pa.array(at[0]))], ["band", "rep"])

    return reps.select("rep", "sig").mapInArrow(run, "band long, rep long")


def confirmed(pairs: DataFrame, docs: DataFrame, percent: int = PERCENT, most: int = 256) -> DataFrame:
    """Pairs (a, b) whose full sets satisfy 100 * intersection >= percent * union.

    `a` may be in very many pairs: those few that are in more than `most` are dealt over salts, and their number, at most pairs / most,
    is joined by a broadcast once a count proves it small, so no task gets all pairs of one document."""
    pairs = cut(pairs.select("a", "b").distinct())
    n = pairs.count()
    bound = 2_000_000
    ids = cut(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    needed = cut(sized_join(texts, ids, ["doc_id"], "left_semi", bound).groupBy("doc_id").agg(F.min("text").alias("text")))
    hot = cut(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("_c")).filter(F.col("_c") > most).select("a", F.ceil(F.col("_c") / most).alias("_salts")))
    groups = parts_for(n, most)
    g = lambda s: F.pmod(F.xxhash64("a", s), F.lit(groups))
    salts = F.coalesce("_salts", F.lit(1).cast("long"))
    leads = sized_join(pairs.select("a").distinct(), hot, ["a"], "left")
    left = needed.withColumnRenamed("doc_id", "a").join(leads, "a").select("a", "text", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("_s")).select(g("_s").alias("g"), F.col("a").alias("a"), F.col("text").alias("text")).distinct()
    dealt = sized_join(pairs, hot, ["a"], "left").select("a", "b", F.pmod(F.xxhash64("b"), salts).alias("_s"))
    right = dealt.join(needed.withColumnRenamed("doc_id", "b"), "b").select(g("_s").alias("g"), F.col("a").alias("a"), F.col("b").alias("b"), F.col("text").alias("text"))

    def run(_, lead, member):
        import pandas as pd

        words = WordIds(bound=WORDS_KEPT)
        sets = dict(zip(lead["a"], shingle_sets([t.encode() for t in lead["text"]], words)))
        own = shingle_sets([t.encode() for t in member["text"]], words)
        keep = []
        for a, s in zip(member["a"], own):
            both = len(np.intersect1d(sets[a], s, assume_unique=True))
            keep.append(100 * both >= percent * (len(sets[a]) + len(s) - both))
        return pd.DataFrame({"a": member["a"], "b": member["b"]})[np.array(keep, bool)]

    out = cut(left.groupBy("g").cogroup(right.groupBy("g")).applyInPandas(run, "a long, b long"))
    discard(pairs, ids, needed, hot)
    return out


def components(edges: DataFrame) -> DataFrame:
    """(id, comp): the smallest id reachable over edges (a, b), by label propagation with shortcuts, one shared-folder table a round. Stars and large components are hot keys of both joins."""
    both = cut(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = cut(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("id"), F.least("a", "b").alias("comp")))
    hot = cut(both.groupBy("b").count().filter("count > 4096").select("b"))  # the edges stay the same, so their hot keys do
    while True:
        near = skew_join(both, labels.select(F.col("id").alias("b"), "comp"), ["b"], "inner", hot=hot).groupBy(F.col("a").alias("id")).agg(F.min("comp").alias("_near"))
        jump = skew_join(labels.select("id", "comp"), labels.select(F.col("id").alias("comp"), F.col("comp").alias("_further")), ["comp"], "left")
        new = cut(jump.join(near, "id").select("id", F.least("comp", "_near", F.coalesce("_further", "comp")).alias("comp"), F.col("comp").alias("_old")))
        if new.filter("comp != _old").isEmpty():
            discard(labels, both, hot)
            return new.select("id", "comp")
        discard(labels)
        labels = new


def labelled(reps: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    comp = components(links)
    return comp, cut(reps.join(comp.withColumnRenamed("id", "rep"), "rep", "left").select("rep", "n", "sig", F.coalesce("comp", "rep").alias("comp")))


def plausible(bands: DataFrame, reps: DataFrame, percent: int, best: bool) -> DataFrame:
    """Pairs (a, b) of different components that share a band and may reach the threshold; best: a member's best partner per foreign component of a tile only."""
    light = bands.join(reps.select("rep", "comp"), "rep")
    mixed = light.groupBy("band").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi"), F.ceil(F.count(F.lit(1)) / TILE).alias("_t")).filter("_lo != _hi").select("band", "_t")
    tiled = bands.join(mixed, "band").select("band", "rep", "_t", F.pmod(F.xxhash64("rep"), "_t").alias("_i"))
    tiles = tiled.select("band", "rep", F.explode(F.expr("transform(sequence(0L, _t - 1), j -> struct(least(_i, j) AS x, greatest(_i, j) AS y, _i <= j AS first, _i >= j AS second))")).alias("_p")).join(reps, "rep")
    groups = parts_for(tiles.count(), 2 * TILE)
    keyed = tiles.select(F.pmod(F.xxhash64("band", "_p.x", "_p.y"), F.lit(groups)).alias("g"), "band", F.col("_p.x").alias("x"), F.col("_p.y").alias("y"), F.col("_p.first").alias("first"), F.col("_p.second").alias("second"), "rep", "n", "comp", "sig")

    def run(pdf):
        import pandas as pd

        found = [np.zeros((0, 2), np.int64)]
        registers_, keys, parity = _columns(list(pdf["sig"]))
        cols = {c: pdf[c].to_numpy() for c in ("band", "rep", "n", "comp", "first", "second")}
        t = percent / 100
        steps = np.arange(keys.shape[1], dtype=np.uint64) * STEP
        for at in pdf.groupby(["band", "x", "y"]).indices.values():
            one, two = at[cols["first"][at]], at[cols["second"][at]]
            if not len(one) or not len(two):
                continue
            bucket = np.nonzero(as_long(mix(keys[at[0]] + steps)) == cols["band"][at[0]])[0][0]
            n, m = cols["n"][one][:, None], cols["n"][two][None, :]
            ok = (cols["comp"][one][:, None] != cols["comp"][two][None, :]) & (100 * np.minimum(m, n) >= percent * np.maximum(m, n))
            if len(one) == len(two) and (one == two).all():
                ok &= cols["rep"][one][:, None] < cols["rep"][two][None, :]
            x, y = np.nonzero(ok)
            x, y = one[x], two[y]
            # Sets of Jaccard t differ in at most (1 - t) / (1 + t) of their sizes, and so do parity words.
            most = (cols["n"][x] + cols["n"][y]) * ((1 - t) / (1 + t)) + 1e-6
            differ = np.zeros(len(x), np.int64)
            for w in range(parity.shape[1]):
                differ += np.bitwise_count(parity[x, w] ^ parity[y, w])
                if w % 4 == 3:
                    stay = differ <= most
                    x, y, most, differ = x[stay], y[stay], most[stay], differ[stay]
            # A pair is looked at in the first band it shares only.
            for w in range(bucket):
                stay = (keys[x, w] != keys[y, w]) | (keys[x, w] == np.uint64(2**64 - 1))
                x, y = x[stay], y[stay]
            j, used = estimate(registers_[x], registers_[y])
            stay = j >= t - 5 * np.sqrt(t * (1 - t) / np.maximum(used, 1))
            x, y, j = x[stay], y[stay], j[stay]
            a, b = cols["rep"][x], cols["rep"][y]
            if best and len(x):
                far = cols["comp"][y]
                order = np.lexsort((-j, far, a))
                head = np.concatenate([[True], (a[order][1:] != a[order][:-1]) | (far[order][1:] != far[order][:-1])])
                a, b = a[order][head], b[order][head]
            found.append(np.stack([np.minimum(a, b), np.maximum(a, b)], 1))
        ab = np.unique(np.concatenate(found), axis=0)
        return pd.DataFrame({"a": ab[:, 0], "b": ab[:, 1]})

    return keyed.groupBy("g").applyInPandas(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id, kept."""
    found = cut(features(docs))
    some = found.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    reps = cut(some.groupBy("f1", "f2", "n_shingles").agg(F.min("doc_id").alias("rep"), F.min("sig").alias("sig")))
    plain = reps.select("rep", F.col("n_shingles").alias("n"), "sig")
    bands = band_rows(plain)
    several = bands.groupBy("band").agg(F.min("rep").alias("lead"), F.count(F.lit(1)).alias("c")).filter("c > 1").select("band", "lead")
    bands = cut(bands.join(several, "band"))  # only buckets of two and more go on
    stars = bands.filter("rep != lead").groupBy("rep", "lead").count().groupBy("rep").agg(F.max_by("lead", F.struct("count", -F.col("lead"))).alias("lead"))
    tried = cut(stars.select(F.col("lead").alias("a"), F.col("rep").alias("b")))
    links = confirmed(tried, docs, percent)
    bands = bands.select("band", "rep")
    comp, marked = labelled(plain, links)
    for best in (True, False):  # the second round tries every plausible pair between components, whatever the first one found
        more = cut(plausible(bands, marked, percent, best).join(tried, ["a", "b"], "left_anti"))
        if more.isEmpty():
            continue
        fresh = confirmed(more, docs, percent)
        if not fresh.isEmpty():
            links = cut(links.union(fresh))
            discard(marked)
            comp, marked = labelled(plain, links)
        tried = cut(tried.union(more))
    whole = reps.select("f1", "f2", "n_shingles", "rep").join(comp.withColumnRenamed("id", "rep"), "rep", "left").select("f1", "f2", F.col("n_shingles").alias("_n"), F.coalesce("comp", "rep").alias("comp"))
    joined = found.join(whole, (found.f1 == whole.f1) & (found.f2 == whole.f2) & (found.n_shingles == whole._n) & found.doc_id.isNotNull(), "left")
    out = joined.select("doc_id", "n_shingles", F.coalesce("comp", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def representatives(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents kept: the smallest doc_id of every component. Rows repeated with one doc_id and text stay once, those with other texts stay too; null doc_ids stay."""
    h = F.xxhash64("text")
    kept = near_duplicates(docs, percent).filter("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_kept")).distinct()
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col("doc_id").cast("long").alias("_d"), h.alias("_t"))
    one = named.filter("_d IS NOT NULL").dropDuplicates(["_d", "_t"]).join(kept, F.col("_d") == F.col("_kept"), "left_semi")
    return named.filter("_d IS NULL").unionByName(one).select("_doc.*")


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
