"""Exact inner-product search as a blocked product.

Searches become blocks of vectors in a written table, chunks blocks of vectors in the order they are scanned. Pairs of blocks meet by a join
on block numbers: while the searches' vectors are few bytes (counted first) they are broadcast and no chunk moves; beyond that both sides are dealt over a
grid of block numbers, each replicated once per block of the other. A task multiplies one pair at a time and keeps the best n per search.

A product in blocks adds in an order of its own, so it only picks candidates, with a margin above its rounding error; each candidate's score
is then added up component by component, which makes scores and ties the same wherever a row lies.

Defined cases: null vectors, vectors of another length than the searches' and scores that are not finite take no part; ties go to the larger
chunk_id; a null allow sees every group, an empty one none; a null group is seen by searches without allow only.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.operators.shared import written

ROWS, SEARCHES, SMALL_BYTES = 4096, 512, 64 << 20
MARGIN = 1e-12


def search_blocks(queries: DataFrame, blocks: int) -> DataFrame:
    """(qb, names, q, groups, allow, free), written: groups are all that a search of the block may see, allow a bit per search and group, free marks searches without a filter."""
    name = dict(queries.dtypes)["search"]

    def run(key, pdf):
        import pandas as pd

        groups = sorted({int(g) for a in pdf["allow"] if a is not None for g in a})
        place = {g: i for i, g in enumerate(groups)}
        bits = np.zeros((len(pdf), max(1, len(groups))), bool)
        for i, a in enumerate(pdf["allow"]):
            if a is not None and len(a):
                bits[i, [place[int(g)] for g in a]] = True
        q = np.array(pdf["q"].tolist(), np.float64)
        return pd.DataFrame({"qb": [key[0]], "names": [pdf["search"].tolist()], "q": [q.tobytes()], "groups": [groups], "allow": [np.packbits(bits, axis=1).tobytes()], "free": [[a is None for a in pdf["allow"]]]})

    dealt = queries.withColumn("_b", F.pmod(F.xxhash64("search"), F.lit(blocks)).cast("int"))
    return written(dealt.groupBy("_b").applyInPandas(run, f"qb int, names array<{name}>, q binary, groups array<long>, allow binary, free array<boolean>"))


def chunk_blocks(chunks: DataFrame, width: int, cells: int) -> DataFrame:
    """(cb, ids, g, v): up to ROWS chunks as they are scanned; cb spreads the blocks over `cells` rows of the grid."""
    kind = dict(chunks.dtypes)["chunk_id"]

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for start in range(0, b.num_rows, ROWS):
                part = b.slice(start, ROWS)
                flat = np.asarray(part.column(1).flatten(), np.float64)
                ids = part.column(0)
                cb = zlib.crc32(str(ids[0]).encode()) % cells
                yield pa.RecordBatch.from_arrays([pa.array([cb], pa.int32()), pa.array([ids.to_pylist()], pa.list_(ids.type)), pa.array([part.column(2).to_pylist()], pa.list_(pa.int64())), pa.array([flat.tobytes()], pa.binary())], ["cb", "ids", "g", "v"])

    usable = chunks.filter(F.col("v").isNotNull() & (F.size("v") == width)).select("chunk_id", F.col("v").cast("array<double>").alias("v"), F.col("g").cast("long").alias("g"))
    return usable.mapInArrow(run, f"cb int, ids array<{kind}>, g array<long>, v binary")


def fused_sums(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products added component by component with one rounding a step (fused multiply-add), as DuckDB is compiled to do; few rows only."""
    asked, out = q.tolist(), np.empty(len(v))
    for i, row in enumerate(v.tolist()):
        total = 0.0
        for a, b in zip(row, asked):
            total = math.fma(a, b, total)
        out[i] = total
    return out


def best_of_pair(ids: np.ndarray, group: np.ndarray, blank: np.ndarray, v: np.ndarray, q: np.ndarray, groups: np.ndarray, allow: np.ndarray, free: np.ndarray, n: int, fused: bool = False):
    """For each search of a block: its number, the rows of its best n and their scores. allow: bits of (search, group)."""
    order = np.argsort(ids, kind="stable")[::-1]  # the larger id first among equal scores
    group, blank, v = group[order], blank[order], v[order]
    with np.errstate(invalid="ignore", over="ignore"):
        score = q @ v.T
        slack = MARGIN * np.sqrt((q * q).sum(1)) * np.sqrt((v * v).sum(1).max(initial=0))
        seen = np.isfinite(score)
        if not free.all():
            at = np.searchsorted(groups, group)
            at = np.minimum(at, max(0, len(groups) - 1))
            known = (groups[at] == group) & ~blank if len(groups) else np.zeros(len(group), bool)
            seen &= free[:, None] | (allow[:, at] & known[None, :])
        score = np.where(seen, score, -np.inf)
        if score.shape[1] > n:
            kth = np.partition(score, score.shape[1] - n, axis=1)[:, score.shape[1] - n]
            seen &= score >= (kth - 2 * slack)[:, None]
    for s in range(len(q)):
        rows = np.nonzero(seen[s])[0]
        if len(rows):
            exact = fused_sums(v[rows], q[s]) if fused else np.add.accumulate(v[rows] * q[s], axis=1)[:, -1]
            best = np.argsort(-exact, kind="stable")[:n]
            yield s, order[rows[best]], exact[best]


def dense_top(chunks: DataFrame, queries: DataFrame, n: int, small: int = SMALL_BYTES, rows: int = ROWS, searches: int = SEARCHES, fused: bool = False) -> DataFrame:
    """(search, chunk_id, score, rank): the best n chunks of each search by inner product; `fused` says how a score is added up, which decides near-ties.

    chunks: chunk_id, v (numbers), g (group of filters, a whole number); queries: search, q, and optionally allow (the groups a search may see)."""
    asked = queries if "allow" in queries.columns else queries.withColumn("allow", F.lit(None).cast("array<long>"))
    asked = asked.filter("q IS NOT NULL").select("search", F.col("q").cast("array<double>").alias("q"), F.col("allow").cast("array<long>").alias("allow"))
    total, width = asked.agg(F.count(F.lit(1)), F.max(F.size("q"))).head()
    asked = asked.filter(F.size("q") == (width or 0))
    blocks = max(1, -(-total // searches))
    q = search_blocks(asked, blocks)
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    if total * (width or 0) * 8 <= small:
        met = chunk_blocks(chunks, width or 0, 1).withColumn("qb", every).join(F.broadcast(q), "qb")
    else:
        cells = max(1, -(-chunks.count() // (16 * rows)))
        c = chunk_blocks(chunks, width, cells).withColumn("qb", every)
        met = c.join(q.withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(cells - 1)))), ["qb", "cb"])
    name, kind = dict(asked.dtypes)["search"], dict(chunks.dtypes)["chunk_id"]

    def run(batches):
        import pyarrow as pa

        for b in batches:
            names_type, ids_type = b.schema.field("names").type.value_type, b.schema.field("ids").type.value_type
            for r in b.to_pylist():
                ids, names, blank = np.array(r["ids"]), r["names"], np.array([g is None for g in r["g"]])
                group = np.array([g or 0 for g in r["g"]], np.int64)
                allow = np.unpackbits(np.frombuffer(r["allow"], np.uint8).reshape(len(names), -1), axis=1).astype(bool)
                v, q_v = np.frombuffer(r["v"]).reshape(len(ids), -1), np.frombuffer(r["q"]).reshape(len(names), -1)
                for s, at, score in best_of_pair(ids, group, blank, v, q_v, np.array(r["groups"], np.int64), allow, np.array(r["free"], bool), n, fused):
                    yield pa.RecordBatch.from_arrays([pa.array([names[s]] * len(at), names_type), pa.array(ids[at].tolist(), ids_type), pa.array(score)], ["search", "chunk_id", "score"])

    found = met.select("ids", "g", "v", "names", "q", "groups", "allow", "free").mapInArrow(run, f"search {name}, chunk_id {kind}, score double")
    w = W.partitionBy("search").orderBy(F.desc("score"), F.desc("chunk_id"))
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
