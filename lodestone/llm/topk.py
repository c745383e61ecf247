"""Exact top-k search over an impact-ordered, score-at-a-time index.

Components become integer impacts floor(64 x). A block of candidates keeps postings: per dimension, segments of vectors whose absolute impact
there lies in one level. A query takes the segments in the order of |query component| x largest impact of the segment, highest first, and adds
their contributions to accumulators. After each round every unread contribution is at most that of the next segment, so a vector with u unread
dimensions lies within u times that bound of its accumulator. Vectors whose upper bound is below the k-th best lower bound are out for certain;
once rescoring the others exactly costs less than reading on, they are rescored and the query stops. A query that
never gets such a proof reads every segment, and its accumulators are the exact scores.

Queries and candidates meet in blocks (both sides replicated per block of the other, never row by row). All queries search the first
block before the others: the k-th score found there is a floor that each other block starts from, so it proves sooner and returns only what reaches
the floor, and blocks whose largest norm cannot reach it are skipped. A window keeps the best k.

Defined cases: vectors that are null or hold a null, NaN or infinite component take no part; vectors of another
length than the commonest take no part either; rows with one vec_id count once (the smallest vector);
a null vec_id takes no part; fewer than k candidates return all; an empty table gives no rows; ties go to the smaller vec_id.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, discard, pack, parts_for, table, unpack

K, EVERY, SCALE, BLOCK, LEVELS = 20, 20, 64, 16384, 16
ROUNDS = np.array([2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16]) / 16  # shares of all postings after which a query looks for a proof
NO_FLOOR, UNIT = -(2**63), 2.0**40


def impacts(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): integer impacts of usable vectors, one row per vec_id."""
    x = F.col("embedding").cast("array<double>")
    good = vectors.filter(F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0)).filter(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))))
    return good.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("long")).alias("v"))


class ImpactIndex:
    """Posting segments of one block of candidates; `read` counts the postings read and vectors rescored (in components), `total` those of a full product."""

    def __init__(self, ids: np.ndarray, v: np.ndarray, levels: int = LEVELS):
        order = np.argsort(ids)
        self.ids, self.v = ids[order], v[order]
        n, width = self.v.shape
        size = np.abs(self.v)
        edges = np.unique(np.quantile(size, np.linspace(0, 1, levels + 1))[1:-1]) if size.size else np.zeros(0)
        kinds = len(edges) + 1
        key = np.arange(width)[None, :] * kinds + (kinds - 1 - np.searchsorted(edges, size, "left"))  # highest level first within a dimension
        place = np.argsort(key, axis=None, kind="stable")
        flat = key.ravel()[place]
        heads = np.nonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))[0]
        self.who, self.impact = (place // width).astype(np.int64), self.v.ravel()[place].astype(np.float64)
        self.sizes = np.diff(np.append(heads, len(flat)))
        self.dims = flat[heads] // kinds
        self.most = np.maximum.reduceat(np.abs(self.impact), heads)
        self.norm = float(np.sqrt((self.v.astype(np.float64) ** 2).sum(1).max(initial=0)))
        self.read = self.total = 0

    def one(self, own: int, q: np.ndarray, k: int, floor: float, exact: bool) -> np.ndarray:
        """Rows that may be among the best k and are not below floor; `own` (or -1) is no candidate."""
        n, width = self.v.shape
        x = q.astype(np.float64)
        bound = np.abs(x)[self.dims] * self.most
        order = np.argsort(-bound, kind="stable")
        upto = np.cumsum(self.sizes[order])
        stops = np.minimum(np.searchsorted(upto, ROUNDS * upto[-1], "left") + 1, len(order))
        # Within a dimension segments are read from its highest level down, so what is read of it is always one run of postings.
        done = np.arange(width) * n
        both = exact and width < 4096 and float(np.abs(x).sum()) * self.most.max() < 2**39
        acc, unread, at = np.zeros(n), np.full(n, float(width)), 0
        for stop in stops:
            if stop <= at:
                continue
            upper = done + np.bincount(self.dims[order[at:stop]], self.sizes[order[at:stop]], width).astype(np.int64)
            at = int(stop)
            spans = [slice(a, b) for a, b in zip(done.tolist(), upper.tolist()) if a < b]
            weights = np.repeat(x, upper - done)
            done = upper
            who = np.concatenate([self.who[s] for s in spans])
            weights *= np.concatenate([self.impact[s] for s in spans])
            if both:  # whole numbers: one sum holds the count in its high bits
                weights += UNIT
                found = np.bincount(who, weights, n)
                count = np.rint(found / UNIT)
                acc += found - count * UNIT
                unread -= count
            else:
                acc += np.bincount(who, weights, n)
                unread -= np.bincount(who, minlength=n)
            rest = bound[order[at]] if at < len(order) else 0.0
            left = int(upto[-1] - upto[at - 1])
            if left and rest * unread.mean() > 1.5 * acc.std():
                continue  # too early for any proof
            slack = unread * rest + (0.0 if exact else np.abs(acc) * 1e-12 + np.abs(x).sum() * self.most.max() * 1e-12)
            kth = floor
            if floor == -np.inf and n > k:
                low = acc - slack
                if own >= 0:
                    low[own] = -np.inf
                kth = np.partition(low, n - k)[n - k]
            may = acc + slack >= kth
            if own >= 0:
                may[own] = False
            if not left or int(may.sum()) * width <= left // 2:
                self.read += int(upto[at - 1]) + int(may.sum()) * width
                return np.nonzero(may)[0]
        return np.zeros(0, np.int64)

    def search(self, ids: np.ndarray, q: np.ndarray, k: int = K, floors: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Columns query, vector, score of the best k for each query that reach its floor; its own id is no candidate."""
        n, width = self.v.shape
        floors = np.full(len(q), NO_FLOOR) if floors is None else floors
        where = np.searchsorted(self.ids, ids)
        has = (where < n) & (self.ids[np.minimum(where, n - 1)] == ids)
        exact = float(np.abs(q).max(initial=0)) * float(np.abs(self.v).max(initial=0)) * width < 2**52
        norms, out = np.sqrt((q.astype(np.float64) ** 2).sum(1)), []
        for r in range(len(q)):
            self.total += n * width
            floor = -np.inf if floors[r] == NO_FLOOR else float(floors[r])
            if norms[r] * self.norm * (1 + 1e-9) + 1e-6 < floor:
                continue
            c = self.one(int(where[r]) if has[r] else -1, q[r], k, floor, exact)
            score = self.v[c] @ q[r] if exact else np.array([sum(int(a) * int(b) for a, b in zip(row, q[r])) for row in self.v[c]], object)
            best = np.lexsort((self.ids[c], -score))[:k] if exact else np.array(sorted(range(len(c)), key=lambda i: (-score[i], self.ids[c][i]))[:k], np.int64)
            out.append((np.full(len(best), ids[r]), self.ids[c][best], score[best]))
        return tuple(np.concatenate([o[i] for o in out]).astype(np.int64) if out else np.zeros(0, np.int64) for i in range(3))


def blobs(rows: DataFrame, blocks: int, name: str) -> DataFrame:
    """One row per block: ids, impacts and floors as packed columns; rows of one id count once."""

    def run(key, pdf):
        import pandas as pd

        v = sorted({(i, tuple(x), f) for i, x, f in zip(pdf["vec_id"], pdf["v"], pdf["floor"])})
        v = [x for j, x in enumerate(v) if j == 0 or v[j - 1][0] != x[0]]
        return pd.DataFrame({name: [key[0]], "ids": [pack(np.array([i for i, *_ in v], np.int64))], "v": [pack(np.array([x for _, x, _ in v], np.int64).ravel())], "floors": [pack(np.array([f for *_, f in v], np.int64))]})

    return rows.withColumn("_b", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))).groupBy("_b").applyInPandas(run, f"{name} long, ids binary, v binary, floors binary")


def searched(queries: DataFrame, index: DataFrame, q_blocks: int, c_blocks: int, first: int, last: int, k: int) -> DataFrame:
    """(query_id, vec_id, score): the queries' best k in each of the candidate blocks first ... last."""
    q = blobs(queries, q_blocks, "qb").withColumn("cb", F.explode(F.sequence(F.lit(first), F.lit(last)))).select("qb", F.col("cb").cast("long").alias("cb"), F.col("ids").alias("q_ids"), F.col("v").alias("q_v"), "floors")
    c = index.filter(F.col("cb").between(first, last)).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)))).select("cb", F.col("qb").cast("long").alias("qb"), "ids", "v")
    pairs = q.join(c, ["qb", "cb"]).repartition(q_blocks * (last - first + 1), "qb", "cb")

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for r in b.to_pylist():
                ids, q_ids = unpack(r["ids"], np.int64), unpack(r["q_ids"], np.int64)
                if not len(ids) or not len(q_ids):
                    continue
                found = ImpactIndex(ids, unpack(r["v"], np.int64).reshape(len(ids), -1)).search(q_ids, unpack(r["q_v"], np.int64).reshape(len(q_ids), -1), k, unpack(r["floors"], np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["query_id", "vec_id", "score"])

    return cut(pairs.select("ids", "v", "q_ids", "q_v", "floors").mapInArrow(run, "query_id long, vec_id long, score long"))


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the best k of all other vectors for each vector whose id `every` divides."""
    usable = impacts(vectors, scale)
    width = usable.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").head()
    usable = usable.filter(F.size("v") == (width[0] if width else 0)).withColumn("floor", F.lit(NO_FLOOR).cast("long"))
    total = usable.count()
    c_blocks = parts_for(total, block)
    q_blocks = parts_for(total / every, max(1, block // 16))
    index = cut(blobs(usable, c_blocks, "cb"))
    queries = usable.filter(F.col("vec_id") % every == 0)
    found = searched(queries, index, q_blocks, c_blocks, 0, 0, k)
    if c_blocks > 1:
        floors = found.groupBy(F.col("query_id").alias("vec_id")).agg(F.min("score").alias("_least"), F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= k)
        raised = queries.join(floors, "vec_id", "left").select("vec_id", "v", F.coalesce("_least", "floor").alias("floor"))
        found = found.union(searched(raised, index, q_blocks, c_blocks, 1, c_blocks - 1, k))
    discard(index)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).cast("int")
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


OP4_SQL = """
WITH good AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM good q JOIN good c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
