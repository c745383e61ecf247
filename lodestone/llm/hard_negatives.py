"""Hard-negative mining by norm-bucketed search.

A row's score is its integer inner product with an anchor. By Cauchy-Schwarz no row of norm r scores above |anchor| * r, so candidates are sorted by
norm, longest first, and cut into buckets: shells between approximate quantiles of the norm over all rows, shells into blocks of bounded size by a
hash of the id (rows of one norm may be a third of the table), and blocks, inside their task, into buckets of 512 rows by falling norm. A search
has windows of admissible scores. A bucket whose length bound lies below a window's lower limit, or below the window's running k-th score, holds
nothing for it; a block of which this holds for all windows of a block of anchors is never sent to a task. Running k-th scores begin in the
first block, of the longest rows, whose results are floors for all other blocks.

Two searches run: the best rows of an anchor's own label are its positives; each distinct positive score p gives one window
ceil(lower * p) ... p, in which the best rows of other labels are its negatives.

Defined cases: rows whose vec_id, label or vector is null, whose vector is empty or holds a null, NaN or infinite component, or whose vector has another
length than the commonest take no part; rows with one vec_id count once (least label, then least vector); an anchor is never its own
positive or negative; a window of a negative positive score is empty (its lower limit is above its upper one); fewer than k rows return all; ties go to
the smaller vec_id; an empty table gives no rows; other columns are ignored. Scores must fit a long.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, discard, pack, parts_for, table, unpack

SCALE, EVERY, POSITIVES, NEGATIVES, LOWER = 256, 100, 5, 5, (4, 5)
BLOCK, ANCHORS, SHELLS, BUCKET = 8192, 512, 32, 512
LEAST, MOST = -(2**63), 2**63 - 1


def usable(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v): whole components of rows that take part, one row per vec_id, all of the commonest length."""
    x = F.col("embedding").cast("array<double>")
    good = rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").filter((F.size(x) > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))))
    v = F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("long"))
    good = good.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min(F.struct(F.col("label").cast("long").alias("label"), v.alias("v"))).alias("r")).select("vec_id", "r.label", "r.v")
    width = good.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").head()
    return good.filter(F.size("v") == (width[0] if width else 0))


def noised(rows: DataFrame) -> DataFrame:
    """Labels as the mining query wants them: where 7 divides vec_id, the next of ten labels."""
    return rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))


def candidate_blocks(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per block of candidates: cb (longest rows first), top (its largest norm), ids, labels and vectors packed by falling norm."""
    norm = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    rows = rows.withColumn("_n", norm)
    shells = min(SHELLS, parts_for(rows.count(), block))
    edges = rows.agg(F.percentile_approx("_n", [i / shells for i in range(1, shells)], 2000)).head()[0] if shells > 1 else []
    edges = sorted(set(edges or []))
    rows = rows.withColumn("_s", F.size(F.filter(F.lit(edges).cast("array<double>"), lambda e: e > F.col("_n"))))
    sizes = {r["_s"]: r["count"] for r in rows.groupBy("_s").count().collect()}  # a row per shell
    parts = [parts_for(sizes.get(s, 0), block) if sizes.get(s) else 0 for s in range(len(edges) + 1)]
    starts = np.concatenate([[0], np.cumsum(parts)[:-1]]).tolist()
    at = lambda xs: F.element_at(F.lit(xs).cast("array<long>"), F.col("_s") + 1)
    rows = rows.withColumn("_b", at(starts) + F.pmod(F.xxhash64("vec_id"), F.greatest(at(parts), F.lit(1))))

    def run(key, pdf):
        import pandas as pd

        v = np.array(pdf["v"].tolist(), np.int64)
        order = np.lexsort((pdf["vec_id"].to_numpy(), -pdf["_n"].to_numpy()))
        ids, labels = pdf["vec_id"].to_numpy()[order], pdf["label"].to_numpy()[order]
        return pd.DataFrame({"cb": [key[0]], "top": [float(np.sqrt(pdf["_n"].max()))], "ids": [pack(ids)], "labels": [pack(labels)], "v": [pack(v[order].ravel())]})

    return rows.groupBy("_b").applyInPandas(run, "cb long, top double, ids binary, labels binary, v binary")


def anchor_blocks(anchors: DataFrame, blocks: int) -> DataFrame:
    """One row per block of anchors: need is the least norm a row must have to enter any of its windows."""

    def run(key, pdf):
        import pandas as pd

        pdf = pdf.sort_values("vec_id")
        v = np.array(pdf["v"].tolist(), np.int64)
        windows = [(i, w["lo"], w["hi"], w["floor"]) for i, ws in enumerate(pdf["windows"]) for w in ws]
        win = np.array(windows, np.int64).reshape(-1, 4)
        norms = np.sqrt((v.astype(np.float64) ** 2).sum(1))[win[:, 0]]
        limit = np.maximum(win[:, 1], win[:, 3])
        with np.errstate(divide="ignore", invalid="ignore"):
            least = np.where(limit <= 0, 0.0, np.where(norms > 0, limit / norms, np.inf))
        return pd.DataFrame({"qb": [key[0]], "need": [float(least.min(initial=np.inf))], "q_ids": [pack(pdf["vec_id"].to_numpy(np.int64))], "q_labels": [pack(pdf["label"].to_numpy(np.int64))], "q_v": [pack(v.ravel())], "win": [pack(win.ravel())]})

    return anchors.withColumn("_b", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("long")).groupBy("_b").applyInPandas(run, "qb long, need double, q_ids binary, q_labels binary, q_v binary, win binary")


def best_in_block(ids, labels, v, q_ids, q_labels, q_v, win, k: int, same: bool, bucket: int = BUCKET):
    """(window, vec_id, score) of each window's best k rows of a block sorted by falling norm; and how many buckets were pruned for how many windows.

    win has rows (anchor, lo, hi, floor); a row counts for it if lo <= score <= hi and its label is the anchor's (same) or another.
    """
    exact = float(np.abs(q_v).max(initial=0)) * float(np.abs(v).max(initial=0)) * v.shape[1] < 2**52
    kind = np.float64 if exact else object
    left, right = v.astype(kind), q_v.astype(kind)
    c_norm, q_norm = (np.sqrt((x.astype(np.float64) ** 2).sum(1)) for x in (v, q_v))
    who, lo, hi, kth = win[:, 0], win[:, 1], win[:, 2], np.maximum(win[:, 1], win[:, 3])
    found = (np.zeros(0, np.int64),) * 3
    pruned = 0
    for a in range(0, len(ids), bucket):
        bound = q_norm[who] * c_norm[a] * (1 + 1e-9) + 1e-6
        live = np.nonzero(bound >= kth.astype(np.float64))[0]
        pruned += len(win) - len(live)
        if not len(live):
            break  # later buckets are shorter still
        part = slice(a, a + bucket)
        used, row = np.unique(who[live], return_inverse=True)
        score = (right[used] @ left[part].T)[row]
        fits = (labels[part][None, :] == q_labels[who[live]][:, None]) == same
        fits &= ids[part][None, :] != q_ids[who[live]][:, None]
        fits &= (score >= kth[live][:, None]) & (score <= hi[live][:, None])
        if score.shape[1] > k and exact:  # only the bucket's own best k can enter, ties included
            own = np.where(fits, score, -np.inf)
            fits &= own >= np.partition(own, -k, axis=1)[:, -k][:, None]
        w, c = np.nonzero(fits)
        found = tuple(np.concatenate([x, y]) for x, y in zip(found, (live[w], ids[part][c], score[w, c].astype(np.int64))))
        found = best_of(*found, k)
        n = np.bincount(found[0], minlength=len(win))
        full = np.nonzero(n >= k)[0]
        kth[full] = np.maximum(kth[full], found[2][np.cumsum(n)[full] - 1])
    return found, pruned


def best_of(window, ids, score, k: int):
    """The best k of each window, in order."""
    order = np.lexsort((ids, -score, window))
    window, ids, score = window[order], ids[order], score[order]
    rank = np.arange(len(window)) - np.searchsorted(window, window, "left")
    return window[rank < k], ids[rank < k], score[rank < k]


def searched(anchors: DataFrame, index: DataFrame, q_blocks: int, k: int, same: bool, first: int, last: int) -> DataFrame:
    """(anchor_id, lo, hi, vec_id, score): each window's best k in each of the blocks first ... last that can hold any."""
    q = cut(anchor_blocks(anchors, q_blocks))
    tops = index.filter(F.col("cb").between(first, last)).select("cb", "top")
    wanted = q.select("qb", "need").withColumn("cb", F.explode(F.sequence(F.lit(first), F.lit(last)))).withColumn("cb", F.col("cb").cast("long"))
    pairs = wanted.join(tops, "cb").filter(F.col("top") * (1 + 1e-9) + 1e-6 >= F.col("need")).select("qb", "cb")
    pairs = pairs.join(q.drop("need"), "qb").join(index.drop("top"), "cb").repartition(max(1, q_blocks * (last - first + 1)), "qb", "cb")

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for r in b.to_pylist():
                long = lambda n: unpack(r[n], np.int64)
                ids, q_ids, win = long("ids"), long("q_ids"), long("win").reshape(-1, 4)
                (w, c, s), _ = best_in_block(ids, long("labels"), long("v").reshape(len(ids), -1), q_ids, long("q_labels"), long("q_v").reshape(len(q_ids), -1), win, k, same)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (q_ids[win[w, 0]], win[w, 1], win[w, 2], c, s)], ["anchor_id", "lo", "hi", "vec_id", "score"])

    found = cut(pairs.select("ids", "labels", "v", "q_ids", "q_labels", "q_v", "win").mapInArrow(run, "anchor_id long, lo long, hi long, vec_id long, score long"))
    discard(q)
    return found


def best(anchors: DataFrame, index: DataFrame, blocks: int, q_blocks: int, k: int, same: bool) -> DataFrame:
    """(anchor_id, lo, hi, rank, vec_id, score): each window's best k of all rows. anchors: vec_id, label, v, windows of (lo, hi)."""
    start = anchors.withColumn("windows", F.transform("windows", lambda w: F.struct(w["lo"].alias("lo"), w["hi"].alias("hi"), F.lit(LEAST).cast("long").alias("floor"))))
    found = searched(start, index, q_blocks, k, same, 0, 0)
    if blocks > 1:
        floors = found.groupBy("anchor_id", "lo", "hi").agg(F.min("score").alias("_f"), F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= k)
        each = anchors.select(F.col("vec_id").alias("anchor_id"), F.explode("windows").alias("w")).select("anchor_id", "w.lo", "w.hi").join(floors, ["anchor_id", "lo", "hi"], "left")
        raised = each.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(F.struct("lo", "hi", F.coalesce("_f", F.lit(LEAST)).cast("long").alias("floor"))).alias("windows"))  # k windows at most
        found = found.union(searched(anchors.drop("windows").join(raised, "vec_id"), index, q_blocks, k, same, 1, blocks - 1))
    rank = F.row_number().over(W.partitionBy("anchor_id", "lo", "hi").orderBy(F.desc("score"), "vec_id")).cast("int")
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def mined(rows: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, lower: tuple[int, int] = LOWER, scale: int = SCALE, block: int = BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for each vector whose id `every` divides.

    rows: vec_id, embedding, label. A negative's score is at least lower[0] / lower[1] of its positive's and at most the positive's.
    """
    good = cut(usable(rows, scale))
    index = cut(candidate_blocks(good, block))
    blocks = index.count()
    anchors = good.filter(F.col("vec_id") % every == 0)
    q_blocks = parts_for(anchors.count(), ANCHORS)
    own = F.array(F.struct(F.lit(LEAST).cast("long").alias("lo"), F.lit(MOST).cast("long").alias("hi")))
    near = cut(best(anchors.withColumn("windows", own), index, blocks, q_blocks, positives, True)).select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    up, down = lower
    low = F.expr(f"(positive_score * {up} + {down - 1}) div {down}")
    span = F.struct(low.alias("lo"), F.col("positive_score").alias("hi"))
    windows = near.filter("positive_score >= 0").groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_set(span).alias("windows"))  # `positives` at most
    far = best(anchors.join(windows, "vec_id"), index, blocks, q_blocks, negatives, False)
    return near.join(far, (near["anchor_id"] == far["anchor_id"]) & (near["positive_score"] == far["hi"])).select(near["anchor_id"], "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mined(noised(table(spark, sf_dir, "embeddings")))


OP11_SQL = """
WITH good AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
  FROM good a JOIN good c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
negatives AS (
  SELECT p.anchor_id, positive_id, s.vec_id AS negative_id, positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
  FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same
   AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 5
"""
