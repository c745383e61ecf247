"""Mixing sources to target weights: Sainte-Lague apportionment of equal-token blocks, then seeded block selection.

Native DataFrame expressions only. Targets are the closed form of capped proportional sharing. The seats of the
highest quotients weight / (2 s + 1) are found without a seat-by-seat loop: a divisor puts every count within
n/2S of its quota, so only the few quotients around it are ranked. Each source's seats are shared by the same rule over its
bundles of up to `bundle` shards, and each bundle's over its shards (seeded hash buckets of about `shard_docs` documents), so no window
holds all documents or all shards of a source; a source of one bundle gets what a single sharing gives.
Within a shard, documents lie in seeded order on a line of blocks; every block is taken quota // blocks times and a
seeded run of the rest once more, so at most two documents of a shard are cut.

Defined cases: null or wordless text has size 0 and is never taken; a null source is a source of its own, last in
order; rows repeated in full share one place in the order; an empty table gives no rows; extra columns stay untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import SPACE, cut, sized_join, table

WEIGHTS, SHARE, CAP, BLOCK, SHARD_DOCS, BUNDLE, SEED = (3, 1, 2), 1.5, 2, 32, 256, 4096, 7


def word_count(text) -> F.Column:
    """Number of words; null gives 0."""
    return F.coalesce(F.size(F.filter(F.split(text, SPACE), lambda w: w != "")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, n_docs, source_size, target) from rows of (source, n_docs, source_size): one row per source."""
    every, order = W.partitionBy(), W.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")).cast("double")
    df = sizes.withColumn("weight", w).withColumn("cap", F.lit(float(cap)) * F.col("source_size")).withColumn("all", F.sum("source_size").over(every) * F.lit(float(share)))
    # Sources reach their cap in the order of cap / weight: with the k first at their caps, the rest share what is left.
    rank = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, heavier = rank.rowsBetween(W.unboundedPreceding, -1), rank.rowsBetween(0, W.unboundedFollowing)
    df = df.withColumn("level", (F.col("all") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(heavier))
    df = df.withColumn("free", F.col("cap") / F.col("weight") > F.col("level"))
    # Of tied sources the first has no tied one counted as capped; its level is the highest.
    level = F.min(F.when(F.col("free"), F.struct(F.col("cap") / F.col("weight"), (-F.col("level")).alias("lower")))).over(every)["lower"]
    return df.withColumn("level", -level).select("source", "n_docs", "source_size", F.when(F.col("level").isNull() | (F.col("cap") / F.col("weight") <= F.col("level")), F.col("cap")).otherwise(F.col("weight") * F.col("level")).alias("target"))


def sainte_lague(df: DataFrame, by: list[str], name: list[str], weight: str, seats: str, out: str) -> DataFrame:
    """Adds `out`: how many of each group's `seats` go to each row by the highest quotients weight / (2 s + 1); ties go by `name`."""
    group = W.partitionBy(*by)
    q = df.withColumn("_sum", F.sum(weight).over(group)).withColumn("_n", F.count(F.lit(1)).over(group))
    q = q.withColumn("_q", F.when(F.col("_sum") > 0, F.col(weight) / F.col("_sum") * F.col(seats)).otherwise(0.0))
    slack = F.ceil(F.col("_q") * F.col("_n") / (2 * F.greatest(F.col(seats), F.lit(1)))) + 2
    q = q.withColumn("_low", F.greatest(F.floor("_q") - slack, F.lit(0)).cast("long")).withColumn("_high", (F.floor("_q") + slack).cast("long"))
    q = q.withColumn("_given", F.sum("_low").over(group))
    ranked = (
        q.filter(F.col("_sum") > 0)
        .select(*by, *name, "_low", F.col(seats).alias("_seats"), F.col(weight).alias("_w"), "_given", F.explode(F.sequence("_low", "_high")).alias("_s"))
        .withColumn("_rank", F.row_number().over(W.partitionBy(*by).orderBy(F.desc(F.col("_w") / (2 * F.col("_s") + 1)), *[F.col(n).asc_nulls_last() for n in name], F.col("_s"))))
        .filter((F.col("_rank") <= F.col("_seats") - F.col("_given")) & (F.col("_w") > 0))
        .groupBy(*by, *name)
        .agg(F.count(F.lit(1)).alias("_more"))
    )
    keys = [*by, *name]
    joined = q.alias("l").join(ranked.alias("r"), [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys], "left")
    return joined.select(*[F.col(f"l.{c}") for c in df.columns], F.when(F.col("l._sum") > 0, F.col("l._low") + F.coalesce(F.col("r._more"), F.lit(0))).otherwise(F.lit(0)).cast("long").alias(out))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP, block: int = BLOCK, shard_docs: int = SHARD_DOCS, bundle: int = BUNDLE, seed: int = SEED) -> DataFrame:
    """One row per document row: doc_id, source, _h (text hash), size, source_size, target, taken (words, repeats counted)."""
    base = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.xxhash64("text").alias("_h"), word_count(F.col("text")).alias("size")))
    by_source = cut(targets(base.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size")), weights, share, cap))
    seats = cut(sainte_lague(by_source.withColumn("_all", F.round(F.sum("target").over(W.partitionBy()) / block).cast("long")).withColumn("_g", F.lit(0)), ["_g"], ["source"], "target", "_all", "quota").drop("_g", "_all"))
    named = base.withColumn("_source", F.struct("source"))
    small = seats.select(F.struct("source").alias("_source"), "n_docs", "source_size", "target", "quota")
    placed = sized_join(named, small, ["_source"], "inner").withColumn("_order", F.xxhash64(F.lit(seed), "doc_id", "_h"))
    placed = placed.withColumn("_shard", F.pmod("_order", F.ceil(F.col("n_docs") / shard_docs)))
    # One line of blocks per (source, shard).
    shards = placed.groupBy("_source", "_shard").agg(F.sum("size").alias("_words"), F.first("quota").alias("quota"))
    shards = cut(shards.withColumn("source", F.col("_source.source")).withColumn("_bundle", F.floor(F.col("_shard") / bundle)).withColumn("_words_d", F.col("_words").cast("double")))
    bundles = shards.groupBy("source", "_bundle").agg(F.sum("_words_d").alias("_words_d"), F.first("quota").alias("quota"))
    bundles = sainte_lague(bundles, ["source"], ["_bundle"], "_words_d", "quota", "_share").select(F.struct("source").alias("_source"), "_bundle", "_share")
    shards = cut(sainte_lague(sized_join(shards, bundles, ["_source", "_bundle"], "inner"), ["source", "_bundle"], ["_shard"], "_words_d", "_share", "_quota"))
    blocks = F.greatest(F.ceil(F.col("_words") / block), F.lit(1))
    small = shards.select("_source", "_shard", F.least(F.col("_quota"), cap * blocks).alias("_quota"), blocks.alias("_blocks"))
    line = W.partitionBy("_source", "_shard").orderBy("_order", "doc_id", "_h").rowsBetween(W.unboundedPreceding, -1)
    laid = sized_join(placed.withColumn("_start", F.coalesce(F.sum("size").over(line), F.lit(0))), small, ["_source", "_shard"], "inner")
    times, rest = F.floor(F.col("_quota") / F.col("_blocks")), F.pmod("_quota", F.col("_blocks"))
    first = F.pmod(F.xxhash64(F.lit(seed + 1), "_source", "_shard"), F.col("_blocks"))  # the seeded run [first, first + rest), around the end
    span = lambda a, b: F.greatest(F.least(F.col("_start") + F.col("size"), b * block) - F.greatest(F.col("_start"), a * block), F.lit(0))
    once = span(first, F.least(first + rest, F.col("_blocks"))) + span(F.lit(0), first + rest - F.col("_blocks"))
    return laid.select("doc_id", "source", "_h", "size", "source_size", "target", (times * F.col("size") + F.when(rest > 0, once).otherwise(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **kw) -> DataFrame:
    """The documents of the mix, whole: each appears as often as its taken words, rounded, make of it."""
    mixed = mix(docs, **kw).groupBy("doc_id", "_h").agg(F.max(F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0)).cast("int").alias("_times")).filter("_times > 0")
    joined = docs.alias("d").join(mixed.alias("m"), F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.xxhash64("d.text") == F.col("m._h")))
    copies = joined.select(F.struct(*[F.col(f"d.`{c}`") for c in docs.columns]).alias("_doc"), F.explode(F.sequence(F.lit(1), F.col("m._times"))))
    return copies.select("_doc.*")


def op7_mix_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
