"""Keyed merges, version history, ranked picks, connected components and set comparisons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.operators.shared import removed, task_count, written


def latest(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order; give a unique tie-break last."""
    return df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("_rn = 1").drop("_rn")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], always: tuple[str, ...] = (), earliest: tuple[str, ...] = ()) -> DataFrame:
    """Field-wise merge: a new value wins unless it is null or empty; `always` columns take it as it is, `earliest` keep the least."""
    joined = old.alias("o").join(new.withColumn("_new", F.lit(True)).alias("n"), keys, "full_outer")
    cols = []
    for c, kind in old.dtypes:
        if c in keys:
            cols.append(F.col(c))
            continue
        o, n = F.col(f"o.{c}"), F.col(f"n.{c}")
        present = F.col("n._new").isNotNull()
        if c in always:
            cols.append(F.when(present, n).otherwise(o).alias(c))
        elif c in earliest:
            cols.append(F.least(o, n).alias(c))
        elif kind.startswith("map"):
            cols.append(F.coalesce(F.map_zip_with(o, n, lambda k, a, b: F.coalesce(b, a)), n, o).alias(c))
        elif kind.startswith("array"):
            cols.append(F.array_sort(F.array_union(F.coalesce(o, F.array().cast(kind)), F.coalesce(n, F.array().cast(kind)))).alias(c))
        else:
            cols.append(F.coalesce(F.when(n.cast("string") != "", n), o).alias(c))
    return joined.select(*cols)


def add_versions(versions: DataFrame, seen: DataFrame, keys: list[str], hash_col: str, at: str) -> DataFrame:
    """Content-hash history: an unseen (key, hash) is a new version, a seen one only moves its verification time."""
    on = [*keys, hash_col]
    now = seen.groupBy(*on).agg(F.max(at).alias("_at"))
    merged = versions.join(now, on, "full_outer")
    return merged.select(*on, F.coalesce("retrieved_at", "_at").alias("retrieved_at"), F.coalesce("_at", "last_verified_at").alias("last_verified_at"), F.col("retrieved_at").isNull().alias("is_new"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id reachable, by label propagation with shortcuts; lineage is cut each round, and a round's table goes once the next is written."""
    both = written(edges.select(F.col(a).alias("x"), F.col(b).alias("y")).union(edges.select(b, a)).filter("x != y").distinct())
    labels = written(both.groupBy(F.col("x").alias("id")).agg(F.min("y").alias("m")).select("id", F.least("id", "m").alias("component"), F.lit(None).cast(both.dtypes[0][1]).alias("was")))
    while True:
        near = both.join(labels.select(F.col("id").alias("y"), "component"), "y").groupBy(F.col("x").alias("id")).agg(F.min("component").alias("near"))
        step = labels.join(near, "id").select("id", F.least("component", "near").alias("c"), F.col("component").alias("was"))
        far = labels.select(F.col("id").alias("c"), F.col("component").alias("far"))
        new = written(step.join(far, "c", "left").select("id", F.least("c", F.coalesce("far", "c")).alias("component"), "was"))
        removed(labels)
        if new.filter("component != was").isEmpty():
            removed(both)
            return new.select("id", "component")
        labels = new


def multiset_overlap(left: DataFrame, right: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Per key, how many values both sides share, repeats counted."""
    l, r = (d.groupBy(*keys, value).count() for d in (left, right))
    both = l.join(r.withColumnRenamed("count", "other"), [*keys, value], "left")
    return both.groupBy(*keys).agg(F.sum("count").alias("n_left"), F.sum(F.least("count", F.coalesce("other", F.lit(0)))).alias("n_shared"))


def multisets_equal(export: DataFrame, stored: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Per key the counts of both sides and whether their multisets of values agree: equal, differs, missing (nothing stored) or not exported."""
    on = [*keys, value]
    alone = reduce(lambda x, y: x | y, [F.col(c).isNull() for c in on])  # nulls are equal to nothing, so each side keeps its own
    sides = [d.select(*on, F.when(alone, F.lit(k)).alias("_alone"), F.lit(int(k == 0)).alias("_e"), F.lit(int(k == 1)).alias("_s")) for k, d in enumerate((export, stored))]
    both = sides[0].unionByName(sides[1])
    each = both.repartition(task_count(both.count()), *on).groupBy(*on, "_alone").agg(F.sum("_e").alias("_e"), F.sum("_s").alias("_s"))
    n_export, n_stored = F.sum("_e"), F.sum("_s")
    state = F.when(n_stored == 0, "missing").when(n_export == 0, "not exported").when(F.bool_and(F.col("_e") == F.col("_s")), "equal").otherwise("differs")
    return each.groupBy(*keys).agg(n_export.alias("n_export"), n_stored.alias("n_stored"), state.alias("state"))


def islands(df: DataFrame, keys: list[str], order: list[str] | list[Column], start: Column, name: str = "island") -> DataFrame:
    """Numbers runs of rows: `start` marks the first row of each."""
    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(F.when(start, 1).otherwise(0)).over(w))
