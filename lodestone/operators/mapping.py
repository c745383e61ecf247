"""Registrations to programs as one composition: match curated names, leave held-out products alone, cluster the rest into new programs, keep what was asked for.

When a request names products that no curated program knows, what matched them tells the ingredient; the ingredient's whole catalog is then clustered, because one product has other
brands elsewhere, and only clusters that hold a requested registration stay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions import text as X
from lodestone.operators import resolution as RS
from lodestone.operators.shared import written


def mapped(catalog: DataFrame, aliases: DataFrame, held_out: DataFrame, taken: DataFrame, requested: bool = False, widen: Callable[[str], DataFrame] | None = None, auto: bool = True, has_reference: bool = False) -> tuple[DataFrame, DataFrame]:
    """(registrations with program_id and action, new programs).

    catalog: id, agency, native_key, brand, holder, reference, approved, ingredient, names (array); aliases: program_id, ord, agency, alias; held_out: alias; taken: name.
    Actions: curated (a known program), auto (a new one), held_out (no program, kept in the catalog), unmapped (without `auto`), skipped (nobody asked for its program). A request whose names
    match no registration gives no rows."""
    seeds = None
    if requested and auto:
        known = RS.match_programs(catalog.select(F.col("id").alias("reg_id"), "agency", "names"), aliases)
        seeds = written(catalog.join(known.select(F.col("reg_id").alias("id")), "id", "left_anti").select("agency", "native_key", F.lit(1).alias("one"), X.base_ingredient(F.col("ingredient")).alias("ingredient"), "id"))
        if seeds.isEmpty():
            return catalog.limit(0).withColumn("program_id", F.lit(None).cast("string")).withColumn("action", F.lit("skipped")), RS.programs(RS.clusters(catalog.limit(0)), taken)
        common = RS.majority(seeds.filter("ingredient != ''"), ["one"], "ingredient", "id").head()
        if common is not None and widen is not None:
            catalog = widen(common["ingredient"])
    catalog = written(catalog)
    found = RS.match_programs(catalog.select(F.col("id").alias("reg_id"), "agency", "names"), aliases).withColumnRenamed("reg_id", "id").withColumnRenamed("program_id", "_curated")
    marked = written(catalog.join(found, "id", "left"))
    free = marked.filter("_curated IS NULL")
    out = RS.excluded(free.select(F.col("id").alias("reg_id"), "names"), held_out).select(F.col("reg_id").alias("id"), F.lit(True).alias("_out"))
    todo = written(free.join(out, "id", "left_anti").drop("_curated"))
    clustered = written(RS.clusters(todo)) if auto else None
    if clustered is None:
        new = None
        assigned = marked.join(out, "id", "left").withColumn("_new", F.lit(None).cast("string")).withColumn("_keep", F.lit(True))
    else:
        new = RS.programs(clustered, taken, has_reference)
        keep = clustered.select("cluster").distinct() if seeds is None else clustered.join(seeds.select("agency", "native_key").distinct(), ["agency", "native_key"], "left_semi").select("cluster").distinct()
        new = written(new.join(keep.withColumn("_keep", F.lit(True)), "cluster", "left"))
        named = clustered.select("id", "cluster").join(new.select("cluster", F.col("program_id").alias("_new"), "_keep"), "cluster").drop("cluster")
        assigned = marked.join(out, "id", "left").join(named, "id", "left")
    mine = F.coalesce("_curated", F.when(F.coalesce("_keep", F.lit(False)), F.col("_new")))
    action = F.when(F.col("_curated").isNotNull(), "curated").when(F.coalesce("_out", F.lit(False)), "skipped" if seeds is not None else "held_out").when(mine.isNotNull(), "auto").when(F.lit(not auto), "unmapped").otherwise("skipped")
    rows = assigned.select(*catalog.columns, mine.alias("program_id"), action.alias("action"))
    return rows, (new.filter("_keep").drop("_keep") if new is not None else RS.programs(RS.clusters(catalog.limit(0)), taken))
