"""Boxes and points on pages by tiles: what lies where without comparing all pairs of a page; angles; coverage by a sweep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TOLERANCE, TILE = 2.0, 64.0


def within(inner: DataFrame, outer: DataFrame, keys: list[str], tolerance: float = TOLERANCE, tile: float = TILE) -> DataFrame:
    """Rows of inner (keys, id, l, b, r, t) with the `box` (id) of each outer box (same columns) of their page that holds their centre, `tolerance` around. Points are boxes without extent.

    A centre lies in one tile of its page; an outer box offers itself in each tile it touches, so only neighbours meet."""
    x, y = (F.col("l") + F.col("r")) / 2, (F.col("b") + F.col("t")) / 2
    cell = lambda c: F.floor(c / tile)
    points = inner.withColumn("_x", x).withColumn("_y", y).withColumn("_i", cell(F.col("_x"))).withColumn("_j", cell(F.col("_y")))
    some = outer.filter("l <= r AND b <= t").select(*keys, F.col("id").alias("box"), *[F.col(c).alias(f"_{c}") for c in "lbrt"])
    tiles = some.withColumn("_i", F.explode(F.sequence(cell(F.col("_l") - tolerance), cell(F.col("_r") + tolerance)))).withColumn("_j", F.explode(F.sequence(cell(F.col("_b") - tolerance), cell(F.col("_t") + tolerance))))
    met = points.join(tiles, [*keys, "_i", "_j"])
    hit = F.col("_x").between(F.col("_l") - tolerance, F.col("_r") + tolerance) & F.col("_y").between(F.col("_b") - tolerance, F.col("_t") + tolerance)
    return met.filter(hit).select(*inner.columns, "box")


def texts_in(lines: DataFrame, boxes: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, box, text): the lines (with `text`) in each box in reading order: from the top in steps of four points, then from the left."""
    row = F.struct((-F.round((F.col("b") + F.col("t")) / 2 / 4)).alias("y"), F.col("l").alias("x"), F.col("id"), F.col("text"))
    return within(lines, boxes, keys).groupBy(*keys, "box").agg(F.array_join(F.transform(F.array_sort(F.collect_list(row)), lambda r: r["text"]), " ").alias("text"))


def angle(a: Column, b: Column) -> Column:
    """Degrees between a text's direction (the first row of its matrix) and the nearest horizontal, 0 to 90."""
    turned = F.pmod(F.abs(F.degrees(F.atan2(b.cast("double"), a.cast("double")))), F.lit(180.0))
    return F.least(turned, 180.0 - turned)


def slanted(a: Column, b: Column, least: float = 15.0, most: float = 75.0) -> Column:
    """Text that lies across the page, such as a stamp: neither along it nor upright."""
    return angle(a, b).between(least, most)


def union_area(boxes: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, area): the area that boxes of a key cover together, overlaps once, by a sweep over their left and right ends.

    Between two neighbouring ends the boxes that span them are cut into strips; a strip's height is the union of intervals, found from running maxima of their tops."""
    some = boxes.filter("l < r AND b < t").select(*keys, "l", "b", "r", "t")
    ends = some.select(*keys, F.col("l").alias("x")).union(some.select(*keys, "r")).distinct()
    strips = ends.withColumn("x2", F.lead("x").over(W.partitionBy(*keys).orderBy("x"))).filter("x2 IS NOT NULL")
    # The strips that a box spans: its ends are among them, so ranks replace a comparison of all pairs.
    ranked = strips.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy("x")))
    first = some.join(ranked.select(*keys, F.col("x").alias("l"), F.col("_n").alias("_from")), [*keys, "l"])
    last = first.join(ranked.select(*keys, F.col("x2").alias("r"), F.col("_n").alias("_to")), [*keys, "r"])
    spans = last.withColumn("_n", F.explode(F.sequence("_from", "_to"))).join(ranked, [*keys, "_n"]).select(*keys, "x", "x2", "b", "t")
    before = W.partitionBy(*keys, "x").orderBy("b", "t").rowsBetween(W.unboundedPreceding, -1)
    fresh = F.greatest(F.col("t") - F.greatest(F.col("b"), F.coalesce(F.max("t").over(before), F.col("b"))), F.lit(0.0))
    return spans.withColumn("_h", fresh).groupBy(*keys).agg(F.sum((F.col("x2") - F.col("x")) * F.col("_h")).alias("area"))


def bare_images(images: DataFrame, texts: DataFrame, keys: list[str], page_area: float, least: float = 0.08) -> DataFrame:
    """(keys, bare): the share of the page under images of which less than `least` of the area lies under texts with their centre on them. Texts add up, overlaps and all; boxes have keys, id, l, b, r, t."""
    size = lambda l, b, r, t: F.greatest(r - l, F.lit(0.0)) * F.greatest(t - b, F.lit(0.0))
    own = size(*[F.col(c) for c in "lbrt"])
    under = within(texts, images, keys).groupBy(*keys, F.col("box").alias("id")).agg(F.sum(own).alias("_under"))
    each = images.select(*keys, "id", own.alias("_area")).join(under, [*keys, "id"], "left")
    bare = F.sum(F.when(F.coalesce("_under", F.lit(0.0)) < least * F.col("_area"), F.col("_area")).otherwise(0.0))
    return each.groupBy(*keys).agg((bare / page_area).alias("bare"))
