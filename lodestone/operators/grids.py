"""Tables from the boxes of recognised lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.operators.relational import islands

# Fixed values.
NUMERIC = r"^[\s(<>≤≥±~\-–]*\d[\d.,:/%()\s\-–±]*$"
LEAST_LINES, LEAST_ROWS, NUMERIC_SHARE, ROW_GAP, COLUMN_GAP = 8, 3, 0.35, 0.5, 2


def grid_cells(lines: DataFrame, key: str) -> DataFrame:
    """Cells (row, column, text) of the regions whose lines look like a table.

    lines: key, l, b, r, t, text; y grows upwards. A row takes the lines whose centre is within half a median height of
    its first line's. Columns are the merged extents of numbers in rows that are mostly numeric; what ends left of the
    first is column 0. Only the row numbering needs a fold over one region's lines (a page holds few hundred); all else
    is grouped by the same key, so one shuffle serves. Regions that are not tables give no rows.
    """
    clean = lines.select(key, *[F.col(c).cast("double").alias(c) for c in "lbrt"], F.trim("text").alias("text")).filter("text != ''")
    item = F.struct((-(F.col("b") + F.col("t")) / 2).alias("down"), "l", "r", (F.col("t") - F.col("b")).alias("h"), "text", F.col("text").rlike(NUMERIC).alias("num"))
    regions = clean.groupBy(key).agg(F.sort_array(F.collect_list(item)).alias("items"), F.median(F.col("t") - F.col("b")).alias("h"))
    reach = F.lit(ROW_GAP) * F.when(F.col("h") != 0, F.col("h")).otherwise(1.0)

    def step(acc, x):
        joins = F.coalesce(F.abs(acc["anchor"] - x["down"]) <= reach, F.lit(False))
        row = F.when(joins, acc["row"]).otherwise(acc["row"] + 1)
        return F.struct(F.when(joins, acc["anchor"]).otherwise(x["down"]).alias("anchor"), row.alias("row"), F.concat(acc["rows"], F.array(row)).alias("rows"))

    start = F.struct(F.lit(None).cast("double").alias("anchor"), F.lit(-1).alias("row"), F.array().cast("array<int>").alias("rows"))
    numbered = regions.withColumn("rows", F.aggregate("items", start, step, lambda acc: acc["rows"]))
    share = F.size(F.filter("items", lambda x: x["num"])) / F.size("items")
    tables = numbered.filter((F.size("items") >= LEAST_LINES) & (share >= NUMERIC_SHARE) & (F.array_max("rows") + 1 >= LEAST_ROWS))
    each = tables.select(key, F.posexplode(F.arrays_zip("items", "rows")).alias("pos", "e")).select(key, "pos", F.col("e.rows").alias("row"), "e.items.l", "e.items.r", "e.items.text", "e.items.num")

    in_row = W.partitionBy(key, "row")
    numbers = each.withColumn("nums", F.count_if("num").over(in_row)).withColumn("all", F.count(F.lit(1)).over(in_row))
    spans = numbers.filter(F.col("num") & (F.col("nums") >= F.greatest(F.lit(2), F.floor(F.col("all") / 2))))
    before = W.partitionBy(key).orderBy("l", "r").rowsBetween(W.unboundedPreceding, -1)
    fresh = spans.withColumn("fresh", F.coalesce(F.col("l") > F.max("r").over(before) + COLUMN_GAP, F.lit(True)))
    extents = islands(fresh, [key], ["l", "r"], F.col("fresh"), "col").groupBy(key, "col").agg(F.min("l").alias("x0"), F.max("r").alias("x1"))
    columns = extents.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("x0", "x1"))).alias("cols"))

    centre = (F.col("l") + F.col("r")) / 2
    off = F.transform("cols", lambda k: F.greatest(k["x0"] - centre, centre - k["x1"], F.lit(0.0)))
    slot = F.when(F.col("cols").isNull() | (F.col("r") < F.col("cols")[0]["x0"]), 0).otherwise(F.array_position(off, F.array_min(off)))
    placed = each.join(columns, key, "left").withColumn("col", slot.cast("int"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("l", "pos", "text"))), lambda x: x["text"]), " ")
    return placed.groupBy(key, "row", "col").agg(text.alias("text")).withColumn("structure", F.lit("ocr_grid"))
