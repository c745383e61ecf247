"""Tables of cells to chunks: span occupancy, header rows, column names, Markdown, row lines and row groups.

A table is one row: `grid` (array of arrays of text) and `n_head`. Folds over the rows of one table run inside expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import text as X

#: Fixed patterns: a cell that is a plain value, and leaders of a table of contents.
VALUE = r"^[-+<>≤≥~]?\s*\d[\d.,]*\s*(%|\(.*\)|\[.*\])?\s*$|^(NA|NC|ND|-|–|—)$"
LEADER = r"\.{6,}|…{3,}"
HEAD_ROWS = 7  # fixed value: a header is looked for in the first seven rows


def let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def grids(cells: DataFrame, key: str) -> DataFrame:
    """(key, grid, n_head): cells (key, pos, r, c, rs, cs, text, header) spread over the places they span; of several cells of one place the first with text counts."""
    clean = cells.withColumn("text", F.trim(F.regexp_replace("text", r"(?U)\s+", " ")))
    spread = clean.repartition(key).withColumn("_r", F.explode(F.sequence(F.col("r"), F.col("r") + F.col("rs") - 1))).withColumn("_c", F.explode(F.sequence(F.col("c"), F.col("c") + F.col("cs") - 1)))
    # Places, rows and tables are grouped in turn without another shuffle: each key is a part of the next finer one.
    said = F.col("text") != ""
    place = spread.groupBy(key, "_r", "_c").agg(F.min_by("text", F.when(said, F.col("pos"))).alias("text"), F.max(F.col("r") + F.col("rs")).alias("_rows"), F.max(F.col("c") + F.col("cs")).alias("_cols"), F.collect_set(F.when(F.col("header"), F.col("r"))).alias("_some"))
    line = place.groupBy(key, "_r").agg(F.collect_list(F.when(F.col("text").isNotNull(), F.struct("_c", "text"))).alias("_t"), F.max("_rows").alias("_rows"), F.max("_cols").alias("_cols"), F.flatten(F.collect_list("_some")).alias("_some"))
    j = line.groupBy(key).agg(F.collect_list(F.struct("_r", "_t")).alias("_l"), F.max("_rows").alias("_rows"), F.max("_cols").alias("_cols"), F.array_distinct(F.flatten(F.collect_list("_some"))).alias("_flags"))
    columns = F.sequence(F.lit(0), F.col("_cols") - 1)
    of_row = lambda cells: F.transform(columns, lambda c: F.coalesce(F.get(F.filter(cells, lambda x: x["_c"] == c), F.lit(0))["text"], F.lit("")))
    grid = F.transform(F.sequence(F.lit(0), F.col("_rows") - 1), lambda r: of_row(F.coalesce(F.get(F.filter("_l", lambda x: x["_r"] == r), F.lit(0))["_t"], F.slice(F.get("_l", F.lit(0))["_t"], 1, 0))))
    flagged = F.aggregate(F.sequence(F.lit(0), F.col("_rows") - 1), F.lit(0), lambda n, r: F.when((n == r) & F.array_contains("_flags", r) & (r < F.col("_rows") - 1), n + 1).otherwise(n))
    found = j.withColumn("grid", grid).withColumn("_f", flagged)
    found = found.withColumn("n_head", F.greatest("_f", inferred_head(F.col("grid"))))
    return found.select(key, filled_head(F.col("grid"), F.col("n_head")).alias("grid"), "n_head")


def inferred_head(grid: Column) -> Column:
    """Rows above the first one whose cells after the first are mostly values; rows with a first cell alone are labels of groups."""
    rest = lambda row: F.filter(F.slice(row, 2, F.greatest(F.size(row) - 1, F.lit(0))), lambda v: v != "")
    kind = lambda row: let(rest(row), lambda x: F.when(F.size(x) == 0, "g").when(2 * F.size(F.filter(x, lambda v: v.rlike(VALUE))) >= F.size(x), "v").otherwise("h"))
    kinds = F.transform(F.slice(grid, 1, HEAD_ROWS), kind)
    first = F.array_position(kinds, "v")  # from 1; 0 without
    above = F.slice(kinds, 1, F.greatest(first - 1, F.lit(0)).cast("int"))
    last = F.array_max(F.transform(above, lambda x, i: F.when(x == "h", i + 1).otherwise(0)))
    return F.when(first == 0, 0).otherwise(F.coalesce(last, F.lit(0))).cast("int")


def filled_head(grid: Column, n_head: Column) -> Column:
    """Blank header cells from the third column on take what stands left of them."""
    fill = lambda row: F.aggregate(row, F.array().cast("array<string>"), lambda a, v: F.array_append(a, F.when((v == "") & (F.size(a) >= 2), F.get(a, F.size(a) - 1)).otherwise(v)))
    return F.transform(grid, lambda row, i: F.when(i < n_head, fill(row)).otherwise(row))


def column_names(grid: Column, n_head: Column) -> Column:
    """Per column its distinct header texts, top down."""
    head = F.slice(grid, 1, n_head)
    width = F.size(F.get(grid, F.lit(0)))
    return F.transform(F.sequence(F.lit(0), width - 1), lambda k: F.array_join(F.array_distinct(F.filter(F.transform(head, lambda row: F.get(row, k)), lambda v: v != "")), " / "))


def toc_or_abbreviations(grid: Column, names: Column) -> Column:
    """Tables that list contents or abbreviations."""
    flat = F.filter(F.flatten(grid), lambda v: v != "")
    leaders = let(flat, lambda x: (F.size(x) > 0) & (F.size(F.filter(x, lambda v: v.rlike(LEADER))) >= F.greatest(F.lit(2), F.floor(F.size(x) / 5))))
    head = F.lower(F.array_join(names, " "))
    terms = (F.size(names) == 2) & F.lower(F.get(names, F.lit(0))).rlike("^((term|abbreviation)s? / ?|term)$")
    return leaders | head.rlike("abbreviation|acronym") | F.coalesce(terms, F.lit(False))


def markdown_row(values: Column) -> Column:
    return F.concat(F.lit("| "), F.array_join(F.transform(values, lambda v: F.replace(v, F.lit("|"), F.lit("/"))), " | "), F.lit(" |"))


def markdown(caption: Column, names: Column, rows: Column, notes: Column) -> Column:
    """Caption, header (if any column has a name), rows and notes, a line each."""
    none = F.array().cast("array<string>")
    head = F.when(F.exists(names, lambda x: x != ""), F.array(markdown_row(names), markdown_row(F.transform(names, lambda x: F.lit("---"))))).otherwise(none)
    return F.array_join(F.concat(F.when(caption != "", F.array(caption)).otherwise(none), head, F.transform(rows, markdown_row), notes), "\n")


def row_lines(caption: Column, grid: Column, n_head: Column, names: Column) -> Column:
    """array<struct<r, line>>: `caption / group / label: column=value; ...` per data row. A row with its first cell alone names the group of those below."""
    def pairs(v: Column) -> Column:
        rest = F.slice(v, 2, F.greatest(F.size(v) - 1, F.lit(0)))
        named = F.transform(rest, lambda c, k: F.when(c != "", F.concat(F.coalesce(F.nullif(F.get(names, k + 1), F.lit("")), F.concat(F.lit("col"), (k + 2).cast("string"))), F.lit("="), c)))
        return F.array_compact(named)

    rows = F.transform(grid, lambda row, r: F.struct(r.alias("r"), row.alias("v"), pairs(row).alias("p")))
    data = F.filter(rows, lambda x: (x["r"] >= n_head) & F.exists(x["v"], lambda c: c != ""))

    def step(acc, x):
        label = F.get(x["v"], F.lit(0))
        rest = F.slice(x["v"], 2, F.greatest(F.size(x["v"]) - 1, F.lit(0)))
        group = (label != "") & ~F.exists(rest, lambda c: (c != "") & (c != label))
        lead = F.array_join(F.filter(F.array(caption, acc["group"], label), lambda s: s != ""), " / ")
        line = F.struct(x["r"].alias("r"), F.concat(lead, F.lit(": "), F.array_join(x["p"], "; ")).alias("line"))
        more = F.when(F.size(x["p"]) > 0, F.array_append(acc["out"], line)).otherwise(acc["out"])
        return F.when(group, F.struct(label.alias("group"), acc["out"].alias("out"))).otherwise(F.struct(acc["group"].alias("group"), more.alias("out")))

    start = F.struct(F.lit("").alias("group"), F.array().cast("array<struct<r:int,line:string>>").alias("out"))
    return F.aggregate(data, start, step)["out"]


def row_groups(caption: Column, grid: Column, n_head: Column, names: Column, notes: Column, most: int) -> Column:
    """The table as parts of at most `most` tokens, each with caption and header; a single row may pass the bound. Notes follow the last part.

    A part's text is caption and header plus its rows, so its length is a running sum and no text is rendered twice."""
    none = F.array().cast("array<string>")
    body = F.transform(F.slice(grid, n_head + 1, F.greatest(F.size(grid) - n_head, F.lit(0))), markdown_row)
    head = F.length(markdown(caption, names, F.array().cast("array<array<string>>"), none))

    def step(acc, row):
        grown = acc["len"] + F.length(row) + F.when(acc["len"] > 0, 1).otherwise(0)
        over = (F.size(acc["rows"]) > 0) & (F.greatest(F.lit(1), F.floor((grown + 3) / 4)) > most)
        fresh = F.struct((head + F.length(row) + F.when(head > 0, 1).otherwise(0)).alias("len"), F.array(row).alias("rows"), F.array_append(acc["parts"], acc["rows"]).alias("parts"))
        return F.when(over, fresh).otherwise(F.struct(grown.alias("len"), F.array_append(acc["rows"], row).alias("rows"), acc["parts"].alias("parts")))

    start = F.struct(head.alias("len"), none.alias("rows"), F.array().cast("array<array<string>>").alias("parts"))
    parts = F.aggregate(body, start, step, lambda a: F.array_append(a["parts"], a["rows"]))
    lines = F.when(F.exists(names, lambda x: x != ""), F.array(markdown_row(names), markdown_row(F.transform(names, lambda x: F.lit("---"))))).otherwise(none)
    top = F.concat(F.when(caption != "", F.array(caption)).otherwise(none), lines)
    return F.transform(parts, lambda p, i: F.array_join(F.concat(top, p, F.when(i == F.size(parts) - 1, notes).otherwise(none)), "\n"))


def chunks(tables: DataFrame, most: int = 400) -> DataFrame:
    """Chunks of tables (key columns, caption, grid, n_head, notes, study_ids): kind (table, row), no, text. Row lines only for tables with 30 % of numeric cells or a study."""
    names = column_names(F.col("grid"), F.col("n_head"))
    t = tables.withColumn("_names", names).filter(~toc_or_abbreviations(F.col("grid"), F.col("_names")))
    parts = row_groups(F.col("caption"), F.col("grid"), F.col("n_head"), F.col("_names"), F.col("notes"), most)
    whole = F.transform(parts, lambda x, i: F.struct(F.lit("table").alias("kind"), i.alias("no"), x.alias("text")))
    flat = F.filter(F.flatten(F.transform(F.slice(F.col("grid"), F.col("n_head") + 1, F.size("grid")), lambda row: F.slice(row, 2, F.size(row)))), lambda v: v != "")
    numeric = let(flat, lambda x: (F.size(x) > 0) & (10 * F.size(F.filter(x, lambda v: v.rlike(r"\d"))) >= 3 * F.size(x)))
    lines = F.transform(row_lines(F.col("caption"), F.col("grid"), F.col("n_head"), F.col("_names")), lambda x: F.struct(F.lit("row").alias("kind"), x["r"].alias("no"), x["line"].alias("text")))
    some = F.when(numeric | (F.size("study_ids") > 0), lines).otherwise(F.array().cast("array<struct<kind:string,no:int,text:string>>"))
    keep = [c for c in tables.columns if c not in ("caption", "grid", "n_head", "notes", "study_ids")]
    return t.select(*keep, F.explode(F.concat(whole, some)).alias("_c")).select(*keep, "_c.*", X.approx_tokens(F.col("_c.text")).alias("tokens"))
