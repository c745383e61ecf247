"""Narrative chunks: short sections join their parents, text breaks at section, speaker, table and size, long blocks at sentences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.functions import text as X
from lodestone.operators import structure as S
from lodestone.operators.relational import islands

#: Labels of blocks that carry text.
TEXT_LABELS = ["text", "list_item", "section_header", "caption", "footnote", "paragraph", "formula", "code", "title"]


def eligible() -> Column:
    """Blocks that narrative text is made of."""
    label = F.coalesce("label", F.lit("text"))
    return (F.col("type") == "text") & (label != "section_header") & label.isin(TEXT_LABELS) & ~F.coalesce("attached", F.lit(False)) & (F.trim("text") != "")


def lifted(blocks: DataFrame, least: int) -> DataFrame:
    """Blocks of sections with less than `least` tokens move to the section above; the first of a run is led in by its heading.

    blocks: doc, pos, type, label, text, path (array), attached and more columns."""
    size = blocks.filter(eligible()).groupBy("doc", "path").agg(F.sum(X.approx_tokens(F.col("text"))).alias("_size"))
    j = blocks.join(size, ["doc", "path"], "left").withColumn("_lift", eligible() & (F.size("path") > 1) & (F.coalesce("_size", F.lit(0)) < least))
    before = F.lag(F.when(F.col("_lift"), F.col("path"))).over(W.partitionBy("doc", "_e").orderBy("pos"))
    k = j.withColumn("_e", eligible()).withColumn("_before", before)
    lead = F.when(~F.coalesce(F.col("_before") == F.col("path"), F.lit(False)), F.concat(F.element_at("path", -1), F.lit(": "))).otherwise("")
    text = F.when(F.col("_lift"), F.concat(lead, F.col("text"))).otherwise(F.col("text"))
    path = F.when(F.col("_lift"), F.slice("path", 1, F.size("path") - 1)).otherwise(F.col("path"))
    return k.withColumn("text", text).withColumn("path", path).drop("_size", "_lift", "_e", "_before")


def parents(blocks: DataFrame) -> DataFrame:
    """One text per document and section path, in order, with its pages; skipped sections have none. Keyed by document and path, so no row grows with the corpus."""
    kept = blocks.filter(eligible() & ~S.skipped_section(F.col("path")))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]), "\n")
    return kept.groupBy("doc", "path").agg(text.alias("text"), F.array_sort(F.collect_set("page")).alias("pages"))


def pieces(text: Column, target: int) -> Column:
    """Sentences packed greedily to `target` tokens."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit("").alias("cur"), F.array().cast("array<string>").alias("out"))

    def step(a, s):
        k = X.approx_tokens(s)
        full = (a["cur"] != "") & (a["n"] + k > target)
        joined = F.when(a["cur"] == "", s).otherwise(F.concat(a["cur"], F.lit(" "), s))
        return F.when(full, F.struct(k.alias("n"), s.alias("cur"), F.array_append(a["out"], a["cur"]).alias("out"))).otherwise(F.struct((a["n"] + k).alias("n"), joined.alias("cur"), a["out"].alias("out")))

    return F.aggregate(X.sentences(text), zero, step, lambda a: F.array_append(a["out"], a["cur"]))


def chunks(blocks: DataFrame, target: int = 400, most: int = 800, least_words: int = 3, captions: DataFrame | None = None) -> DataFrame:
    """(doc, first_pos, part, path, speaker, text, pages, n_blocks, needs_review).

    blocks: doc, pos, page, type, label, text, path, speaker, status, attached. A chunk ends where path or speaker change, a table comes between, or the next
    block would pass `target` tokens; a block of more than `most` tokens ends what was gathered before it and is cut at its sentences. Only the fold over the
    sizes of one run is inside an expression."""
    ordered = W.partitionBy("doc").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    marked = blocks.withColumn("_tables", F.sum(F.when(F.col("type") == "table", 1).otherwise(0)).over(ordered))
    text = marked.filter(eligible() & ~S.skipped_section(F.col("path")) & ~F.trim("text").rlike(S.BOILERPLATE))
    if captions is not None:  # texts that repeat a table's caption
        text = text.join(captions.select("doc", F.col("caption").alias("_c")).distinct(), (F.col("label") == "caption") & (text["doc"] == captions["doc"]) & (F.trim("text") == F.col("_c")), "left_anti")
    text = text.withColumn("_n", X.approx_tokens(F.trim("text"))).withColumn("_long", F.col("_n") > most)
    key = F.struct("path", "speaker", "_tables")
    before = W.partitionBy("doc").orderBy("pos")
    fresh = F.coalesce((F.col("_k") != F.lag("_k").over(before)) | F.lag("_long").over(before), F.lit(True))
    runs = islands(text.withColumn("_k", F.xxhash64(key)).withColumn("_new", fresh), ["doc"], ["pos"], F.col("_new"), "_run").filter("NOT _long")
    items = F.array_sort(F.collect_list(F.struct("pos", F.col("_n").alias("n"), "text", "page", F.coalesce(F.col("status") == "needs_review", F.lit(False)).alias("review"))))
    grouped = runs.groupBy("doc", "_run").agg(items.alias("_a"), F.first("path").alias("path"), F.first("speaker").alias("speaker"))
    zero = F.struct(F.lit(0).cast("long").alias("size"), F.lit(0).alias("no"), F.array().cast("array<int>").alias("out"))

    def step(a, x):
        over = (a["size"] > 0) & (a["size"] + x["n"] > target)
        no = F.when(over, a["no"] + 1).otherwise(a["no"])
        return F.struct(F.when(over, x["n"]).otherwise(a["size"] + x["n"]).alias("size"), no.alias("no"), F.array_append(a["out"], no).alias("out"))

    each = grouped.withColumn("_no", F.aggregate("_a", zero, step)["out"]).select("doc", "_run", "path", "speaker", F.explode(F.arrays_zip(F.col("_a").alias("a"), F.col("_no").alias("no"))).alias("e"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("e.a.pos", "e.a.text"))), lambda x: x["text"]), "\n")
    whole = each.groupBy("doc", "_run", F.col("e.no").alias("_no")).agg(F.min("e.a.pos").alias("first_pos"), F.first("path").alias("path"), F.first("speaker").alias("speaker"), joined.alias("text"), F.array_sort(F.collect_set("e.a.page")).alias("pages"), F.count(F.lit(1)).alias("n_blocks"), F.bool_or("e.a.review").alias("needs_review"))
    cut = text.filter("_long").select("doc", F.col("pos").alias("first_pos"), F.posexplode(pieces(F.trim("text"), target)).alias("part", "text"), "path", "speaker", F.array("page").alias("pages"), F.lit(1).cast("long").alias("n_blocks"), F.coalesce(F.col("status") == "needs_review", F.lit(False)).alias("needs_review"))
    out = whole.withColumn("part", F.lit(0)).select(*cut.columns).unionByName(cut)
    return out.filter(F.size(F.filter(F.split("text", r"\s+"), lambda w: w != "")) >= least_words)


def embed_text(header: Column, short_header: Column, kind: Column, text: Column) -> Column:
    """What is embedded: the context header and the text; row lines carry caption and columns themselves and take the short header."""
    return F.concat(F.when(kind == "row", short_header).otherwise(header), F.lit("\n"), text)
