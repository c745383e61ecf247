"""Retrieval and extraction metrics."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.functions import alignment
from lodestone.functions import text as X


#: Kinds of dashes, ticked and empty boxes, quotes and marks, and what they are compared as.
FOLDED = {**dict.fromkeys("‐‑‒–—―−", "-"), **dict.fromkeys("✓✔√☑☒⊠", "[x]"), **dict.fromkeys("☐□❑", "[ ]"), "’": "'", "‘": "'", "“": '"', "”": '"', "®": "", "™": ""}


def gold_norm(text: Column, keep_space: bool = False) -> Column:
    """Form in which texts of two readers are compared: composed, lower case, one kind of dash, quote and check mark, without (or with one) space.

    ASCII texts need only case and space and stay in the JVM; others go through one function, and a null is sent in an ASCII text's place."""

    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        import unicodedata

        table = str.maketrans(FOLDED)
        join = " ".join if keep_space else "".join
        return values.map(lambda s: join(unicodedata.normalize("NFKC", s).lower().translate(table).split()), na_action="ignore")

    s = F.coalesce(text, F.lit(""))
    other = s.rlike(r"[^\x00-\x7F]")
    plain = F.trim(F.regexp_replace(F.lower(s), r"[\s\x1c-\x1f]+", " ")) if keep_space else F.translate(F.lower(s), " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f", "")
    return F.when(other, run(F.when(other, s))).otherwise(plain)


def retrieval(groups: DataFrame, hits: DataFrame, contexts: DataFrame) -> DataFrame:
    """One row: n_groups, recall, ctx_recall, n_questions, full, median_tokens, other_share.

    groups: qid, grp, doc, quote (several rows of one group are alternatives); hits: qid, chunk_id, doc, text, parent_key, parent_text, program, named (whether
    the question names the program; null: none named); contexts: qid, tokens of the distinct parents read. Quotes meet hits of their own question and document."""
    quote = lambda c: gold_norm(F.col(c))
    g = groups.withColumn("_q", quote("quote"))
    h = hits.select("qid", "doc", quote("text").alias("_t"), quote("parent_text").alias("_p"))
    met = g.join(h, ["qid", "doc"], "left")
    hit = F.coalesce(F.contains("_t", "_q"), F.lit(False))
    per = met.groupBy("qid", "grp").agg(F.bool_or(hit).alias("hit"), F.bool_or(hit | F.coalesce(F.contains("_p", "_q"), F.lit(False))).alias("ctx"))
    q = per.groupBy("qid").agg(F.bool_and("ctx").alias("full"))
    other = hits.filter("program IS NOT NULL AND named IS NOT NULL").agg(F.avg(F.when(F.col("named"), 0.0).otherwise(1.0)).alias("other_share"))
    a = per.agg(F.count(F.lit(1)).alias("n_groups"), F.avg(F.col("hit").cast("double")).alias("recall"), F.avg(F.col("ctx").cast("double")).alias("ctx_recall"))
    b = q.agg(F.count(F.lit(1)).alias("n_questions"), F.count_if("full").alias("full"))
    c = contexts.join(q.select("qid"), "qid").agg(F.median("tokens").alias("median_tokens"))
    return a.crossJoin(b).crossJoin(c).crossJoin(other)  # one row each


def overlaps(gold: DataFrame, found: DataFrame) -> DataFrame:
    """(page, gold_table, table, overlap): shared cell values, repeats counted, of tables of one page. gold: page, tbl, value; found alike."""
    a = gold.filter("value != ''").groupBy("page", "tbl", "value").agg(F.count(F.lit(1)).alias("_a"))
    b = found.filter("value != ''").groupBy("page", F.col("tbl").alias("_t"), "value").agg(F.count(F.lit(1)).alias("_b"))
    return a.join(b, ["page", "value"]).groupBy("page", F.col("tbl").alias("gold_table"), F.col("_t").alias("table")).agg(F.sum(F.least("_a", "_b")).alias("overlap"))


def matched(gold: DataFrame, found: DataFrame) -> DataFrame:
    """(page, gold_table, table): in the order of the gold tables each takes the free table it overlaps most, of equals the first. The fold runs over the few tables of a page."""
    o = overlaps(gold, found)
    best = F.array_sort(F.collect_list(F.struct((-F.col("overlap")).alias("less"), F.col("table"))))
    per = o.groupBy("page", "gold_table").agg(best.alias("_b")).groupBy("page").agg(F.array_sort(F.collect_list(F.struct("gold_table", "_b"))).alias("_g"))
    kind = dict(found.dtypes)["tbl"]
    zero = F.array().cast(f"array<struct<gold_table:{dict(gold.dtypes)['tbl']},table:{kind}>>")

    def step(acc, g):
        free = F.filter(g["_b"], lambda x: ~F.exists(acc, lambda y: y["table"] == x["table"]))
        return F.when(F.size(free) > 0, F.array_append(acc, F.struct(g["gold_table"].alias("gold_table"), F.get(free, F.lit(0))["table"].alias("table")))).otherwise(acc)

    return per.select("page", F.explode(F.aggregate("_g", zero, step)).alias("m")).select("page", "m.*")


def extraction(gold: DataFrame, found: DataFrame) -> DataFrame:
    """Per page: cell_n, cell_hit, num_n, num_hit, row_n, row_hit of matched tables. gold, found: page, tbl, row, value (in gold_norm form)."""
    pairs = matched(gold, found)
    mine = found.join(pairs.withColumnRenamed("table", "tbl"), ["page", "tbl"])

    def counted(df: DataFrame, tbl: str, *value: str) -> DataFrame:
        return df.groupBy("page", F.col(tbl).alias("_t"), *value).agg(F.count(F.lit(1)).alias("_c"))

    g, f = counted(gold.filter("value != ''"), "tbl", "value"), counted(mine.filter("value != ''"), "gold_table", "value").withColumnRenamed("_c", "_f")
    digit = F.col("value").rlike(r"\d")
    hit = F.least("_c", F.coalesce("_f", F.lit(0)))
    cells = g.join(f, ["page", "_t", "value"], "left").groupBy("page").agg(F.sum("_c").alias("cell_n"), F.sum(hit).alias("cell_hit"), F.sum(F.when(digit, F.col("_c")).otherwise(0)).alias("num_n"), F.sum(F.when(digit, hit).otherwise(0)).alias("num_hit"))
    line = lambda df, tbl: df.filter("value != ''").groupBy("page", tbl, "row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col", "value"))), lambda x: x["value"]), "\x1f").alias("line"))
    gr, fr = counted(line(gold, "tbl"), "tbl", "line"), counted(line(mine, "gold_table"), "gold_table", "line").withColumnRenamed("_c", "_f")
    rows = gr.join(fr, ["page", "_t", "line"], "left").groupBy("page").agg(F.sum("_c").alias("row_n"), F.sum(F.least("_c", F.coalesce("_f", F.lit(0)))).alias("row_hit"))
    return cells.join(rows, "page", "left")


def ratios(pages: DataFrame, *by: str) -> DataFrame:
    """Percent of summed hits over summed counts, by group: cell_recall, num_cell_recall, row_exact."""
    r = lambda a, b: F.when(F.sum(b) > 0, F.round(100 * F.sum(a) / F.sum(b), 1))
    return pages.groupBy(*by).agg(F.count(F.lit(1)).alias("pages"), r("cell_hit", "cell_n").alias("cell_recall"), r("num_hit", "num_n").alias("num_cell_recall"), r("row_hit", "row_n").alias("row_exact"))


def stands_in(needle: Column, hay: Column, share: float = 0.95) -> Column:
    """Whether some stretch of a text is like another text (functions.alignment.stands_in); contained ones are settled without Python."""

    @F.pandas_udf("boolean")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else alignment.stands_in(x, y, share) for x, y in zip(a, b)], dtype=object)

    sure = F.coalesce((needle != "") & F.contains(hay, needle), F.lit(False))
    none = F.coalesce(needle, F.lit("")) == ""
    open_ = ~(sure | none | (F.coalesce(hay, F.lit("")) == ""))
    return F.when(sure, True).when(~open_, False).otherwise(run(F.when(open_, needle), F.when(open_, hay)))  # settled rows send nulls


def text_metrics(gold_texts: DataFrame, gold_cells: DataFrame, found_texts: DataFrame, found_cells: DataFrame, furniture: DataFrame) -> DataFrame:
    """Per page: text_n and text_hit (gold texts that stand in the page's whole text), num_n and num_in_text (numeric gold cells whose value stands in it), garbled (found texts
    with a garbled run), furniture_leak (furniture found as text).

    Tables have page, pos and text; a page's whole text is its texts, then its cells. Gold texts meet their own page only."""
    norm = lambda keep: gold_norm(F.col("text"), keep)
    parts = found_texts.select("page", F.lit(0).alias("k"), "pos", "text").unionByName(found_cells.select("page", F.lit(1).alias("k"), "pos", "text"))
    whole = parts.groupBy("page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "pos", F.coalesce("text", F.lit("")).alias("t")))), lambda x: x["t"]), " ").alias("text"))
    hay = whole.select("page", norm(True).alias("_hay"), norm(False).alias("_compact"))
    t = gold_texts.select("page", norm(True).alias("_t")).join(hay, "page", "left").withColumn("_hit", stands_in(F.col("_t"), F.col("_hay")))
    text = t.groupBy("page").agg(F.count(F.lit(1)).alias("text_n"), F.count_if("_hit").alias("text_hit"))
    n = gold_cells.select("page", norm(False).alias("_c")).filter(F.col("_c").rlike(r"\d")).join(hay, "page", "left")
    nums = n.groupBy("page").agg(F.count(F.lit(1)).alias("num_n"), F.count_if(F.coalesce(F.contains("_compact", "_c"), F.lit(False))).alias("num_in_text"))
    bad = found_texts.groupBy("page").agg(F.count_if(X.garbled_window(F.col("text"))).alias("garbled"))
    items = found_texts.select("page", norm(False).alias("_i")).distinct()
    leak = furniture.select("page", norm(False).alias("_i")).join(items, ["page", "_i"], "left_semi").groupBy("page").agg(F.count(F.lit(1)).alias("furniture_leak"))
    pages = text.select("page").union(nums.select("page")).union(bad.select("page")).union(leak.select("page")).distinct()
    out = pages.join(text, "page", "left").join(nums, "page", "left").join(bad, "page", "left").join(leak, "page", "left")
    return out.fillna(0)


def text_ratios(pages: DataFrame, *by: str) -> DataFrame:
    """By group (a page's route): percent of texts found and of numbers found in the text, and the sums of garbled texts and leaked furniture."""
    r = lambda a, b: F.when(F.sum(b) > 0, F.round(100 * F.sum(a) / F.sum(b), 1))
    return pages.groupBy(*by).agg(F.count(F.lit(1)).alias("pages"), r("text_hit", "text_n").alias("text_recall"), r("num_in_text", "num_n").alias("num_in_text"), F.sum("garbled").alias("garbled"), F.sum("furniture_leak").alias("furniture_leak"))


def page_texts(blocks: DataFrame) -> DataFrame:
    """The text of each page (doc, page) in comparison form, blocks in order: what gold quotes are looked up in."""
    return blocks.groupBy("doc", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", gold_norm(F.col("text")).alias("t")))), lambda x: x["t"]), "").alias("body"))


#: Counters of a run that events of the same kind add to.
COUNTERS = ["registrations", "unmapped_registrations", "auto_programs", "documents", "fetched", "new_versions", "fetch_failed", "skipped", "refilled", "trials"]


def run_counters(events: DataFrame) -> DataFrame:
    """The twelve counters of each run from its event log (run_id, kind, level, n) and its status: failed if it crashed, ok without errors or failed fetches, partial if anything came, else failed."""
    sums = [F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(k) for k in COUNTERS]
    c = events.groupBy("run_id").agg(*sums, F.count_if(F.col("level") == "error").alias("errors"), F.count_if(F.col("level") == "warning").alias("warnings"), F.bool_or(F.col("kind") == "crash").alias("_crash"))
    status = F.when(F.col("_crash"), "failed").when((F.col("errors") == 0) & (F.col("fetch_failed") == 0), "ok").when((F.col("registrations") > 0) | (F.col("fetched") > 0), "partial").otherwise("failed")
    return c.withColumn("status", status).drop("_crash")


def prep_status(parses: DataFrame) -> DataFrame:
    """Per engine and status: documents, pages, seconds, seconds a page, blocks to review."""
    return parses.groupBy("engine", "status").agg(F.count(F.lit(1)).alias("n"), F.sum("pages").alias("pages"), F.sum("seconds").alias("seconds"), F.when(F.sum("pages") > 0, F.sum("seconds") / F.sum("pages")).alias("sec_per_page"), F.sum("needs_review").alias("needs_review"))


def status_cells(registrations: DataFrame, documents: DataFrame, agencies: list[str]) -> DataFrame:
    """Program by agency: `first brand +n | earliest ids | fetched/all`. registrations: program_id, agency, reg_id, brand, approved; documents: program_id, agency, status."""
    order = F.struct(F.coalesce("approved", F.lit("9999")), "reg_id")
    r = registrations.groupBy("program_id", "agency").agg(F.min_by("brand", order).alias("_b"), (F.count(F.lit(1)) - 1).alias("_n"), F.min("approved").alias("_d"))
    d = documents.groupBy("program_id", "agency").agg(F.count_if(F.col("status") == "fetched").alias("_f"), F.count(F.lit(1)).alias("_all"))
    more = F.when(F.col("_n") > 0, F.concat(F.lit(" +"), F.col("_n").cast("string"))).otherwise("")
    cell = F.concat(F.coalesce("_b", F.lit("-")), more, F.lit(" | "), F.coalesce("_d", F.lit("-")), F.lit(" | "), F.coalesce("_f", F.lit(0)).cast("string"), F.lit("/"), F.coalesce("_all", F.lit(0)).cast("string"))
    j = r.join(d, ["program_id", "agency"], "full_outer").withColumn("cell", F.coalesce(cell, F.lit("-")))
    return j.groupBy("program_id").pivot("agency", agencies).agg(F.first("cell"))


def ranked_first(hits: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return hits.withColumn("_r", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("_r = 1").drop("_r")
