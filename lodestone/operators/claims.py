"""Evidence for an answer: blocks of hits, numbered segments, packing to a budget, and claims checked against what they cite."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from lodestone.functions import text as X
from lodestone.operators.shared import task_count

#: Kinds of claims.
KINDS = ["fact", "interpretation", "applicant_position", "regulator_position"]
MOST_NAMES = 10_000  # names that are broadcast to the claims
RULE_LINE = r"^\|[\s|:-]+\|?$"


def blocks(hits: DataFrame) -> DataFrame:
    """One block per search and parent (or chunk, without a parent), in the order of its first hit.

    hits: search, rank, chunk_id, parent_key, product, document_id, score, needs_review, speaker, text. Speakers come in the order first heard."""
    key = F.coalesce(F.concat(F.lit("p:"), "parent_key"), F.concat(F.lit("c:"), F.col("chunk_id").cast("string")))
    first = lambda c: F.min_by(c, "rank").alias(c)
    heard = F.transform(F.array_sort(F.collect_list(F.when(F.col("speaker") != "", F.struct("rank", "speaker")))), lambda x: x["speaker"])
    chunks = F.transform(F.array_sort(F.collect_list(F.struct("rank", "chunk_id"))), lambda x: x["chunk_id"])
    grouped = hits.withColumn("block_key", key).groupBy("search", "block_key").agg(F.min("rank").alias("first_rank"), first("product"), first("document_id"), first("text"), F.max("score").alias("score"), F.bool_or(F.coalesce("needs_review", F.lit(False))).alias("needs_review"), F.array_distinct(heard).alias("speakers"), chunks.alias("chunk_ids"))
    return grouped.withColumn("block_id", F.concat(F.lit("E"), F.row_number().over(W.partitionBy("search").orderBy("first_rank", "block_key")).cast("string")))


def segments(numbered: DataFrame) -> DataFrame:
    """Lines of blocks with offsets; lines that are neither blank nor table rules get S1, S2 ... through all blocks of a search.

    numbered: search, pos (order of the block), block_id, text."""
    lines = numbered.select("search", "pos", "block_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    before = W.partitionBy("search", "pos", "block_id").orderBy("line_no").rowsBetween(W.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("line") + 1).over(before), F.lit(0))
    shown = lines.withColumn("start", start.cast("long")).withColumn("end", (start + F.length("line")).cast("long")).filter(F.trim("line") != "")
    counts = F.when(~F.col("line").rlike(RULE_LINE), 1)
    n = F.count(counts).over(W.partitionBy("search").orderBy("pos", "line_no").rowsBetween(W.unboundedPreceding, 0))
    return shown.withColumn("sid", F.when(counts.isNotNull(), F.concat(F.lit("S"), n.cast("string"))))


def round_robin(blocks_: DataFrame, budget: int) -> DataFrame:
    """Adds `turn` (first blocks of all products, then second ones ...; products in the order first met) and `admitted`: whole blocks
    while the budget holds; a block too large is passed over and later ones are still tried. blocks_: search, first_rank, product, cost.

    Only this budget needs a fold; it runs over one search's blocks (a page of hits) inside one expression."""
    product = F.coalesce("product", F.lit(""))
    met = F.min("first_rank").over(W.partitionBy("search", product))
    nth = F.row_number().over(W.partitionBy("search", product).orderBy("first_rank"))
    ordered = blocks_.withColumn("_met", met).withColumn("_nth", nth).withColumn("turn", F.row_number().over(W.partitionBy("search").orderBy("_nth", "_met")))
    items = ordered.groupBy("search").agg(F.array_sort(F.collect_list(F.struct("turn", F.col("cost").cast("long").alias("cost")))).alias("_a"))
    zero = F.struct(F.lit(0).cast("long").alias("used"), F.array().cast("array<int>").alias("kept"))
    step = lambda a, x: F.when(a["used"] + x["cost"] <= budget, F.struct((a["used"] + x["cost"]).alias("used"), F.array_append(a["kept"], x["turn"]).alias("kept"))).otherwise(a)
    kept = items.select("search", F.aggregate("_a", zero, step)["kept"].alias("_kept"))
    return ordered.join(kept, "search").withColumn("admitted", F.array_contains("_kept", F.col("turn"))).drop("_met", "_nth", "_kept")


def prompt_cost(blocks_: DataFrame, most_ids: int = 500) -> DataFrame:
    """blocks_ with `cost`, what a block adds to a prompt: its text, its headings and, per numbered line, the id in the text and in the reply's schema.

    blocks_: search, first_rank, product, text, section (heading path as text), n_lines (numbered lines). Costs are tokens of X.prompt_tokens; the ids count in full, as if
    the schema listed them all, so a prompt within its budget stays so when the list becomes a pattern (beyond most_ids)."""
    ids = F.col("n_lines") * 4
    return blocks_.withColumn("cost", X.prompt_tokens(F.col("text")) + X.prompt_tokens(F.coalesce("section", F.lit(""))) + ids + F.least(ids, F.lit(4 * most_ids)))


def prompt_pack(blocks_: DataFrame, questions: DataFrame, budget: int, overhead: int, most_ids: int = 500) -> DataFrame:
    """Blocks with `admitted` and a `reason` for those left out: products take turns, whole blocks only, within what the question, the instructions and the empty
    schema (`overhead`) leave of the budget; a block too large is passed over and later ones are still tried. questions: search, question."""
    return within_budget(prompt_cost(blocks_, most_ids), questions, budget, overhead)


def within_budget(priced: DataFrame, questions: DataFrame, budget: int, overhead: int) -> DataFrame:
    """`prompt_pack` of blocks that have their `cost`; whoever needs no texts drops them before.

    Blocks are dealt by search over as many partitions as they fill with a million each, sorted by turn and read in one stream that holds no more than what is used so far."""
    base = questions.select("search", (F.lit(overhead) + X.prompt_tokens(F.col("question"))).cast("long").alias("_base"))
    dealt = priced.repartition(task_count(priced.count()), "search").join(base, "search")
    # The question's own cost is a first item that always comes in: it is taken off by a budget per search.
    own = W.partitionBy("search", F.coalesce("product", F.lit(""))).orderBy("first_rank")
    met = dealt.withColumns({"_met": F.min("first_rank").over(own.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)), "_nth": F.row_number().over(own)})
    ordered = met.withColumn("turn", F.row_number().over(W.partitionBy("search").orderBy("_nth", "_met"))).drop("_met", "_nth").sortWithinPartitions("search", "turn")

    def run(batches):
        import pyarrow as pa

        used = None
        for b in batches:
            admitted = []
            for turn, cost, base in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in ("turn", "cost", "_base"))):
                used = base if turn == 1 else used
                admitted.append(used is not None and cost is not None and used + cost <= budget)
                used = used + cost if admitted[-1] else used
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(admitted, pa.bool_())], [*b.schema.names, "admitted"])

    out = ordered.mapInArrow(run, StructType([*ordered.schema.fields, StructField("admitted", BooleanType())]))
    return out.withColumn("reason", F.when(~F.col("admitted"), "whole_block_exceeds_input_budget")).drop("_base")


def mentions(claims: DataFrame, names: DataFrame) -> DataFrame:
    """(claim_id, mentioned, plain): the products whose names the text holds and the text without these names. names: product, pattern."""
    few = F.broadcast(names) if names.limit(MOST_NAMES + 1).count() <= MOST_NAMES else names
    found = claims.select("claim_id", "text").join(few, F.expr("regexp_like(text, pattern)"), "left")
    per = found.groupBy("claim_id", "text").agg(F.array_sort(F.collect_set("product")).alias("mentioned"), F.array_sort(F.collect_set("pattern")).alias("_p"))
    return per.select("claim_id", "mentioned", F.aggregate("_p", F.col("text"), lambda t, p: F.regexp_replace(t, p, F.lit(" "))).alias("plain"))


def check(claims: DataFrame, spans: DataFrame, names: DataFrame) -> DataFrame:
    """Verdict of each claim: `accepted` or the first reason that fails, and the numbers that no cited span holds.

    claims: claim_id, answer_id, text, kind, products (array), spans (array of span ids); spans: answer_id, sid, product (null: none), text,
    needs_review; names (a small configured table): product, pattern. Numbers are compared as printed, in composed form."""
    shape = F.col("text").isNull() | (F.trim("text") == "") | ~F.coalesce(F.col("kind").isin(KINDS), F.lit(False)) | F.col("products").isNull() | F.col("spans").isNull() | (F.size("spans") == 0)
    cited = claims.select("claim_id", "answer_id", F.explode(F.array_distinct("spans")).alias("sid"))
    met = cited.join(spans.select("answer_id", "sid", F.lit(True).alias("_known"), F.col("product").alias("_product"), F.col("text").alias("_quote"), "needs_review"), ["answer_id", "sid"], "left")
    per = met.groupBy("claim_id").agg(F.bool_or(F.col("_known").isNull()).alias("_unknown"), F.collect_set("_product").alias("_cited"), F.array_distinct(F.flatten(F.collect_list(X.numbers(X.composed(F.col("_quote")))))).alias("_held"), F.bool_or(F.coalesce("needs_review", F.lit(False))).alias("needs_review"))
    named = mentions(claims, names)
    j = claims.join(per, "claim_id", "left").join(named, "claim_id", "left")
    missing = F.array_sort(F.array_except(X.numbers(X.composed(F.col("plain"))), F.coalesce("_held", F.array().cast("array<string>"))))
    outside = lambda a, b: F.size(F.array_except(a, b)) > 0
    verdict = (
        F.when(shape, "invalid_claim_shape")
        .when(F.coalesce("_unknown", F.lit(True)), "unknown_span_id")
        .when(outside(F.col("products"), F.col("_cited")), "product_not_in_cited_sources")
        .when((F.size("_cited") > 0) & (F.size("products") == 0), "product_scope_missing")
        .when(outside(F.col("mentioned"), F.col("products")), "named_product_not_declared")
        .when(F.size(missing) > 0, "number_not_in_cited_sources")
        .otherwise("accepted")
    )
    return j.select("answer_id", "claim_id", verdict.alias("verdict"), F.when(verdict == "number_not_in_cited_sources", missing).otherwise(F.array().cast("array<string>")).alias("missing"), F.coalesce("needs_review", F.lit(False)).alias("needs_review"))


def answer_status(n_sources: Column, n_accepted: Column, n_gaps: Column, failed: Column, dry_run: Column) -> Column:
    """What an answer came to."""
    return F.when(dry_run, "dry_run").when(failed, "error").when((n_sources == 0) | (n_accepted == 0), "not_found").when(n_gaps > 0, "partial").otherwise("answered")


def rendered(kind: Column, text: Column, spans: Column) -> Column:
    """A line of the report: a mark for the kind, the text, and the spans cited."""
    mark = F.when(kind == "interpretation", "Interpretation: ").when(kind == "applicant_position", "(Applicant) ").when(kind == "regulator_position", "(Regulator) ").otherwise("")
    return F.concat(mark, text, F.lit(" ["), F.array_join(spans, ", "), F.lit("]"))


def source_line(block: Column) -> Column:
    """Where a block of evidence comes from: [id] agency, product, type, title and pages, then the last two headings; a mark where it needs review.

    block: a struct of block_id, agency, program_id, doc_type, title, pages (array), section_path (array), needs_review."""
    b = block
    pages = F.when(F.size(b["pages"]) == 1, F.concat(F.lit("p."), b["pages"][0].cast("string"))).when(F.size(b["pages"]) > 1, F.concat(F.lit("p."), b["pages"][0].cast("string"), F.lit("-"), F.element_at(b["pages"], -1).cast("string")))
    some = lambda c: F.when(c != "", c)
    head = F.concat_ws(" · ", F.upper(some(b["agency"])), F.coalesce(some(b["program_id"]), F.lit("guidance")), some(b["doc_type"]), F.concat(F.lit('"'), some(b["title"]), F.lit('"')), pages)
    path = F.coalesce(b["section_path"], F.array().cast("array<string>"))
    tail = F.array_join(F.when(F.size(path) > 2, F.slice(path, -2, 2)).otherwise(path), " > ")
    return F.concat(F.lit("["), b["block_id"], F.lit("] "), head, F.when(tail != "", F.concat(F.lit(" · "), tail)).otherwise(""), F.when(F.coalesce(b["needs_review"], F.lit(False)), " (needs review)").otherwise(""))


def report(claims: DataFrame, gaps: DataFrame, blocks_: DataFrame) -> DataFrame:
    """(answer_id, text): the accepted claims with the blocks they cite, gaps each once, how many claims were rejected, and the sources cited, in the blocks' order.

    claims: answer_id, ord, verdict, kind, text, block_ids (array), needs_review; gaps: answer_id, ord, gap; blocks_: answer_id, ord, and what source_line takes. An answer without accepted claims says so."""
    none = F.array().cast("array<string>")
    ok = claims.filter("verdict = 'accepted'")
    line = F.concat(F.lit("- "), rendered(F.col("kind"), F.col("text"), F.array_distinct("block_ids")), F.when(F.coalesce("needs_review", F.lit(False)), " (source needs review)").otherwise(""))
    ordered = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("ord", c.alias("_l")))), lambda x: x["_l"])
    said = ok.groupBy("answer_id").agg(ordered(line).alias("_claims"))
    open_ = gaps.filter(F.trim("gap") != "").groupBy("answer_id", "gap").agg(F.min("ord").alias("ord")).groupBy("answer_id").agg(ordered(F.concat(F.lit("- "), F.col("gap"))).alias("_gaps"))
    bad = claims.groupBy("answer_id").agg(F.count_if(F.col("verdict") != "accepted").alias("_bad"))
    used = ok.select("answer_id", F.explode("block_ids").alias("block_id")).distinct()
    whole = F.struct("block_id", "agency", "program_id", "doc_type", "title", "pages", "section_path", "needs_review")
    sources = blocks_.join(used, ["answer_id", "block_id"], "left_semi").groupBy("answer_id").agg(ordered(source_line(whole)).alias("_sources"))
    j = claims.select("answer_id").union(gaps.select("answer_id")).distinct()
    for part in (said, open_, bad, sources):
        j = j.join(part, "answer_id", "left")
    under = lambda title, c: F.when(F.size(F.coalesce(c, none)) > 0, F.concat(F.array(F.lit(""), F.lit(title)), F.coalesce(c, none))).otherwise(none)
    rejected = F.when(F.coalesce("_bad", F.lit(0)) > 0, F.array(F.lit(""), F.concat(F.lit("Claims rejected by the check: "), F.col("_bad").cast("string")))).otherwise(none)
    lines = F.concat(F.coalesce("_claims", F.array(F.lit("The evidence found does not support an answer."))), under("Open points:", F.col("_gaps")), rejected, under("Sources:", F.col("_sources")))
    return j.select("answer_id", F.array_join(lines, "\n").alias("text"))


def contract(span_ids: list[str], products: list[str], most: int = 500) -> dict:
    """JSON schema of a reply: span ids as an enumeration up to `most`, beyond as a pattern; products as an enumeration."""
    ids = {"enum": span_ids} if len(span_ids) <= most else {"pattern": "^S[0-9]+$"}
    claim = {"text": {"type": "string"}, "kind": {"enum": KINDS}, "products": {"type": "array", "items": {"enum": products} if products else {"type": "string"}}, "citation_span_ids": {"type": "array", "minItems": 1, "items": {"type": "string", **ids}}}
    return {"type": "object", "required": ["claims", "gaps"], "properties": {"claims": {"type": "array", "items": {"type": "object", "required": sorted(claim), "properties": claim}}, "gaps": {"type": "array", "items": {"type": "string"}}}}
