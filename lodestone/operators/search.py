"""Retrieval as one plan for many questions: route, expand, plan searches, score, merge, fetch parents.

A question becomes rows of searches; searches meet the chunks in blocks (lodestone.operators.vectors), and the sparse part is scored for the dense
shortlist alone. Filters are settled once per distinct set of them and group of chunks, not per search and chunk.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.functions import text as X
from lodestone.operators.relational import latest
from lodestone.operators.vectors import dense_top

SPARSE_WEIGHT = 0.3  # fixed value
MOST_FILTERS = 20_000  # distinct filter sets without program and agency that are broadcast


def shortlist_size(k: int) -> int:
    return max(200, 20 * k)


@dataclass(frozen=True)
class Routing:
    """The configured words of a router, small by nature: patterns in order, not data."""

    products: list[tuple[str, str]] = field(default_factory=list)  # pattern, program
    agencies: list[tuple[str, str]] = field(default_factory=list)  # pattern, agency
    guidance: str = "(?i)guidance|guideline"
    all_products: str = r"(?i)each product|all products"
    reference: str = "(?i)originator|reference product's|pivotal"
    doc_types: list[tuple[str, list[str]]] = field(default_factory=list)
    label_sections: list[tuple[str, str]] = field(default_factory=list)
    biosimilars: list[str] = field(default_factory=list)
    references: list[str] = field(default_factory=list)


def _found(text: Column, pairs: list[tuple[str, str]]) -> Column:
    """Values whose pattern is in the text, in order, each once."""
    if not pairs:
        return F.array().cast("array<string>")
    return F.array_distinct(F.array_compact(F.array(*[F.when(text.rlike(p), F.lit(v)) for p, v in pairs])))


def strings(values: list[str]) -> Column:
    return F.array(*map(F.lit, values)).cast("array<string>")


def routed(questions: DataFrame, r: Routing) -> DataFrame:
    """Adds products, agency (if exactly one is named), guidance, reference, doc_types and label_sections to questions (qid, text)."""
    q = F.col("text")
    named = _found(q, r.products)
    wide = F.when(q.rlike(r.all_products), F.array_union(named, strings(r.biosimilars))).otherwise(named)
    agencies = _found(q, r.agencies)
    types = [(p, t) for p, ts in r.doc_types for t in ts]
    out = questions.withColumn("_p", wide).withColumn("_r", F.arrays_overlap("_p", strings(r.references)))
    out = out.withColumn("reference", F.col("_r") | q.rlike(r.reference))
    # A product question that asks for the originator searches it too.
    more = F.col("reference") & ~F.col("_r") & (F.size("_p") > 0)
    out = out.withColumn("products", F.when(more, F.array_union("_p", strings(r.references))).otherwise(F.col("_p")))
    out = out.withColumn("agency", F.when(F.size(agencies) == 1, F.get(agencies, F.lit(0)))).withColumn("guidance", q.rlike(r.guidance)).withColumn("doc_types", _found(q, types))
    secs = F.when(F.array_contains("doc_types", "label"), _found(q, r.label_sections)).otherwise(F.array().cast("array<string>"))
    return out.withColumn("label_sections", secs).drop("_p", "_r")


SEARCH = "product string, program_id string, agency string, guidance boolean, excluded array<string>, doc_types array<string>, label_sections array<string>"


def planned(routes: DataFrame, references: list[str], mode: str = "routed") -> DataFrame:
    """One row per search of a question: qid, ord and the filters. No signal, or mode `open`: one search over all. Products: one each, and one over
    guidance if rules are asked for. Otherwise one. Each but the guidance one may bring a second search within the document types named."""
    none, false = F.lit(None).cast("string"), F.lit(False)
    empty = F.array().cast("array<string>")
    out = F.when(F.col("reference"), empty).otherwise(strings(references))

    def search(product, program, agency, guidance, excluded, types, secs) -> Column:
        return F.struct(*[c.cast(t).alias(n) for c, (n, t) in zip((product, program, agency, guidance, excluded, types, secs), [x.split(" ") for x in SEARCH.split(", ")])])

    open_ = search(none, none, none, false, empty, empty, empty)
    typed = F.size("doc_types") > 0
    signal = (F.size("products") > 0) | F.col("agency").isNotNull() | F.col("guidance") | typed
    plain = F.transform("products", lambda p: search(p, p, F.col("agency"), false, out, empty, empty))
    second = F.transform("products", lambda p: search(p, p, F.col("agency"), false, out, F.col("doc_types"), F.col("label_sections")))
    both = F.when(typed, F.flatten(F.zip_with(plain, second, lambda a, b: F.array(a, b)))).otherwise(plain)
    rules = F.when(F.col("guidance"), F.array(search(none, none, F.col("agency"), F.lit(True), out, empty, empty))).otherwise(F.array().cast(f"array<struct<{SEARCH.replace(' ', ':').replace(',:', ',')}>>"))
    scope = search(none, none, F.col("agency"), F.col("guidance"), out, empty, empty)
    one = F.when(typed, F.array(scope, search(none, none, F.col("agency"), false, out, F.col("doc_types"), F.col("label_sections")))).otherwise(F.array(scope))
    plan = F.when(F.lit(mode == "open") | ~signal, F.array(open_)).when(F.size("products") > 0, F.concat(both, rules)).otherwise(one)
    return routes.select("qid", F.posexplode(plan).alias("ord", "_s")).select("qid", "ord", "_s.*")


def allowed(chunk: str = "c", search: str = "s") -> Column:
    """Whether a chunk passes a search's filters; a chunk of no program is never an excluded one."""
    c, s = (lambda n: F.col(f"{chunk}.{n}")), (lambda n: F.col(f"{search}.{n}"))
    same = lambda n: s(n).isNull() | (s(n) == F.coalesce(c(n), F.lit("")))
    free = c("program_id").isNull() | ~F.array_contains(s("excluded"), F.coalesce(c("program_id"), F.lit("")))
    types = (F.size(s("doc_types")) == 0) | F.array_contains(s("doc_types"), F.coalesce(c("doc_type"), F.lit("")))
    return same("program_id") & same("agency") & (~s("guidance") | (c("doc_kind") == "guidance")) & free & types


#: Document types whose chunks a label-section rule narrows.
LABEL_TYPES = ["label", "product_information", "product_monograph"]


def in_label_section(doc_type: Column, path: Column, patterns: Column) -> Column:
    """Chunks of other types pass; a label chunk needs one of the patterns in its heading path."""
    joined = F.array_join(path, " > ")
    return (F.size(patterns) == 0) | ~F.coalesce(doc_type.isin(LABEL_TYPES), F.lit(False)) | F.exists(patterns, lambda p: F.regexp_like(joined, F.concat(F.lit("(?i)"), p)))


def unless_empty(rows: DataFrame, keys: list[str], narrow: Column) -> DataFrame:
    """Applies a filter per key only where something is left."""
    some = F.max(narrow).over(W.partitionBy(*keys))
    return rows.withColumn("_in", narrow).withColumn("_some", some).filter("_in OR NOT _some").drop("_in", "_some")


def sparse_scores(shortlist: DataFrame, chunk_tokens: DataFrame, query_tokens: DataFrame) -> DataFrame:
    """(search, chunk_id, sparse): sums of products of the weights both sides give a token, for shortlisted pairs only.

    chunk_tokens: chunk_id, token, w; query_tokens: search, token, w. The shortlist bounds the pairs before tokens meet."""
    pairs = shortlist.select("search", "chunk_id").join(chunk_tokens, "chunk_id")
    met = pairs.join(query_tokens.withColumnRenamed("w", "_w"), ["search", "token"])
    return met.groupBy("search", "chunk_id").agg(F.sum(F.col("w") * F.col("_w")).alias("sparse"))


def hybrid(shortlist: DataFrame, sparse: DataFrame, k: int, score: Column) -> DataFrame:
    """The best k of a shortlist by a combined score, ties to the larger chunk_id."""
    both = shortlist.drop("rank").join(sparse, ["search", "chunk_id"], "left").withColumn("score", score)
    w = W.partitionBy("search").orderBy(F.desc("score"), F.desc("chunk_id"))
    return both.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("search", "chunk_id", "score", "rank")


def reranked(candidates: DataFrame, scores: DataFrame, k: int, parts: int | None = None) -> DataFrame:
    """The best k candidates (search, chunk_id, rank) by a second scorer's (search, chunk_id, score); equal scores keep their first order.

    parts: how many partitions hold the pairs, where the session's are too few for them."""
    c, s = candidates.withColumnRenamed("rank", "_was").drop("score"), scores
    if parts:
        c, s = (d.repartition(parts, "search", "chunk_id") for d in (c, s))
    j = c.join(s, ["search", "chunk_id"])
    if parts:
        j = j.repartition(parts, "search")
    w = W.partitionBy("search").orderBy(F.desc("score"), "_was")
    return j.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).drop("_was")


def merged(hits: DataFrame) -> DataFrame:
    """All hits of a question's searches (qid, ord, rank, chunk_id, ...), each chunk once, as first found; `place` numbers what stays."""
    once = latest(hits, ["qid", "chunk_id"], F.col("ord"), F.col("rank"))
    return once.withColumn("place", F.row_number().over(W.partitionBy("qid").orderBy("ord", "rank")))


def with_parents(hits: DataFrame, chunks: DataFrame, parents: DataFrame) -> DataFrame:
    """Text that is read for a hit: its parent's, by index document and parent key, or the chunk's own."""
    c = hits.join(chunks.select("chunk_id", "index_document_id", "parent_key", F.col("text").alias("_own"), F.col("pages").alias("_pages")), "chunk_id")
    p = parents.select("index_document_id", "parent_key", F.col("text").alias("_of"), F.col("pages").alias("_of_pages"))
    return c.join(p, ["index_document_id", "parent_key"], "left").withColumn("parent_text", F.coalesce("_of", "_own")).withColumn("parent_pages", F.coalesce("_of_pages", "_pages")).drop("_of", "_own", "_of_pages", "_pages")


def retrieve(questions: DataFrame, vectors: DataFrame, chunks: DataFrame, parents: DataFrame, chunk_tokens: DataFrame, query_tokens: DataFrame, routing: Routing, k: int = 10, mode: str = "routed", score: Column | None = None) -> DataFrame:
    """Route, plan, search, add typed searches, merge and fetch parents for all questions in one plan.

    questions: qid, text; vectors: qid, q; chunks: chunk_id, v, and the filter columns, index_document_id, parent_key, section_path, text, pages; token tables as
    in sparse_scores with qid for search. The filter columns of chunks take few distinct values, so a search's filters are settled on these groups and each
    search brings the groups it may see."""
    plan = planned(routed(questions, routing), routing.references, mode).withColumn("search", F.concat_ws(":", F.col("qid").cast("string"), F.col("ord").cast("string")))
    keys = ["program_id", "agency", "doc_kind", "doc_type"]
    path = F.array_join(F.coalesce("section_path", F.array().cast("array<string>")), "\x1f")
    shown = chunks.withColumn("_path", F.when(F.col("doc_type").isin(LABEL_TYPES), path).otherwise(""))
    shown = shown.withColumn("g", F.xxhash64(*[F.coalesce(c, F.lit("\x00")) for c in keys], "_path"))
    groups = shown.select("g", *keys, "_path").distinct()
    plan = plan.withColumn("fid", F.xxhash64(F.to_json(F.struct(*FILTERS))))
    queries = plan.join(visible(groups, plan.select("fid", *FILTERS).distinct()), "fid", "left").join(vectors, "qid").select("search", "q", F.coalesce("allow", F.array().cast("array<long>")).alias("allow"))
    short = dense_top(shown, queries, shortlist_size(k))
    tokens = plan.select("search", "qid").join(query_tokens, "qid").drop("qid")
    total = score if score is not None else F.col("score") + SPARSE_WEIGHT * F.coalesce("sparse", F.lit(0.0))
    hits = hybrid(short, sparse_scores(short, chunk_tokens, tokens), k, total)
    placed = merged(hits.join(plan.select("search", "qid", "ord", "product"), "search"))
    return with_parents(placed, shown, parents)


FILTERS = ["program_id", "agency", "guidance", "excluded", "doc_types", "label_sections"]


def visible(groups: DataFrame, filters: DataFrame) -> DataFrame:
    """(fid, allow): the groups of chunks that each set of filters lets through, as one array; for many groups sum up `met_filters` instead."""
    return unless_empty(met_filters(groups, filters), ["fid"], F.col("narrow")).groupBy("fid").agg(F.collect_set("g").alias("allow"))


def met_filters(groups: DataFrame, filters: DataFrame) -> DataFrame:
    """(fid, g, narrow): the groups of chunks that each set of filters lets through before its label sections narrow them, one row each. Where no group of a set is narrow, all count.

    Program and agency are equality joins. Sets that name neither are few (combinations of configured words) and meet all groups; they are broadcast after a count."""
    found = None
    for on in (["program_id", "agency"], ["program_id"], ["agency"], []):
        part = filters
        for c in ("program_id", "agency"):
            part = part.filter(F.col(c).isNotNull() if c in on else F.col(c).isNull())
        c, s = groups.alias("c"), part.alias("s")
        if on:
            rule = allowed()
            for k in on:
                rule = rule & (F.col(f"c.{k}") == F.col(f"s.{k}"))
            met = c.join(s, rule)
        else:
            met = c.join(F.broadcast(s) if part.limit(MOST_FILTERS + 1).count() <= MOST_FILTERS else s, allowed())
        narrow = in_label_section(F.col("c.doc_type"), F.split(F.col("c._path"), "\x1f"), F.col("s.label_sections"))
        rows = met.select(F.col("s.fid").alias("fid"), F.col("c.g").alias("g"), narrow.alias("narrow"))
        found = rows if found is None else found.unionByName(rows)
    return found
