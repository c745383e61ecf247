"""Which documents to process: skip rules, latest labels, near-duplicates, purposes of originator documents, downloads and refills."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.operators.shared import removed, written

LABELS = ["label", "product_information", "product_monograph"]  # fixed values
#: Fixed patterns: procedure numbers, and scopes that change an indication, form or route.
PROCEDURE = r"(?:EMA/)?(VR/\d{10}|(?:II|X|P46|IB|IA|IAIN|R|T|N)/\d{3,5}(?:/G)?)"
SCOPE = r"(?i)extension of indication|C\.I\.6|new therapeutic indication|line extension|new (?:pharmaceutical form|strength|route)|addition of a new (?:strength|pharmaceutical form|route)"
TITLE = r"-(II|X|P46)-0*(\d+)(-G)?\b|(VR)-(\d{10})"


def skip_reason(doc_type: Column, path: Column, readable: Column) -> Column:
    """Why a document is left out before anything is read; null: it is processed."""
    low = F.lower(path)
    return F.when(doc_type == "review_index", "index_page").when(~low.rlike(r"\.(pdf|html|htm)$"), "not_pdf_or_html").when(low.endswith(".pdf") & ~readable, "unreadable_pdf")


def shown_date(doc_date: Column, published: Column, decided: Column) -> Column:
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in (doc_date, published, decided)], F.lit(""))


def superseded(labels: DataFrame) -> DataFrame:
    """labels (doc_id, agency, registration, date) with `latest` of their registration: the last by date, of equal dates the larger id; without dates the larger id."""
    one = F.coalesce(F.col("registration").cast("string"), F.concat(F.lit("doc"), F.col("doc_id").cast("string")))
    w = W.partitionBy("agency", "_r")
    last = F.max_by("doc_id", F.struct("date", "doc_id")).over(w)
    return labels.withColumn("_r", one).withColumn("latest", last).drop("_r").withColumn("superseded", F.col("doc_id") != F.col("latest"))


def elected(pairs: DataFrame, order: DataFrame) -> DataFrame:
    """(doc_id, representative): in the given order a document is a duplicate of its first earlier representative, else a representative itself.

    pairs: a, b (either way round); order: doc_id, rank (unique). Rounds: who has no undecided earlier neighbour is decided, from the front of all
    chains at once; each round is one join, and no component is gathered. Documents without pairs are not returned."""
    r = order.select("doc_id", "rank")
    both = pairs.select("a", "b").join(r.select(F.col("doc_id").alias("a"), F.col("rank").alias("_x")), "a").join(r.select(F.col("doc_id").alias("b"), F.col("rank").alias("_y")), "b")
    ahead = F.col("_x") < F.col("_y")
    edges = both.select(F.when(ahead, F.col("b")).otherwise(F.col("a")).alias("doc_id"), F.when(ahead, F.col("a")).otherwise(F.col("b")).alias("before"), F.least("_x", "_y").alias("rank")).distinct()
    edges = written(edges)
    docs = edges.select("doc_id").union(edges.select("before")).distinct()
    none = F.lit(None).cast(dict(edges.dtypes)["doc_id"])
    state = written(docs.select("doc_id", none.alias("representative")))
    while True:
        known = state.select(F.col("doc_id").alias("before"), F.col("representative").alias("_of"))
        seen = edges.join(known, "before")
        rep = F.when(F.col("_of") == F.col("before"), F.struct("rank", F.col("before").alias("id")))
        open_ = F.when(F.col("_of").isNull(), F.col("rank"))
        per = seen.groupBy("doc_id").agg(F.min(rep).alias("_rep"), F.min(open_).alias("_open"))
        # Decided: no earlier neighbour is open, or a representative comes before the first open one.
        sure = F.col("_open").isNull() | F.coalesce(F.col("_rep.rank") < F.col("_open"), F.lit(False))
        new = written(state.join(per, "doc_id", "left").select("doc_id", F.coalesce("representative", F.when(sure, F.coalesce("_rep.id", "doc_id"))).alias("representative")))
        removed(state)
        if new.filter("representative IS NULL").isEmpty():
            removed(edges)
            return new
        state = new


def elected_members(member: DataFrame, between: DataFrame, order: DataFrame) -> DataFrame:
    """(doc_id, representative) of all documents from classes of equal sets (near_duplicates.near_classes): elected among the classes' first documents, then handed on."""
    verdict = elected(between.select("a", "b"), order).withColumnRenamed("doc_id", "rep")
    return member.join(verdict, "rep", "left").select("doc_id", F.coalesce("representative", "rep").alias("representative"))


def summary(actions: DataFrame) -> DataFrame:
    """Counts by action and the reason before its bracket."""
    return actions.groupBy("action", F.split("reason", r" \(")[0].alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def carried_scopes(lines: DataFrame) -> DataFrame:
    """(doc, procedure, scope): rows of procedure tables (doc, pos, line) joined under the last procedure number above them; a number that comes again goes on."""
    number = F.nullif(F.regexp_extract("line", PROCEDURE, 1), F.lit(""))
    w = W.partitionBy("doc").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    under = lines.withColumn("procedure", F.last(number, ignorenulls=True).over(w)).filter("procedure IS NOT NULL")
    return under.groupBy("doc", "procedure").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), " ").alias("scope"))


def title_procedure(title: Column) -> Column:
    """Procedure number that a document's title holds; null for an initial report."""
    g = lambda i: F.regexp_extract(title, TITLE, i)
    kind, num, tail = g(1), g(2), F.when(g(3) != "", "/G").otherwise("")
    return F.when(g(4) != "", F.concat(F.lit("VR/"), g(5))).when(kind == "P46", F.concat(F.lit("P46/"), F.lpad(num, 3, "0"))).when(kind != "", F.concat(kind, F.lit("/"), F.lpad(num, 4, "0"), tail))


def purposes(docs: DataFrame, scopes: DataFrame) -> DataFrame:
    """docs (doc_id, doc_type, title) of an originator with the purposes they serve and why. scopes: procedure, scope."""
    j = docs.withColumn("procedure", title_procedure(F.coalesce("title", F.lit("")))).join(scopes.groupBy("procedure").agg(F.array_join(F.array_sort(F.collect_list("scope")), " ").alias("_s")), "procedure", "left")
    t = F.col("doc_type")
    lists = lambda *x: F.array(*map(F.lit, x)).cast("array<string>")
    report, first, change = t == "assessment_report", F.col("procedure").isNull(), F.coalesce(F.col("_s").rlike(SCOPE), F.lit(False))
    record, label, review = t.isin("approval_letter", "rds", "procedural_steps", "epar_overview"), t.isin(LABELS), t.isin("review", "sbd")
    out = F.when(report & first | review, lists("baseline_trials", "indication_history")).when(report & change | record, lists("indication_history")).when(label, lists("reference_label")).otherwise(lists())
    unchanged = F.concat(F.col("procedure"), F.lit(": not an indication change"), F.when(F.col("_s").isNull(), " (not in history)").otherwise(""))
    why = F.when(report & first, "initial assessment report").when(report & change, F.concat(F.col("procedure"), F.lit(": indication/form/route change"))).when(report, unchanged).when(review, "agency review of an application").when(record, "approval record").when(label, "originator label (latest kept by selection)").otherwise(F.concat(t, F.lit(": no reference purpose")))
    return j.select("doc_id", "doc_type", "procedure", out.alias("purposes"), why.alias("reason"))


def wanted(docs: DataFrame, versions: DataFrame, types: list[str] | None) -> DataFrame:
    """docs (doc_id, doc_type, is_index, status) with `wanted` and the new status: what is not wanted is skipped unless it has a version."""
    has = versions.select("doc_id").distinct().withColumn("_v", F.lit(True))
    want = F.lit(True) if types is None else F.col("doc_type").isin(types) | F.col("is_index")
    j = docs.join(has, "doc_id", "left").withColumn("wanted", want)
    return j.withColumn("status", F.when(F.col("wanted") | F.col("_v").isNotNull(), F.col("status")).otherwise("skipped")).drop("_v")


def html_instead_of_pdf(url: Column, content: Column) -> Column:
    """A page that came where a PDF was expected: blocked or moved."""
    expects = F.lower(url).endswith(".pdf") | F.contains(url, F.lit("/download"))
    head = F.lower(F.decode(F.substring(content, 1, 2000), "ISO-8859-1"))
    return expects & ~F.startswith(head, F.lit("%pdf")) & F.contains(head, F.lit("<html"))


def refill(docs: DataFrame, handled: DataFrame, versions: DataFrame, stored: DataFrame, programs: DataFrame, guidance: bool) -> DataFrame:
    """Known documents that no catalog listed in this run and whose newest version is not in the store.

    docs: doc_id, doc_kind, program_id, status; handled: doc_id; versions: doc_id, retrieved_at, id, path; stored: path; programs: program_id."""
    from lodestone.operators.relational import latest

    left = docs.filter("status != 'superseded'").join(handled.select("doc_id"), "doc_id", "left_anti")
    own = left.filter("doc_kind = 'product'").join(programs.select("program_id"), "program_id", "left_semi")
    scoped = own.unionByName(left.filter("doc_kind = 'guidance'")) if guidance else own
    there = latest(versions, ["doc_id"], F.desc("retrieved_at"), F.desc("id")).join(stored.select("path"), "path", "left_semi")
    return scoped.join(there.select("doc_id"), "doc_id", "left_anti")
