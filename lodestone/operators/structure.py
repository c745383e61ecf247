"""Structure of parsed documents: furniture, speakers, redactions, cell clean-up, routes and quality figures. All are Column expressions and group-bys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.functions import text as X

#: Fixed patterns: lines that belong to the page, not to the text.
FURNITURE = [
    r"^reference id:?\s*\d+$",
    r"^page \d+\s*(of|/)\s*\d+$",
    r"^\d{1,4}$",
    r"^[ivxlc]{1,6}$",
    r"^assessment report$",
    r"^assessment report\s+ema/\d+/\d{4}$",
    r"^ema/\d+/\d{4}$",
    r"^biosimilar multidisciplinary evaluation and review \(bmer\)$",
    r"^medicinal product no longer authori[sz]ed$",
    r"^contains nonbinding recommendations$",
    r"^draft\s*[-—–]\s*not for implementation$",
    r"^unclassified\s*/\s*non classifi[ée]$",
]
#: Fixed pattern: a page number at either edge.
EDGE_NUMBER = r"(?i)^(?:[ivxlc]{1,6}|\d{1,4})\s+(?=\S)|(?<=\S)\s+(?:[ivxlc]{1,6}|\d{1,4})$"
#: Fixed patterns: who speaks.
REGULATOR_SAYS = r"(?i)(reviewer'?s?\s+comment|this reviewer|the (review )?team|fda'?s assessment|the agency|chmp'?s? (comment|view|conclusion)|assessor'?s? comment|the committee)"
VERDICT = r"(?i)^(the\s+)?(applicant|sponsor|mah|company)\s+(has\s+)?(provid\w*|submit\w*|present\w*)\s+(adequate|sufficient|insufficient|inadequate|acceptable|appropriate)"
APPLICANT_SAYS = r"(?i)^(the\s+)?(applicant|sponsor|mah|company)('s)?\s+(state[sd]?|propos\w*|submit\w*|claim\w*|report\w*|assert\w*|provid\w*|conclud\w*|consider\w*|argu\w*|position)"
JUDGEMENT_HEADING = r"(?i)^(\d+\.)*\d+\.?\s+(discussion|conclusions?)\b|benefit.risk|\bchmp\b"
#: Document types with one speaker.
LABELS, REGULATOR_TYPES = ["label", "product_information", "product_monograph"], ["guidance", "approval_letter", "sbd", "rds", "epar_overview", "procedural_steps"]
#: Fixed patterns: redactions and cells.
REDACTION, CELL_MARK = r"(?i)\(b\)\s*\((4|6)\)|\bCCI\b|\[redacted\]", r"^\s*\(b\)\s*\((?:4|6)\)\s+(?=[-<>≤≥]?\d)"
DASH_ONLY, WRAP_HYPHEN = r"^[\s\-–—一ー‐]+$", r"(?<=[A-Za-z0-9])- (?=[A-Za-z0-9])"
NUMBER_CELL = r"^(?:[<>≤≥~±]?\s*-?\d[\d,]*(\.\d+)?\s*%?(\s*\(\s*-?\d[\d,]*(\.\d+)?\s*%?\s*\))?(\s*[,;]\s*-?\d[\d,]*(\.\d+)?%?)?|\d+\s*/\s*\d+|\(\s*-?\d[\d.]*%?\s*[,;]\s*-?\d[\d.]*%?\s*\)|\d{4}-\d{2}-\d{2})$"
#: Fixed pattern: sections that are kept in the parse but not worth retrieving.
SKIPPED = r"(?i)table of contents|^contents$|list of (abbreviations|tables|figures)|^abbreviations$|signature|financial disclosure|reviewers? (list|team)|^review team|^glossary$|recent major changes|full prescribing information: contents|application (information|data sheet)"
BOILERPLATE, TOC_LEADER = r"(?i)^\*?\s*Sections or subsections omitted from the full prescribing information", r"\.{6,}|…{3,}"


def spaced(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def repeat_key(text: Column) -> Column:
    """What repeats from page to page: without the page number, digits alike."""
    return F.regexp_replace(spaced(F.lower(F.regexp_replace(spaced(text), EDGE_NUMBER, ""))), r"\d+", "#")


def furniture(blocks: DataFrame) -> DataFrame:
    """blocks with `furniture`: by layer or label, margin numbers, fixed lines, or text that repeats in the top or bottom tenth of three and of 30 % of the pages.

    blocks: doc, page, label, layer, text, b and t (bottom and top), r (right edge), width, height."""
    t = spaced(F.col("text"))
    key = repeat_key(F.col("text"))
    at_edge = (F.col("t") > 0.9 * F.col("height")) | (F.col("b") < 0.1 * F.col("height"))
    pages = blocks.groupBy("doc").agg(F.count_distinct("page").alias("_pages"))
    seen = blocks.filter(at_edge).select("doc", "page", key.alias("_key")).distinct().groupBy("doc", "_key").agg(F.count(F.lit(1)).alias("_n"))
    repeated = seen.join(pages, "doc").filter(F.col("_n") >= F.greatest(F.lit(3.0), 0.3 * F.col("_pages"))).select("doc", "_key", F.lit(True).alias("_rep"))
    fixed = lambda s: s.rlike("(?i)" + "|".join(f"(?:{p})" for p in FURNITURE))
    bare = F.regexp_replace(t, EDGE_NUMBER, "")
    margin = t.rlike(r"^\d{1,4}$") & (F.col("r") < 0.14 * F.col("width"))
    known = (F.coalesce("layer", F.lit("")) == "furniture") | F.coalesce("label", F.lit("")).isin("page_header", "page_footer") | F.coalesce(margin, F.lit(False)) | fixed(t) | (bare.rlike("(?i)[a-z]{3}") & fixed(bare))
    return blocks.withColumn("_key", key).join(repeated, ["doc", "_key"], "left").withColumn("furniture", known | F.coalesce("_rep", F.lit(False))).drop("_key", "_rep")


def speaker(text: Column, agency: Column, doc_type: Column, path: Column) -> Column:
    """Who speaks in a block: by document type, then by what the text says, then by the section it stands in."""
    judging = F.exists(F.coalesce(path, F.array().cast("array<string>")), lambda h: h.rlike(JUDGEMENT_HEADING))
    return (
        F.when(doc_type.isin(LABELS), "label")
        .when(doc_type.isin(REGULATOR_TYPES), "regulator")
        .when(doc_type == "risk_management", "applicant")
        .when(text.rlike(REGULATOR_SAYS) | text.rlike(VERDICT), "regulator")
        .when(text.rlike(APPLICANT_SAYS), "applicant")
        .when((agency == "ema") & (doc_type == "assessment_report"), F.when(judging, "regulator").otherwise("applicant_data"))
        .when((agency == "fda") & (doc_type == "review"), "regulator")
        .otherwise("unknown")
    )


def redacted(text: Column) -> Column:
    return text.rlike(REDACTION)


def clean_cell(text: Column) -> Column:
    """A mark before a number goes, dashes become one, words cut at a line's end join."""
    t = F.when(redacted(text), F.regexp_replace(text, CELL_MARK, "")).otherwise(text)
    t = F.when(t.rlike(DASH_ONLY) & (F.trim(t) != ""), "—").otherwise(t)
    return F.regexp_replace(t, WRAP_HYPHEN, "-")


def page_route(chars: Column, images: Column, garble: Column, invisible: Column, bare: Column, label: Column) -> Column:
    """How to read a page, by the first rule that holds. Shares lie between 0 and 1."""
    return (
        F.when((chars < 30) & (images < 0.05), "BLANK")
        .when((chars >= 200) & (garble >= 0.4), "BROKEN_TEXT")
        .when((chars < 50) & (images >= 0.3), F.when(label, "ARTWORK").otherwise("IMAGE"))
        .when((images >= 0.7) & (invisible >= 0.5), "LEGACY_OCR")
        .when(bare >= 0.05, "MIXED")
        .otherwise("DIGITAL")
    )


def ocr_mode(route: Column) -> Column:
    return F.when(route.isin("MIXED", "IMAGE", "ARTWORK"), "auto").when(route == "BROKEN_TEXT", "full")


def page_runs(pages: DataFrame) -> DataFrame:
    """(doc, run, mode, first, last, n): stretches of neighbouring pages that are read in one mode; a missing page ends a run. pages: doc, page, route; pages without a mode are not read by a model."""
    from lodestone.operators.relational import islands

    p = pages.withColumn("mode", F.coalesce(ocr_mode(F.col("route")), F.lit("none")))
    w = W.partitionBy("doc").orderBy("page")
    fresh = F.coalesce((F.lag("mode").over(w) != F.col("mode")) | (F.lag("page").over(w) != F.col("page") - 1), F.lit(True))
    return islands(p.withColumn("_f", fresh), ["doc"], ["page"], F.col("_f"), "run").groupBy("doc", "run", "mode").agg(F.min("page").alias("first"), F.max("page").alias("last"), F.count(F.lit(1)).alias("n"))


def skipped_section(path: Column) -> Column:
    return F.exists(path, lambda p: F.trim(p).rlike(SKIPPED))


def document_qa(blocks: DataFrame, cells: DataFrame) -> DataFrame:
    """Figures of a parse per document. blocks: doc, type, text, source, status, furniture, redacted, structure, section_path; cells: doc, text (of tables that are no furniture)."""
    body, text = ~F.col("furniture"), (F.col("type") == "text") & ~F.col("furniture")
    n = lambda c: F.count_if(c).alias
    chars = F.sum(F.when(text, F.length("text")).otherwise(0))
    ocr = F.sum(F.when(text & (F.col("source") == "ocr"), F.length("text")).otherwise(0))
    b = blocks.groupBy("doc").agg(
        n(text)("text_blocks"), chars.alias("text_chars"), F.when(chars > 0, F.round(ocr / chars, 3)).otherwise(0.0).alias("ocr_char_share"),
        n(body & (F.col("type") == "table"))("tables"), n(body & (F.col("type") == "table") & (F.col("structure") == "ocr_grid"))("tables_ocr_grid"),
        n(body & (F.col("status") == "needs_review"))("needs_review_blocks"), n(body & (F.col("status") == "reread"))("reread_blocks"),
        n(text & X.garbled_window(F.col("text")))("garbled_residual"), n(F.col("furniture"))("furniture_blocks"), n(body & F.col("redacted"))("redacted_blocks"),
        F.count_distinct(F.when(body & (F.size("section_path") > 0), F.array_join("section_path", "\x1f"))).alias("sections"),
    )
    digits = cells.filter(F.col("text").rlike(r"\d")).groupBy("doc").agg(F.count(F.lit(1)).alias("numeric_cells"), F.count_if(F.trim("text").rlike(NUMBER_CELL)).alias("_p"))
    j = b.join(digits, "doc", "left")
    return j.withColumn("numeric_cell_parse_rate", F.round(F.col("_p") / F.col("numeric_cells"), 3)).withColumn("numeric_cells", F.coalesce("numeric_cells", F.lit(0)).cast("long")).drop("_p")


def attach_footnotes(blocks: DataFrame) -> DataFrame:
    """(doc, pos, table_pos): footnotes and the table they belong to: the last one on their page with no other text between. blocks: doc, pos, page, type, label."""
    order = W.partitionBy("doc").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    table = F.last(F.when(F.col("type") == "table", F.struct(F.col("pos").alias("p"), F.col("page").alias("g"))), ignorenulls=True).over(order)
    breaks = F.last(F.when((F.col("type") == "text") & ~F.coalesce("label", F.lit("")).isin("footnote", "caption"), F.col("pos")), ignorenulls=True).over(order)
    marked = blocks.withColumn("_t", table).withColumn("_b", breaks)
    foot = (F.col("type") == "text") & (F.col("label") == "footnote") & (F.col("_t.g") == F.col("page")) & (F.coalesce("_b", F.lit(-1)) < F.col("_t.p"))
    return marked.filter(foot).select("doc", "pos", F.col("_t.p").alias("table_pos"))
