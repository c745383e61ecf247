"""Agency catalogs to registrations and documents: joins, filters and tolerant columns over catalog rows."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import text as X

#: Document types by their normalised catalog name, in order of precedence.
EMA_TYPES = [
    ("public_assessment_report", "assessment_report"),
    ("epar_public_assessment_report", "assessment_report"),
    ("scientific_discussion", "assessment_report"),
    ("procedural_steps_taken_and_scientific_information_after_authorisation", "procedural_steps"),
    ("procedural_steps_after", "procedural_steps"),
    ("procedural_steps", "procedural_steps"),
    ("product_information", "product_information"),
    ("epar_product_information", "product_information"),
    ("overview", "epar_overview"),
    ("medicine_overview", "epar_overview"),
    ("epar_medicine_overview", "epar_overview"),
    ("summary_for_the_public", "epar_overview"),
    ("risk_management_plan_summary", "risk_management"),
    ("rmp_summary", "risk_management"),
    ("rmp", "risk_management"),
    ("all_authorised_presentations", "other"),
]
#: Marks in the address of a document.
EMA_MARKERS = [("assessment-report", "assessment_report"), ("procedural-steps", "procedural_steps"), ("product-information", "product_information"), ("medicine-overview", "epar_overview"), ("risk-management", "risk_management")]
#: Language suffixes of translations.
TRANSLATIONS = "bg cs da de el es et fi fr hr hu it lt lv mt nl pl pt ro sk sl sv is no".split()
#: Topics by title.
TOPICS = [(r"interchangeab", "interchangeability"), (r"comparative analytical|quality", "analytical"), (r"clinical pharmacology|pharmacokinetic", "pk"), (r"efficacy stud", "ces"), (r"immunogenicity", "immunogenicity"), (r"label", "labeling"), (r"meeting", "meetings"), (r"fewer than all conditions|extrapolat", "extrapolation"), (r"q&a|questions and answers", "general")]
GUIDANCE_TITLE = r"(?i)biosimilar|interchangeab|bpci|bsufa|351\([ak]\)"
#: Fixed patterns: dates of a decision, first match counts.
DECIDED = [r"Authori[sz]ation Date:?\s*(\d{4}-\d{2}-\d{2})", r"(\d{4}-\d{2}-\d{2})\s*NOC issued for the New Drug Submission", r"On (\w+ \d{1,2}, \d{4}), Health Canada issued a Notice of Compliance", r"NOC issued by Director General:?\s*(\d{4}-\d{2}-\d{2})", r"Notice of Compliance issued by Director General[^0-9]{0,120}(\d{4}-\d{2}-\d{2})"]


def normalised(rows: DataFrame) -> DataFrame:
    """Column names in key form: lower case, other signs as one underscore. Of names that fall together the first stays."""
    named: dict[str, str] = {}
    for c in rows.columns:
        named.setdefault(re.sub(r"[^a-z0-9]+", "_", c.strip().lower()).strip("_"), c)
    return rows.select(*[F.col(f"`{c}`").alias(k) for k, c in named.items()])


def picked(rows: DataFrame, *names: str) -> Column:
    """The first of the candidate columns that exists and is not empty."""
    there = [F.col(n).cast("string") for n in names if n in rows.columns]
    return X.pick(*there) if there else F.lit(None).cast("string")


def ema_type(native: Column, url: Column) -> Column:
    key = F.coalesce(X.norm_key(native), F.lit(""))
    exact = F.coalesce(*[F.when(key == k, v) for k, v in EMA_TYPES])
    part = F.coalesce(*[F.when(F.contains(key, F.lit(k)), v) for k, v in EMA_TYPES])
    mark = F.coalesce(*[F.when(F.contains(F.lower(url), F.lit(k)), v) for k, v in EMA_MARKERS])
    return F.coalesce(exact, part, mark, F.lit("other"))


def ema_registrations(rows: DataFrame) -> DataFrame:
    """Human medicines of the catalog: native_key, brand_name, ingredient, holder, licence_type, first_approval_date, status."""
    r = normalised(rows)
    p = lambda *n: picked(r, *n)
    name, number = p("name_of_medicine", "medicine_name", "name"), p("ema_product_number", "product_number")
    inn = p("international_non_proprietary_name_common_name", "international_non_proprietary_name_inn_common_name", "inn_common_name", "inn")
    biosimilar = F.lower(F.coalesce(p("biosimilar"), F.lit(""))).isin("yes", "true", "1")
    human = F.lower(F.coalesce(p("category"), F.lit("human"))) == "human"
    return r.filter(human & name.isNotNull()).select(
        F.coalesce(number, F.concat(F.lit("name:"), X.norm_name(name))).alias("native_key"), name.alias("brand_name"), F.coalesce(inn, p("active_substance")).alias("ingredient"),
        p("marketing_authorisation_developer_applicant_holder", "marketing_authorisation_holder", "mah").alias("holder"), F.when(biosimilar, "biosimilar").otherwise("centrally_authorised").alias("licence_type"),
        X.iso_date(p("marketing_authorisation_date", "european_commission_decision_date"), dayfirst=True).alias("first_approval_date"), p("medicine_status", "authorisation_status", "status").alias("status"),
    )


def english(language: Column, url: Column) -> Column:
    """English by its language column, or, without one, by no translation's suffix in the address."""
    low = F.lower(url)
    translated = url.rlike("_(" + "|".join(TRANSLATIONS) + r")\.")
    return F.when(F.coalesce(language, F.lit("")) != "", F.lower(language).isin("en", "english")).otherwise(F.contains(url, F.lit("_en.")) | low.endswith("_en") | ~translated)


def ema_documents(registrations: DataFrame, rows: DataFrame) -> DataFrame:
    """Documents of registrations (native_key, brand_name): by product number, and for those without any by name. English ones with an address only."""
    r = normalised(rows)
    p = lambda *n: picked(r, *n)
    d = r.select(p("ema_product_number", "product_number").alias("_no"), X.norm_name(p("name_of_medicine", "medicine_name")).alias("_name"), p("url", "document_url", "link").alias("source_url"), p("language", "language_code").alias("_lang"), p("type", "document_type").alias("native_doc_type"), p("name", "title", "document_name").alias("title"))
    reg = registrations.select("native_key", X.norm_name(F.col("brand_name")).alias("_brand"))
    by_number = reg.join(d, reg.native_key == d["_no"])
    rest = reg.join(by_number.select("native_key").distinct(), "native_key", "left_anti")
    both = by_number.unionByName(rest.join(d, rest["_brand"] == d["_name"]))
    good = both.filter(F.col("source_url").isNotNull() & english(F.col("_lang"), F.col("source_url")))
    return good.select("native_key", "source_url", ema_type(F.col("native_doc_type"), F.col("source_url")).alias("doc_type"), F.coalesce("title", "source_url").alias("title"))


def fda_url(raw: Column, year: Column) -> tuple[Column, Column]:
    """(address, fragment): the last of a doubled address, https, without fragment, with the year folder that moved documents got."""
    u = F.trim(raw)
    u = F.when(u.rlike("://.*://"), F.concat(F.lit("http"), F.element_at(F.split(u, "http"), -1))).otherwise(u)
    u = F.regexp_replace(u, "^http://", "https://")
    parts = F.split(u, "#", 2)
    base = F.get(parts, F.lit(0))
    # Fixed pattern: folders whose documents moved under their year.
    dated = F.regexp_replace(base, F.lit(r"/drugsatfda_docs/(appletter|label|nda)/(?!\d{4}/)"), F.concat(F.lit("/drugsatfda_docs/$1/"), year, F.lit("/")))
    return F.when(year.rlike(r"^\d{4}$"), dated).otherwise(base), F.get(parts, F.lit(1))


def fda_type(description: Column, url: Column) -> Column:
    """By the address first: the catalog's type is sometimes wrong."""
    d, u = F.lower(F.coalesce(description, F.lit(""))), F.lower(url)
    has = lambda *w: X.contains_any(d, list(w))
    # Marks of addresses, then words of catalog types, in order of precedence.
    return (
        F.when(u.rlike(r"toc\.(cfm|htm|html)$") | u.endswith(".cfm"), "review_index")
        .when(F.contains(u, F.lit("lbl.pdf")), "label")
        .when(F.contains(u, F.lit("ltr.pdf")) | F.contains(u, F.lit("approv.pdf")), "approval_letter")
        .when(u.rlike(r"(r|memo|corres|rems\d*)\.pdf$"), "review")
        .when(has("letter"), "approval_letter")
        .when(has("label", "medication guide", "patient"), "label")
        .when(has("review"), "review")
        .otherwise("other")
    )


def fda_documents(registrations: DataFrame, docs: DataFrame, types: DataFrame, submissions: DataFrame) -> DataFrame:
    """Star join of the application tables. registrations: native_key, appl (no leading zeros); docs: ApplNo, SubmissionType, SubmissionNo, type_id, url, title, date;
    types: type_id, description; submissions: ApplNo, SubmissionType, SubmissionNo, status, status_date."""
    strip = lambda c: F.regexp_replace(c, "^0+", "")
    d = docs.withColumn("appl", strip("ApplNo")).filter(F.trim("url") != "")
    s = submissions.select(strip("ApplNo").alias("appl"), "SubmissionType", "SubmissionNo", "status", "status_date")
    j = d.join(registrations.select("native_key", "appl"), "appl").join(types, "type_id", "left").join(s, ["appl", "SubmissionType", "SubmissionNo"], "left")
    url, fragment = fda_url(F.col("url"), F.substring(F.coalesce("date", F.lit("")), 1, 4))
    return j.select("native_key", url.alias("source_url"), fragment.alias("fragment"), fda_type(F.col("description"), url).alias("doc_type"), F.coalesce(F.nullif("title", F.lit("")), "description", url).alias("title"), F.concat_ws("-", "SubmissionType", "SubmissionNo").alias("procedure_id"), X.iso_date(F.col("status_date")).alias("decision_date"), X.iso_date(F.col("date")).alias("doc_date"), F.col("status").alias("submission_status"))


def added_products(known: DataFrame, products: DataFrame, applications: DataFrame) -> DataFrame:
    """Registrations (native_key, brand_name, ingredient, holder) that the product table has and `known` has not: biologic applications, or such without an application row."""
    strip = lambda c: F.regexp_replace(c, "^0+", "")
    apps = applications.select(strip("ApplNo").alias("appl"), F.upper("ApplType").alias("_type"), F.col("SponsorName").alias("holder"))
    p = products.withColumn("appl", strip("ApplNo")).join(apps, "appl", "left").filter("_type IS NULL OR _type = 'BLA'")
    shouted = (F.upper("DrugName") == F.col("DrugName")) & (F.lower("DrugName") != F.col("DrugName"))
    rows = p.select(F.concat(F.lit("BLA"), "appl").alias("native_key"), F.when(shouted, F.initcap("DrugName")).otherwise(F.col("DrugName")).alias("brand_name"), F.col("ActiveIngredient").alias("ingredient"), "holder")
    once = rows.groupBy("native_key").agg(*[F.min_by(c, "brand_name").alias(c) for c in ("brand_name", "ingredient", "holder")])
    return once.join(known.select("native_key"), "native_key", "left_anti")


def licences(rows: DataFrame) -> DataFrame:
    """One registration per licence number from a presentation list: native_key, brand_name, proper_name, holder, status, licence_type, first_approval_date, interchangeable_date, presentations.

    rows: line, bla_number, proprietary_name, proper_name, applicant, licensure, license_type, approval_date, inter_approval_date, submission_type, product_number, strength, dosage_form, route.
    Presentations come in the order of their lines; the first line gives names, holder and status; an interchangeable type, the last one, goes before the first type named; only original submissions
    date the approval. Rows without a digit in their number are left out."""
    empty = lambda c: F.when(F.trim(c) != "", F.col(c))
    kind = empty("license_type")
    original = F.lower(F.coalesce(empty("submission_type"), F.lit("Original"))).startswith("orig")
    r = rows.withColumn("_no", F.regexp_replace(F.coalesce(F.col("bla_number").cast("string"), F.lit("")), r"\D", "")).filter("_no != ''")
    r = r.withColumn("_kind", kind).withColumn("_at", X.iso_date(F.col("approval_date").cast("string"))).withColumn("_inter", X.iso_date(F.col("inter_approval_date").cast("string")))
    swap = F.contains(F.lower("_kind"), F.lit("interchangeable"))
    first = lambda c: F.min_by(c, "line")
    shown = F.struct("line", "product_number", "strength", F.trim(F.coalesce("dosage_form", F.lit(""))).alias("dosage_form"), "route", F.coalesce("_kind", F.lit("")).alias("license_type"), F.col("_at").alias("approval_date"), "submission_type")
    return r.groupBy(F.concat(F.lit("BLA"), F.col("_no")).alias("native_key")).agg(
        first(F.coalesce(empty("proprietary_name"), empty("proper_name"))).alias("brand_name"), first(empty("proper_name")).alias("proper_name"), first(empty("applicant")).alias("holder"), first(empty("licensure")).alias("status"),
        F.coalesce(F.max_by("_kind", F.when(swap, F.col("line"))), F.min_by("_kind", F.when(F.col("_kind").isNotNull(), F.col("line")))).alias("licence_type"),
        F.min(F.when(original, F.col("_at"))).alias("first_approval_date"), F.min("_inter").alias("interchangeable_date"), F.array_sort(F.collect_list(shown)).alias("presentations"),
    )


def overview_rows(pages: DataFrame) -> DataFrame:
    """(page_id, pos, date, submission, href, label): rows with links of the approval tables of application pages (page_id, html)."""
    table = lambda i: F.regexp_extract("html", f'(?s)<table[^>]*id="{i}".*?</table>', 0)
    rows = pages.select("page_id", F.posexplode(F.flatten(F.transform(F.array(table("exampleApplOrig"), table("exampleApplSuppl")), lambda t: F.regexp_extract_all(t, F.lit("(?s)<tr[^>]*>(.*?)</tr>"), F.lit(1))))).alias("pos", "tr"))
    cells = F.regexp_extract_all("tr", F.lit("(?s)<td[^>]*>(.*?)</td>"), F.lit(1))
    cell = lambda i: X.strip_html(F.get("_c", F.lit(i)))
    links = F.regexp_extract_all("tr", F.lit('(?s)(<a[^>]+href="[^"]+"[^>]*>.*?</a>)'))
    each = rows.withColumn("_c", cells).filter(F.size("_c") >= 3).withColumn("link", F.explode(links))
    return each.select("page_id", "pos", X.iso_date(cell(0)).alias("date"), cell(1).alias("submission"), F.regexp_extract("link", 'href="([^"]+)"', 1).alias("href"), X.strip_html(F.col("link")).alias("label"))


def absolute(base: Column, href: Column) -> Column:
    """Address of a link on a page, with https."""
    origin, folder = F.regexp_extract(base, "^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1), F.regexp_extract(base, "^([a-zA-Z][a-zA-Z0-9+.-]*://[^?#]*/)", 1)
    at = F.when(folder == "", F.concat(origin, F.lit("/"))).otherwise(folder)
    whole = F.when(href.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*://"), href).when(href.startswith("//"), F.concat(F.regexp_extract(base, "^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1), href)).when(href.startswith("/"), F.concat(origin, href)).otherwise(F.concat(at, href))
    return F.regexp_replace(whole, "^http://", "https://")


def index_children(pages: DataFrame) -> DataFrame:
    """(page_id, source_url, title): the PDF links of contents pages (page_id, url, html), each address once. Newer pages build links in a script from flags; only flags of 1 exist."""
    # Fixed patterns: how contents pages hold their links.
    base, flags = F.regexp_extract("html", r'var\s+pdfBaseName\s*=\s*"([^"]+)"', 1), F.regexp_extract("html", r"(?s)var\s+pdfFiles\s*=\s*\{(.*?)\};", 1)
    script = (base != "") & (flags != "")
    shown = r"pdfFiles\.(\w+)\s*==\s*1\)\s*\{\s*\w+\s*\+=\s*'<li><a href=\"'\s*\+\s*pdfBaseName\s*\+\s*'([^\"']+)\"[^>]*>([^<]+)<"
    plain = r'(?is)<a[^>]+href="([^"]+\.pdf)"[^>]*>(.*?)</a>'
    p = pages.withColumn("_base", base).withColumn("_flags", flags)
    whole = lambda pat: F.regexp_extract_all("html", F.lit(pat), F.lit(0))
    one = p.filter(script).select("page_id", "url", "_base", "_flags", F.posexplode(whole(shown)).alias("pos", "m"))
    one = one.filter(F.regexp_like("_flags", F.concat(F.lit(r"\b"), F.regexp_extract("m", shown, 1), F.lit(r"\s*:\s*1")))).select("page_id", "url", "pos", F.concat("_base", F.regexp_extract("m", shown, 2)).alias("href"), F.regexp_extract("m", shown, 3).alias("label"))
    two = p.filter(~script).select("page_id", "url", F.posexplode(whole(plain)).alias("pos", "m")).select("page_id", "url", "pos", F.regexp_extract("m", plain, 1).alias("href"), F.regexp_extract("m", plain, 2).alias("label"))
    links = one.unionByName(two).withColumn("source_url", absolute(F.col("url"), F.col("href"))).withColumn("title", X.strip_html(F.col("label")))
    first = links.groupBy("page_id", "source_url").agg(F.min_by("title", "pos").alias("title"))
    return first.withColumn("title", F.coalesce(F.nullif("title", F.lit("")), F.element_at(F.split("source_url", "/"), -1)))


def monograph(html: Column) -> tuple[Column, Column]:
    """(address, date) of the monograph on a product page."""
    link = F.regexp_extract(html, r'(?is)href="([^"]*\.pdf)"', 1)
    return F.nullif(link, F.lit("")), F.nullif(F.regexp_extract(html, r"(\d{4}-\d{2}-\d{2})", 1), F.lit(""))


def page_dates(html: Column, doc_type: Column) -> tuple[Column, Column]:
    """(decision date, document date) that a decision summary states; of a full summary the first matching notice counts over the stated decision."""
    text = X.strip_html(html)
    got = lambda p: F.nullif(F.regexp_extract(text, p, 1), F.lit(""))
    notice = F.coalesce(*[X.iso_date(got(p)) for p in DECIDED])
    # Fixed patterns: dates that a summary states.
    stated = got(r"Date of [Dd]ecision:?\s*(\d{4}-\d{2}-\d{2})")
    known = doc_type.isin("sbd", "rds")
    return F.when(known, F.coalesce(F.when(doc_type == "sbd", notice), stated)), F.when(known, got(r"Date (?:SBD|RDS) issued:?\s*(\d{4}-\d{2}-\d{2})"))


def topics(title: Column) -> Column:
    """Sorted topics that a title names; `general` if none."""
    found = F.array_compact(F.array(*[F.when(F.lower(title).rlike(p), F.lit(t)) for p, t in TOPICS]))
    return F.when(F.size(found) == 0, F.array(F.lit("general"))).otherwise(F.array_sort(F.array_distinct(found)))


def guidances(rows: DataFrame, site: str) -> DataFrame:
    """Catalog rows (title, media, status, issued, docket: HTML cells) about the subject: title, landing_url, pdf_url, status, published_at, docket, topics."""
    href = lambda c: F.regexp_extract(c, 'href="([^"]+)"', 1)
    full = lambda u: F.when(u == "", None).when(u.startswith("http"), u).otherwise(F.concat(F.lit(site), u))
    t = X.strip_html(F.col("title"))
    return rows.filter(t.rlike(GUIDANCE_TITLE)).select(t.alias("title"), full(href("title")).alias("landing_url"), full(href("media")).alias("pdf_url"), F.nullif(F.lower(X.strip_html(F.col("status"))), F.lit("")).alias("status"), X.iso_date(X.strip_html(F.col("issued"))).alias("published_at"), F.nullif(F.regexp_replace(X.strip_html(F.col("docket")), r"[. ]+$", ""), F.lit("")).alias("docket"), topics(t).alias("topics"))


def enriched(catalog: DataFrame, curated: DataFrame) -> DataFrame:
    """Catalog guidances with what is curated for their landing page, else their PDF; live status and dates win. Curated rows not met are added, marked
    `not_in_catalog` unless withdrawn or superseded. curated: url, guidance_id, status, published_at, title."""
    c = curated.select(F.col("url").alias("_url"), F.col("guidance_id"), F.col("status").alias("_status"), F.col("published_at").alias("_at"), F.col("title").alias("_title"))
    live = catalog.filter("pdf_url IS NOT NULL")
    by_page = live.join(c.select(F.col("_url").alias("landing_url"), F.col("guidance_id").alias("_g1")), "landing_url", "left")
    both = by_page.join(c.select(F.col("_url").alias("pdf_url"), F.col("guidance_id").alias("_g2")), "pdf_url", "left")
    met = both.select("title", F.col("pdf_url").alias("source_url"), "status", "published_at", F.coalesce("_g1", "_g2").alias("guidance_id"), F.lit(False).alias("not_in_catalog"))
    rest = c.join(met.select("guidance_id").distinct(), "guidance_id", "left_anti")
    gone = F.coalesce(F.col("_status").isin("withdrawn", "superseded"), F.lit(False))
    return met.unionByName(rest.select(F.col("_title").alias("title"), F.col("_url").alias("source_url"), F.col("_status").alias("status"), F.col("_at").alias("published_at"), "guidance_id", (~gone).alias("not_in_catalog")))


def trials(studies: DataFrame, codes: DataFrame) -> DataFrame:
    """(program_id, nct_id): studies (nct_id, brief_title, official_title, other_ids array, org_id) that mention a code (program_id, code) in normal form.

    Codes are short: texts' runs of their sizes meet them as they are (operators.containment), so their number is not bounded, and the programs of a code are
    joined by shuffles, a code's studies dealt to several tasks; nothing but a field of marks of one size passes through the driver."""
    from lodestone.operators import containment as CT

    text = X.norm_name(F.concat_ws(" ", "brief_title", "official_title", F.array_join("other_ids", " "), "org_id"))
    c = codes.select(F.col("program_id"), X.norm_name(F.col("code")).alias("quote")).distinct()
    found = CT.mentioned(studies.select(F.col("nct_id").alias("text_id"), text.alias("body")), c).withColumn("_d", F.pmod(F.xxhash64("text_id"), F.lit(CT.DEALT)))
    of = c.withColumn("_d", F.explode(F.array(*(F.lit(i).cast("long") for i in range(CT.DEALT)))))
    return found.join(of.hint("shuffle_hash"), ["quote", "_d"]).select("program_id", F.col("text_id").alias("nct_id")).distinct()


#: Who speaks by default in a document type and how it is cut.
PROFILES = {"assessment_report": ("mixed", "section_tree+table_rows"), "review": ("mixed", "section_tree+table_rows"), "sbd": ("regulator", "html_sections+table_rows"), "rds": ("regulator", "html_sections"), "procedural_steps": ("regulator", "table_rows"), "approval_letter": ("regulator", "paragraphs"), "product_information": ("label", "label_sections"), "label": ("label", "label_sections"), "product_monograph": ("label", "label_sections"), "epar_overview": ("regulator", "paragraphs"), "risk_management": ("applicant", "section_tree"), "guidance": ("regulator", "numbered_sections"), "review_index": ("none", "none"), "other": ("unknown", "paragraphs")}
JURISDICTIONS = {"ema": "EU", "fda": "US", "hc": "CA"}


def metadata(documents: DataFrame, registrations: DataFrame, programs: DataFrame, versions: DataFrame) -> DataFrame:
    """One record per document: itself, its registration, its program, its latest version and the profile of its type.

    documents: doc_id, agency, doc_kind, doc_type, title, source_url, registration_id, program_id, decision_date, doc_date, jurisdiction (of a guidance, or null);
    registrations: registration_id, brand_name, native_key; programs: program_id, ingredient, role, codes and aliases (arrays); versions: doc_id, id, sha256, path, retrieved_at."""
    from lodestone.operators.relational import latest

    newest = latest(versions, ["doc_id"], F.desc("retrieved_at"), F.desc("id")).select("doc_id", F.col("sha256").alias("doc_version_sha256"), F.col("path").alias("storage_path"), "retrieved_at")
    names = F.array_sort(F.array_distinct(F.concat(F.array("program_id"), F.coalesce("codes", F.array().cast("array<string>")), F.coalesce("aliases", F.array().cast("array<string>")))))
    p = programs.select("program_id", "ingredient", F.col("role").alias("program_role"), names.alias("name_variants"))
    kind = F.when(F.col("doc_type").isin(list(PROFILES)), F.col("doc_type")).otherwise("other")
    table = lambda i: F.create_map(*[F.lit(x) for k, v in PROFILES.items() for x in (k, v[i])])
    place = F.create_map(*[F.lit(x) for kv in JURISDICTIONS.items() for x in kv])
    j = documents.join(registrations.select("registration_id", "brand_name", F.col("native_key").alias("registration_key")), "registration_id", "left").join(p, "program_id", "left").join(newest, "doc_id", "left")
    return j.withColumns({"schema_version": F.lit("1"), "jurisdiction": F.coalesce("jurisdiction", F.try_element_at(place, F.col("agency"))), "default_speaker": F.element_at(table(0), kind), "chunking": F.element_at(table(1), kind), "name_variants": F.coalesce("name_variants", F.array().cast("array<string>"))})
