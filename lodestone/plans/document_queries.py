"""Structure, table, narrative, selection, catalog, store and metric rules on driver tables, each beside its DuckDB oracle."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lodestone.functions import text as X
from lodestone.operators import metrics as M
from lodestone.operators import narrative as N
from lodestone.operators import near_duplicates as ND
from lodestone.operators import selection as L
from lodestone.operators import shared as SH
from lodestone.operators import spatial as SP
from lodestone.operators import structure as S
from lodestone.operators import tables as T
from lodestone.plans.retrieval_queries import t
from lodestone.plans.rule_queries import _LINES, col, shared_folder
from lodestone.plans.text_queries import _PAIRS as NEAR_PAIRS
from lodestone.sources import agencies as A
from lodestone.sources import stores as O
from lodestone.sources.stored import RunLog, StoredTable, VersionStore

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def sql_string(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _lines(spark, d):
    return t(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))


# Furniture: every tenth order is a document; line items are lines of its pages; a running title repeats on most pages.
_FURN = """b AS (SELECT l_orderkey // 10 AS doc, l_orderkey % 10 AS page, l_linenumber AS n, l_partkey, CASE l_linenumber WHEN 1 THEN 'Running title ' || (l_orderkey % 10) WHEN 2 THEN 'Page ' || (l_orderkey % 10) || ' of 10' WHEN 3 THEN (l_partkey % 900)::VARCHAR WHEN 4 THEN 'EMA/' || l_partkey || '/2020' ELSE 'Body text ' || l_partkey || ' goes on' END AS text,
  CASE WHEN l_linenumber = 6 AND l_suppkey % 3 = 0 THEN 'page_footer' ELSE 'text' END AS label FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY 1, 2))"""


@query(f"""WITH {_FURN}, k AS (SELECT doc, count(DISTINCT page) AS pages FROM b WHERE n = 1 GROUP BY 1), a AS (SELECT doc, count(DISTINCT page) AS every FROM b GROUP BY 1)
SELECT b.doc, page, n, text, (n IN (2, 3, 4) OR label = 'page_footer' OR (n = 1 AND coalesce(pages, 0) >= greatest(3, 0.3 * every))) AS furniture FROM b LEFT JOIN k USING (doc) JOIN a USING (doc)""")
def furniture_lines(spark, d):
    one = t(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"), F.min("l_suppkey").alias("l_suppkey"))
    text = "CASE l_linenumber WHEN 1 THEN concat('Running title ', l_orderkey % 10) WHEN 2 THEN concat('Page ', l_orderkey % 10, ' of 10') WHEN 3 THEN CAST(l_partkey % 900 AS STRING) WHEN 4 THEN concat('EMA/', l_partkey, '/2020') ELSE concat('Body text ', l_partkey, ' goes on') END"
    b = one.select(col("l_orderkey DIV 10", "doc"), col("l_orderkey % 10", "page"), F.col("l_linenumber").alias("n"), col(text, "text"), col("CASE WHEN l_linenumber = 6 AND l_suppkey % 3 = 0 THEN 'page_footer' ELSE 'text' END", "label"), F.lit("body").alias("layer"), col("CASE WHEN l_linenumber = 1 THEN 760.0D ELSE 400.0D END", "b"), col("CASE WHEN l_linenumber = 1 THEN 780.0D ELSE 420.0D END", "t"), F.lit(500.0).alias("r"), F.lit(612.0).alias("width"), F.lit(792.0).alias("height"))
    return S.furniture(b).select("doc", "page", "n", "text", "furniture")


_SAID = "['The applicant stated that ', 'Reviewer comment: ', 'The sponsor provided adequate data on ', 'Results of ', 'CHMP view on ', 'Company proposes ']"
_TYPES = "['label', 'guidance', 'risk_management', 'assessment_report', 'review', 'other']"


@query(f"""WITH b AS (SELECT o_orderkey, {_SAID}[(o_orderkey % 6 + 1)::INT] || o_custkey AS text, {_TYPES}[(o_custkey % 6 + 1)::INT] AS doc_type, ['ema', 'fda', 'hc'][(o_orderkey // 6 % 3 + 1)::INT] AS agency, CASE WHEN o_orderkey % 4 = 0 THEN '2.1. Discussion on efficacy' ELSE '2. Results' END AS head FROM orders)
SELECT o_orderkey, CASE WHEN doc_type = 'label' THEN 'label' WHEN doc_type = 'guidance' THEN 'regulator' WHEN doc_type = 'risk_management' THEN 'applicant' WHEN text LIKE 'Reviewer%' OR text LIKE 'CHMP view%' OR text LIKE '%provided adequate%' THEN 'regulator' WHEN text LIKE 'The applicant stated%' OR text LIKE 'Company proposes%' THEN 'applicant'
  WHEN agency = 'ema' AND doc_type = 'assessment_report' THEN CASE WHEN head LIKE '%Discussion%' THEN 'regulator' ELSE 'applicant_data' END WHEN agency = 'fda' AND doc_type = 'review' THEN 'regulator' ELSE 'unknown' END AS speaker FROM b""")
def block_speakers(spark, d):
    arr = lambda s: s.replace("[", "array(").replace("]", ")")
    o = t(spark, d, "orders").select("o_orderkey", col(f"concat(element_at({arr(_SAID)}, CAST(o_orderkey % 6 + 1 AS INT)), o_custkey)", "text"), col(f"element_at({arr(_TYPES)}, CAST(o_custkey % 6 + 1 AS INT))", "doc_type"), col("element_at(array('ema', 'fda', 'hc'), CAST(o_orderkey DIV 6 % 3 + 1 AS INT))", "agency"), col("array(CASE WHEN o_orderkey % 4 = 0 THEN '2.1. Discussion on efficacy' ELSE '2. Results' END)", "path"))
    return o.select("o_orderkey", S.speaker(F.col("text"), F.col("agency"), F.col("doc_type"), F.col("path")).alias("speaker"))


@query("""SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN p_size::VARCHAR WHEN 1 THEN '—' WHEN 2 THEN 'long-' || p_name WHEN 3 THEN '(b) (4) ' || p_name ELSE p_name END AS text, p_partkey % 5 IN (0, 3) AS redacted FROM part""")
def cleaned_cells(spark, d):
    raw = F.expr("CASE p_partkey % 5 WHEN 0 THEN concat('(b) (4) ', p_size) WHEN 1 THEN ' - – ' WHEN 2 THEN concat('long- ', p_name) WHEN 3 THEN concat('(b) (4) ', p_name) ELSE p_name END")
    return t(spark, d, "part").select("p_partkey", S.clean_cell(raw).alias("text"), S.redacted(raw).alias("redacted"))


def _route_sql(v: str) -> str:
    return f"CASE WHEN chars < 30 AND img < 5 THEN 'BLANK' WHEN chars >= 200 AND garble >= 40 THEN 'BROKEN_TEXT' WHEN chars < 50 AND img >= 30 THEN CASE WHEN label THEN 'ARTWORK' ELSE 'IMAGE' END WHEN img >= 70 AND hidden >= 50 THEN 'LEGACY_OCR' WHEN bare >= 5 THEN 'MIXED' ELSE 'DIGITAL' END AS {v}"


@query(f"""WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_partkey % 400)::INT AS chars, (l_suppkey * 7 % 100)::INT AS img, (l_quantity::INT * 2 % 100) AS garble, (l_partkey % 100)::INT AS hidden, (l_orderkey % 10)::INT AS bare, l_returnflag = 'R' AS label FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, route, CASE WHEN route IN ('MIXED', 'IMAGE', 'ARTWORK') THEN 'auto' WHEN route = 'BROKEN_TEXT' THEN 'full' END AS ocr FROM (SELECT *, {_route_sql('route')} FROM s)""")
def page_routes(spark, d):
    share = lambda e: F.expr(e) / 100
    route = S.page_route(F.col("l_partkey") % 400, share("l_suppkey * 7 % 100"), share("CAST(l_quantity AS INT) * 2 % 100"), share("l_partkey % 100"), share("l_orderkey % 10"), F.col("l_returnflag") == "R")
    r = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", route.alias("route"))
    return r.withColumn("ocr", S.ocr_mode(F.col("route")))


_BOX = "x.l BETWEEN 0 AND 1"


@query("""WITH i AS (SELECT l_orderkey, l_linenumber AS id, (l_partkey % 50)::DOUBLE AS l, (l_suppkey % 50)::DOUBLE AS b, (l_partkey % 50 + 20)::DOUBLE AS r, (l_suppkey % 50 + 20)::DOUBLE AS t FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY 1, 2)),
w AS (SELECT l_orderkey, l + 5 AS l, b + 5 AS b, r - 10 AS r, t - 11 AS t FROM i WHERE id % 2 = 0), m AS (SELECT i.l_orderkey, i.id, sum(coalesce((w.r - w.l) * (w.t - w.b), 0)) AS under FROM i LEFT JOIN w ON w.l_orderkey = i.l_orderkey AND (w.l + w.r) / 2 BETWEEN i.l - 2 AND i.r + 2 AND (w.b + w.t) / 2 BETWEEN i.b - 2 AND i.t + 2 GROUP BY 1, 2)
SELECT l_orderkey, sum(CASE WHEN under < 32 THEN 400.0 ELSE 0 END)::DOUBLE / 10000 AS bare FROM m GROUP BY 1""")
def bare_images(spark, d):
    one = t(spark, d, "lineitem").groupBy("l_orderkey", F.col("l_linenumber").alias("id")).agg(F.min("l_partkey").alias("p"), F.min("l_suppkey").alias("s"))
    i = one.select("l_orderkey", "id", col("CAST(p % 50 AS DOUBLE)", "l"), col("CAST(s % 50 AS DOUBLE)", "b"), col("CAST(p % 50 + 20 AS DOUBLE)", "r"), col("CAST(s % 50 + 20 AS DOUBLE)", "t"))
    texts = i.filter("id % 2 = 0").select("l_orderkey", "id", (F.col("l") + 5).alias("l"), (F.col("b") + 5).alias("b"), (F.col("r") - 10).alias("r"), (F.col("t") - 11).alias("t"))
    return SP.bare_images(i, texts, ["l_orderkey"], 10000.0)


@query(f"""WITH l AS ({_LINES}), b AS (SELECT doc_id AS doc, line, pos, pos % 9 = 4 AS tbl, pos % 7 = 2 AS furn FROM l)
SELECT doc, count(*) FILTER (WHERE NOT tbl AND NOT furn) AS text_blocks, coalesce(sum(length(line)) FILTER (WHERE NOT tbl AND NOT furn), 0)::BIGINT AS text_chars, count(*) FILTER (WHERE tbl AND NOT furn) AS tables, count(*) FILTER (WHERE furn) AS furniture_blocks, count(*) FILTER (WHERE NOT furn AND pos % 5 = 3) AS needs_review_blocks,
  count(DISTINCT CASE WHEN NOT furn THEN pos // 6 END) AS sections, count(*) FILTER (WHERE tbl AND NOT furn AND regexp_matches(line, '[0-9]')) AS numeric_cells, CASE WHEN coalesce(sum(length(line)) FILTER (WHERE NOT tbl AND NOT furn), 0) > 0 THEN round(coalesce(sum(length(line)) FILTER (WHERE NOT tbl AND NOT furn AND pos % 3 = 0), 0) / sum(length(line)) FILTER (WHERE NOT tbl AND NOT furn), 3) ELSE 0 END AS ocr_char_share FROM b GROUP BY 1""")
def doc_qa(spark, d):
    b = _lines(spark, d).select(F.col("doc_id").alias("doc"), F.col("line").alias("text"), "pos", F.when(F.col("pos") % 9 == 4, "table").otherwise("text").alias("type"), (F.col("pos") % 7 == 2).alias("furniture"), F.when(F.col("pos") % 5 == 3, "needs_review").otherwise("ok").alias("status"), F.when(F.col("pos") % 3 == 0, "ocr").otherwise("text_layer").alias("source"), F.lit(False).alias("redacted"), F.lit(None).cast("string").alias("structure"), F.array(col("concat('S', pos DIV 6)", "p")).alias("section_path"))
    q = S.document_qa(b, b.filter("type = 'table' AND NOT furniture").select("doc", "text"))
    return q.select("doc", "text_blocks", "text_chars", "tables", "furniture_blocks", "needs_review_blocks", "sections", "numeric_cells", "ocr_char_share")


@query(f"""WITH l AS ({_LINES}), b AS (SELECT doc_id AS doc, pos, pos // 5 AS page, CASE WHEN pos % 6 = 1 THEN 'table' WHEN pos % 6 IN (2, 3) THEN 'footnote' WHEN pos % 6 = 4 THEN 'caption' ELSE 'text' END AS kind FROM l),
w AS (SELECT *, max(CASE WHEN kind = 'table' THEN pos END) OVER o AS tp, max(CASE WHEN kind = 'text' THEN pos END) OVER o AS br FROM b WINDOW o AS (PARTITION BY doc ORDER BY pos ROWS UNBOUNDED PRECEDING))
SELECT doc, pos, tp AS table_pos FROM w WHERE kind = 'footnote' AND tp // 5 = page AND coalesce(br, -1) < tp""")
def footnote_tables(spark, d):
    k = F.col("pos") % 6
    b = _lines(spark, d).select(F.col("doc_id").alias("doc"), F.col("pos").cast("long").alias("pos"), col("pos DIV 5", "page"), F.when(k == 1, "table").otherwise("text").alias("type"), F.when(k.isin(2, 3), "footnote").when(k == 4, "caption").when(k != 1, "text").alias("label"))
    return S.attach_footnotes(b)


# Tables: an order is a table; its line items are rows under two header rows with a spanning cell, and a group label before each return flag.
_ROWS = """li AS (SELECT l_orderkey AS k, l_returnflag AS f, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag, l_linenumber, l_partkey, l_suppkey, l_quantity) AS n, l_partkey, l_quantity::INT AS q, l_suppkey FROM lineitem),
gl AS (SELECT k, f, min(n) AS first, dense_rank() OVER (PARTITION BY k ORDER BY f) AS g FROM li GROUP BY k, f)"""


def _cells(spark, d):
    from pyspark.sql import Window as W

    l = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_returnflag").alias("f"), "l_linenumber", "l_partkey", F.col("l_quantity").cast("int").alias("q"), "l_suppkey", "l_quantity")
    li = l.withColumn("n", F.row_number().over(W.partitionBy("k").orderBy("f", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"))).withColumn("g", F.dense_rank().over(W.partitionBy("k").orderBy("f")))
    li = li.withColumn("fresh", F.coalesce(F.lag("f").over(W.partitionBy("k").orderBy("f", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")) != F.col("f"), F.lit(True)))
    r = F.col("n") + F.col("g") + 1  # two header rows, a label row per group
    cell = lambda r, c, text, cs=1: F.struct(r.cast("int").alias("r"), F.lit(c).alias("c"), F.lit(1).alias("rs"), F.lit(cs).alias("cs"), text.alias("text"), F.lit(False).alias("header"))
    row = F.array(cell(r, 0, F.concat(F.lit("part "), F.col("l_partkey").cast("string"))), cell(r, 1, F.col("q").cast("string")), cell(r, 2, F.col("l_suppkey").cast("string")))
    label = F.array(cell(F.col("n") + F.col("g"), 0, F.concat(F.lit("flag "), "f")))
    head = F.array(cell(F.lit(0), 0, F.lit("Item")), cell(F.lit(0), 1, F.lit("Amounts"), 2), cell(F.lit(1), 1, F.lit("Count")), cell(F.lit(1), 2, F.lit("From")))
    every = li.select("k", F.explode(F.concat(row, F.when(F.col("fresh"), label).otherwise(F.slice(label, 1, 0)), F.when(F.col("n") == 1, head).otherwise(F.slice(head, 1, 0)))).alias("x")).select("k", "x.*")
    return every.withColumn("pos", F.col("r") * 10 + F.col("c"))


@query(f"""WITH {_ROWS} SELECT li.k, (n + g - 1 + 2)::INT AS r, 'flag ' || li.f || ' / part ' || l_partkey || ': Amounts / Count=' || q || '; Amounts / From=' || l_suppkey AS line FROM li JOIN gl USING (k, f)""")
def table_row_lines(spark, d):
    g = T.grids(_cells(spark, d), "k").withColumn("_names", T.column_names(F.col("grid"), F.col("n_head")))
    names = F.col("_names")
    return g.select("k", F.explode(T.row_lines(F.lit(""), F.col("grid"), F.col("n_head"), names)).alias("x")).select("k", "x.r", "x.line")


@query(f"""WITH {_ROWS}, c AS (SELECT k, max(n) AS n, count(DISTINCT f) AS g FROM li GROUP BY 1) SELECT k, 2 AS n_head, (n + g + 2)::INT AS n_rows, 'Item|Amounts|Amounts' AS first, '|Count|From' AS second FROM c""")
def table_grids(spark, d):
    g = T.grids(_cells(spark, d), "k")
    return g.select("k", "n_head", F.size("grid").alias("n_rows"), F.array_join(F.col("grid")[0], "|").alias("first"), F.array_join(F.col("grid")[1], "|").alias("second"))


@query(f"""WITH {_ROWS}, x AS (SELECT li.k, n + g + 1 AS r, '| part ' || l_partkey || ' | ' || q || ' | ' || l_suppkey || ' |' AS md FROM li JOIN gl USING (k, f) UNION ALL SELECT k, first + g, '| flag ' || f || ' |  |  |' FROM gl)
SELECT k, 'Order ' || k || chr(10) || '| Item | Amounts / Count | Amounts / From |' || chr(10) || '| --- | --- | --- |' || chr(10) || string_agg(md, chr(10) ORDER BY r) || chr(10) || 'note' AS text FROM x GROUP BY k""")
def table_markdown(spark, d):
    g = T.grids(_cells(spark, d), "k").withColumn("_names", T.column_names(F.col("grid"), F.col("n_head")))
    names = F.col("_names")
    rows = F.slice(F.col("grid"), F.col("n_head") + 1, F.size("grid") - F.col("n_head"))
    return g.select("k", T.markdown(F.concat(F.lit("Order "), F.col("k").cast("string")), names, rows, F.array(F.lit("note"))).alias("text"))


@query(f"""WITH RECURSIVE {_ROWS}, x AS (SELECT li.k, n + g + 1 AS r, length('| part ' || l_partkey || ' | ' || q || ' | ' || l_suppkey || ' |') AS len FROM li JOIN gl USING (k, f) UNION ALL SELECT k, first + g, length('| flag ' || f || ' |  |  |') FROM gl),
o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY r) AS i FROM x), f AS (SELECT k, i, 70 + length(k::VARCHAR) + 1 + len AS size, 0 AS part FROM o WHERE i = 1
 UNION ALL SELECT o.k, o.i, CASE WHEN (f.size + 1 + o.len + 3) // 4 > 50 THEN 70 + length(o.k::VARCHAR) + 1 + o.len ELSE f.size + 1 + o.len END, f.part + CASE WHEN (f.size + 1 + o.len + 3) // 4 > 50 THEN 1 ELSE 0 END FROM f JOIN o ON o.k = f.k AND o.i = f.i + 1)
SELECT k, part, count(*) AS n_rows FROM f GROUP BY 1, 2""")
def table_row_groups(spark, d):
    g = T.grids(_cells(spark, d), "k").withColumn("_names", T.column_names(F.col("grid"), F.col("n_head")))
    names = F.col("_names")
    parts = T.row_groups(F.concat(F.lit("Order "), F.col("k").cast("string")), F.col("grid"), F.col("n_head"), names, F.array().cast("array<string>"), 50)
    return g.select("k", F.posexplode(parts).alias("part", "text")).select("k", "part", (F.size(F.split("text", "\n")) - 3).cast("long").alias("n_rows"))


# Narrative: lines of a document are blocks; every eleventh is a table, sections change every eight lines, the speaker every five.
_NAR = f"""l AS ({_LINES}), b AS (SELECT doc_id AS doc, pos, pos // 9 AS page, line, pos % 11 = 5 AS tbl, pos // 8 AS sec, pos // 5 % 2 AS who FROM l),
x AS (SELECT *, sum(tbl::INT) OVER (PARTITION BY doc ORDER BY pos ROWS UNBOUNDED PRECEDING) AS tables, greatest(1, (length(trim(line)) + 3) // 4)::BIGINT AS n FROM b),
e AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY pos) AS i FROM x WHERE NOT tbl AND trim(line) <> '')"""


def _blocks(spark, d):
    p = F.col("pos")
    return _lines(spark, d).select(F.col("doc_id").alias("doc"), "pos", col("pos DIV 9", "page"), F.when(p % 11 == 5, "table").otherwise("text").alias("type"), F.lit("text").alias("label"), F.col("line").alias("text"), F.array(F.concat(F.lit("Section "), F.expr("pos DIV 8").cast("string"))).alias("path"), F.expr("pos DIV 5 % 2").cast("string").alias("speaker"), F.lit("ok").alias("status"), F.lit(False).alias("attached"))


@query(f"""WITH RECURSIVE {_NAR}, f AS (SELECT doc, i, pos, line, n AS size, n > 120 AS long, 1 AS c, sec, who, tables FROM e WHERE i = 1
 UNION ALL SELECT doc, i, pos, line, CASE WHEN fresh THEN n ELSE size + n END, n > 120, c + fresh::INT, sec, who, tables FROM (SELECT e.*, f.size, f.c, e.sec <> f.sec OR e.who <> f.who OR e.tables <> f.tables OR f.long OR f.size + e.n > 60 AS fresh FROM f JOIN e ON e.doc = f.doc AND e.i = f.i + 1)),
g AS (SELECT doc, c, min(pos) AS first_pos, count(*) AS n_blocks, string_agg(line, chr(10) ORDER BY pos) AS text FROM f WHERE NOT long GROUP BY 1, 2),
z AS (SELECT doc, pos, unnest(string_split(regexp_replace(trim(line), '([.;:])\\s+([A-Z(\\[])', '\\1␞\\2', 'g'), '␞')) AS s, generate_subscripts(string_split(regexp_replace(trim(line), '([.;:])\\s+([A-Z(\\[])', '\\1␞\\2', 'g'), '␞'), 1) AS j FROM f WHERE long),
h AS (SELECT doc, pos, j, s, greatest(1, (length(s) + 3) // 4)::BIGINT AS size, 0 AS part FROM z WHERE j = 1
 UNION ALL SELECT z.doc, z.pos, z.j, z.s, CASE WHEN h.size + m > 60 THEN m ELSE h.size + m END, h.part + (h.size + m > 60)::INT FROM h JOIN (SELECT *, greatest(1, (length(s) + 3) // 4)::BIGINT AS m FROM z) z ON z.doc = h.doc AND z.pos = h.pos AND z.j = h.j + 1),
r AS (SELECT doc, first_pos, 0 AS part, n_blocks, text FROM g UNION ALL SELECT doc, pos, part, 1, string_agg(s, ' ' ORDER BY j) FROM h GROUP BY 1, 2, 3)
SELECT doc, first_pos, part, n_blocks, md5(text) AS text_md5 FROM r WHERE len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) >= 3""")
def narrative_chunks(spark, d):
    """All chunks of all blocks; a block of more than 120 tokens is cut at its sentences."""
    return N.chunks(_blocks(spark, d), target=60, most=120).select("doc", F.col("first_pos").cast("long").alias("first_pos"), "part", "n_blocks", F.md5("text").alias("text_md5"))


@query(f"""WITH {_NAR}, y AS (SELECT doc, sec, pos, line, page FROM x WHERE NOT tbl AND trim(line) <> '') SELECT doc, sec, string_agg(line, chr(10) ORDER BY pos) AS text, array_to_string(list_sort(list(DISTINCT page)), ',') AS pages FROM y GROUP BY 1, 2""")
def section_parents(spark, d):
    p = N.parents(_blocks(spark, d))
    return p.select("doc", F.substring(F.col("path")[0], 9, 20).cast("long").alias("sec"), "text", F.array_join(F.transform("pages", lambda x: x.cast("string")), ",").alias("pages"))


@query(f"""WITH l AS ({_LINES}), b AS (SELECT doc_id AS doc, pos, line, pos // 4 AS sec, greatest(1, (length(line) + 3) // 4) AS n FROM l WHERE trim(line) <> ''), s AS (SELECT doc, sec, sum(n) AS size FROM b GROUP BY 1, 2),
w AS (SELECT b.*, size, lag(CASE WHEN size < 60 THEN b.sec END) OVER (PARTITION BY doc ORDER BY pos) AS before FROM b JOIN s USING (doc, sec)) SELECT doc, pos, CASE WHEN size < 60 AND before IS DISTINCT FROM sec THEN 'Leaf ' || sec || ': ' ELSE '' END || line AS text, size < 60 AS lifted FROM w""")
def short_sections(spark, d):
    b = _lines(spark, d).filter(F.trim("line") != "").select(F.col("doc_id").alias("doc"), F.col("pos").cast("long").alias("pos"), F.lit("text").alias("type"), F.lit("text").alias("label"), F.col("line").alias("text"), F.array(F.lit("Top"), F.concat(F.lit("Leaf "), F.expr("pos DIV 4").cast("string"))).alias("path"), F.lit(False).alias("attached"))
    return N.lifted(b, 60).select("doc", "pos", "text", (F.size("path") == 1).alias("lifted"))


# Selection.
@query("""SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'index_page' WHEN o_orderkey % 4 = 0 THEN 'not_pdf_or_html' WHEN o_orderkey % 4 = 1 AND o_custkey % 5 = 0 THEN 'unreadable_pdf' END AS reason FROM orders""")
def skip_rules(spark, d):
    kind = F.when(F.col("o_orderpriority") == "1-URGENT", "review_index").otherwise("review")
    path = F.concat(F.lit("raw/x"), F.expr("element_at(array('.zip', '.PDF', '.html', '.htm'), CAST(o_orderkey % 4 + 1 AS INT))"))
    return t(spark, d, "orders").select("o_orderkey", L.skip_reason(kind, path, F.col("o_custkey") % 5 != 0).alias("reason"))


@query("""WITH l AS (SELECT o_orderkey AS doc_id, CASE WHEN o_custkey % 3 > 0 THEN o_custkey::VARCHAR ELSE 'doc' || o_orderkey END AS r, CASE WHEN o_custkey % 4 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date FROM orders)
SELECT doc_id, last_value(doc_id) OVER w AS latest, doc_id <> last_value(doc_id) OVER w AS superseded FROM l WINDOW w AS (PARTITION BY r ORDER BY date, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def superseded_labels(spark, d):
    o = t(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"), F.lit("ema").alias("agency"), F.when(F.col("o_custkey") % 3 > 0, F.col("o_custkey")).alias("registration"), L.shown_date(F.when(F.col("o_custkey") % 4 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")), F.lit(None).cast("string"), F.lit("")).alias("date"))
    return L.superseded(o).select("doc_id", "latest", "superseded")


@query("""WITH s AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'skip' ELSE 'process' END AS action, CASE WHEN o_orderpriority = '1-URGENT' THEN 'near_duplicate' ELSE '' END AS reason FROM orders) SELECT action, reason, count(*) AS n FROM s GROUP BY 1, 2""")
def selection_summary(spark, d):
    skip = F.col("o_orderpriority") == "1-URGENT"
    return L.summary(t(spark, d, "orders").select(F.when(skip, "skip").otherwise("process").alias("action"), F.when(skip, F.concat(F.lit("near_duplicate (jaccard 0."), F.col("o_orderkey").cast("string"), F.lit(")"))).otherwise("").alias("reason")))


_PURPOSE = """d AS (SELECT o_orderkey AS doc_id, ['assessment_report', 'review', 'label', 'approval_letter', 'guidance'][(o_orderkey % 5 + 1)::INT] AS doc_type, o_orderkey // 5 % 4 AS k, o_custkey % 30 AS num FROM orders),
s AS (SELECT 'II/' || lpad(num::VARCHAR, 4, '0') AS procedure, num % 3 = 0 AS change FROM (SELECT DISTINCT o_custkey % 30 AS num FROM orders WHERE o_custkey % 30 < 20)),
e AS (SELECT *, CASE WHEN k = 0 THEN NULL WHEN k = 1 THEN 'P46/' || lpad(num::VARCHAR, 3, '0') ELSE 'II/' || lpad(num::VARCHAR, 4, '0') END AS procedure FROM d)"""


@query(f"""WITH {_PURPOSE} SELECT doc_id, CASE WHEN doc_type IN ('assessment_report', 'review') AND (doc_type = 'review' OR procedure IS NULL) THEN 'baseline_trials,indication_history' WHEN doc_type = 'approval_letter' OR (doc_type = 'assessment_report' AND coalesce(change, false)) THEN 'indication_history' WHEN doc_type = 'label' THEN 'reference_label' ELSE '' END AS purposes,
 CASE doc_type WHEN 'assessment_report' THEN CASE WHEN procedure IS NULL THEN 'initial assessment report' WHEN change THEN procedure || ': indication/form/route change' ELSE procedure || ': not an indication change' || CASE WHEN change IS NULL THEN ' (not in history)' ELSE '' END END WHEN 'review' THEN 'agency review of an application' WHEN 'approval_letter' THEN 'approval record' WHEN 'label' THEN 'originator label (latest kept by selection)' ELSE 'guidance: no reference purpose' END AS reason
FROM e LEFT JOIN s USING (procedure)""")
def reference_purposes(spark, d):
    o = t(spark, d, "orders")
    num, k = F.lpad((F.col("o_custkey") % 30).cast("string"), 4, "0"), F.expr("o_orderkey DIV 5 % 4")
    title = F.when(k == 0, "Name-H-C-958 : initial report").when(k == 1, F.concat(F.lit("Name-H-C-958-P46-"), num)).otherwise(F.concat(F.lit("Name-H-C-958-II-"), num, F.lit(" : variation")))
    docs = o.select(F.col("o_orderkey").alias("doc_id"), col("element_at(array('assessment_report', 'review', 'label', 'approval_letter', 'guidance'), CAST(o_orderkey % 5 + 1 AS INT))", "doc_type"), title.alias("title"))
    n = o.select((F.col("o_custkey") % 30).alias("n")).distinct().filter("n < 20")
    head = n.select(F.lit(1).alias("doc"), (F.col("n") * 2).alias("pos"), F.concat(F.lit("EMA/II/"), F.lpad(F.col("n").cast("string"), 4, "0"), F.lit(" | scope of the change")).alias("line"))
    more = n.select(F.lit(1).alias("doc"), (F.col("n") * 2 + 1).alias("pos"), F.when(F.col("n") % 3 == 0, "extension of indication").otherwise("new address").alias("line"))
    return L.purposes(docs, L.carried_scopes(head.unionByName(more))).select("doc_id", F.array_join("purposes", ",").alias("purposes"), "reason")


@query("""WITH v AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R') SELECT o_orderkey AS doc_id, o_orderpriority IN ('1-URGENT', '2-HIGH') OR o_orderkey % 9 = 0 AS wanted, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') OR o_orderkey % 9 = 0 OR v.l_orderkey IS NOT NULL THEN 'pending' ELSE 'skipped' END AS status FROM orders LEFT JOIN v ON l_orderkey = o_orderkey""")
def wanted_downloads(spark, d):
    docs = t(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"), F.col("o_orderpriority").alias("doc_type"), (F.col("o_orderkey") % 9 == 0).alias("is_index"), F.lit("pending").alias("status"))
    return L.wanted(docs, t(spark, d, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("doc_id")), ["1-URGENT", "2-HIGH"]).select("doc_id", "wanted", "status")


@query("""WITH v AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC) AS k FROM lineitem), here AS (SELECT l_orderkey FROM v WHERE k = 1 AND l_partkey % 3 = 0)
SELECT o_orderkey AS doc_id FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 7 > 0 AND (o_orderkey % 2 = 1 OR o_custkey % 4 = 0) AND o_orderkey NOT IN (SELECT l_orderkey FROM here)""")
def refill_candidates(spark, d):
    o, l = t(spark, d, "orders"), t(spark, d, "lineitem")
    docs = o.select(F.col("o_orderkey").alias("doc_id"), F.when(F.col("o_orderkey") % 2 == 0, "product").otherwise("guidance").alias("doc_kind"), (F.col("o_custkey") % 4).alias("program_id"), F.when(F.col("o_orderstatus") == "P", "superseded").otherwise("fetched").alias("status"))
    versions = l.select(F.col("l_orderkey").alias("doc_id"), F.col("l_shipdate").alias("retrieved_at"), F.struct("l_linenumber", "l_partkey").alias("id"), F.col("l_partkey").alias("path"))
    stored = t(spark, d, "part").filter("p_partkey % 3 = 0").select(F.col("p_partkey").alias("path"))
    return L.refill(docs, docs.filter("doc_id % 7 = 0"), versions, stored, spark.range(1).select(F.lit(0).cast("long").alias("program_id")), True).select("doc_id")


@query("""WITH v AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R') SELECT o_orderkey AS doc_id, CASE WHEN o_orderkey % 3 = 0 AND (v.l_orderkey IS NULL OR o_orderstatus = 'P') THEN 'failed' ELSE CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE 'fetched' END END AS status, CASE WHEN o_orderkey % 3 = 0 THEN 'timeout' END AS error FROM orders LEFT JOIN v ON l_orderkey = o_orderkey""")
def failed_fetch_rule(spark, d):
    o = t(spark, d, "orders")
    docs = o.select(F.col("o_orderkey").alias("doc_id"), F.when(F.col("o_orderstatus") == "P", "pending").otherwise("fetched").alias("status"), F.lit(None).cast("string").alias("error"))
    return O.failed_fetches(docs, docs.filter("doc_id % 3 = 0").select("doc_id", F.lit("timeout").alias("reason")), t(spark, d, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("doc_id")))


@query("""WITH v AS (SELECT o_custkey AS doc_id, o_orderkey AS id, 'o' || o_orderkey AS sha, CASE WHEN o_orderkey % 4 > 0 THEN 'f' || (floor(o_totalprice)::BIGINT % 3) END AS fp, floor(o_totalprice)::BIGINT % 200 AS size, o_orderpriority <> '5-LOW' AS html FROM orders),
m AS (SELECT *, max(id) OVER (PARTITION BY doc_id) AS last, count(*) OVER (PARTITION BY doc_id) AS n FROM v), nw AS (SELECT * FROM m WHERE id = last AND html),
k AS (SELECT nw.doc_id, max(o.id) AS keep_id FROM nw JOIN m o ON o.doc_id = nw.doc_id AND o.id < nw.id AND CASE WHEN o.fp IS NOT NULL THEN o.fp = nw.fp ELSE abs(o.size - nw.size) <= 64 END GROUP BY 1)
SELECT nw.doc_id, CASE WHEN fp IS NOT NULL THEN coalesce(keep_id, CASE WHEN n = 1 THEN nw.id END) END AS keep_id, CASE WHEN fp IS NULL THEN 'skipped_no_raw' WHEN keep_id IS NOT NULL OR n = 1 THEN 'rekeyed' ELSE 'unresolved' END AS action FROM nw LEFT JOIN k USING (doc_id)""")
def rekeyed_versions(spark, d):
    v = t(spark, d, "orders").select(F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("id"), col("concat('o', o_orderkey)", "sha256"), col("CASE WHEN o_orderkey % 4 > 0 THEN concat('f', CAST(floor(o_totalprice) AS BIGINT) % 3) END", "fingerprint"), col("CAST(floor(o_totalprice) AS BIGINT) % 200", "size"), (F.col("o_orderpriority") != "5-LOW").alias("html"))
    return O.rekeyed(v).select("doc_id", "keep_id", "action")


# Catalogs.
_NATIVE = "['EPAR - Public assessment report', 'Procedural steps taken', 'RMP', 'Overview', 'Other thing', '']"
_ADDR = "['x-assessment-report_en.pdf', 'x_de.pdf', 'x-medicine-overview_fr.pdf', 'x-product-information_en.pdf', 'x.pdf']"


@query(f"""WITH r AS (SELECT p_partkey, CASE WHEN p_partkey % 3 > 0 THEN 'EMEA' || p_partkey ELSE 'name' || p_partkey END AS native_key, 'Brand ' || p_partkey AS brand FROM part),
d AS (SELECT l_linenumber, l_partkey AS p, CASE WHEN l_partkey % 3 > 0 THEN 'EMEA' || l_partkey END AS no, {_NATIVE}[(l_suppkey % 6 + 1)::INT] AS native, 'https://site/' || l_orderkey || '-' || l_suppkey || {_ADDR}[(l_orderkey % 5 + 1)::INT] AS url, CASE WHEN l_quantity < 10 THEN 'EN' WHEN l_quantity < 14 THEN 'de' END AS lang FROM lineitem)
SELECT native_key, url AS source_url, CASE WHEN native LIKE 'EPAR%' THEN 'assessment_report' WHEN native LIKE 'Proc%' THEN 'procedural_steps' WHEN native = 'RMP' THEN 'risk_management' WHEN native = 'Overview' THEN 'epar_overview' WHEN url LIKE '%assessment-report%' THEN 'assessment_report' WHEN url LIKE '%product-information%' THEN 'product_information' WHEN url LIKE '%medicine-overview%' THEN 'epar_overview' ELSE 'other' END AS doc_type
FROM d JOIN r ON r.p_partkey = d.p WHERE CASE WHEN lang IS NOT NULL THEN lang = 'EN' ELSE NOT regexp_matches(url, '_(de|fr)\\.') END""")
def ema_documents(spark, d):
    arr = lambda s: s.replace("[", "array(").replace("]", ")")
    p = t(spark, d, "part")
    reg = p.select(col("CASE WHEN p_partkey % 3 > 0 THEN concat('EMEA', p_partkey) ELSE concat('name', p_partkey) END", "native_key"), col("concat('Brand ', p_partkey)", "brand_name"))
    rows = t(spark, d, "lineitem").select(col("CASE WHEN l_partkey % 3 > 0 THEN concat('EMEA', l_partkey) END", "EMA product number"), col("concat('BRAND-', l_partkey)", "Name of medicine"), col(f"element_at({arr(_NATIVE)}, CAST(l_suppkey % 6 + 1 AS INT))", "Type"), col(f"concat('https://site/', l_orderkey, '-', l_suppkey, element_at({arr(_ADDR)}, CAST(l_orderkey % 5 + 1 AS INT)))", "URL"), col("CASE WHEN l_quantity < 10 THEN 'EN' WHEN l_quantity < 14 THEN 'de' END", "Language"))
    return A.ema_documents(reg, rows).select("native_key", "source_url", "doc_type")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'EMEA' || p_partkey ELSE 'name:' || regexp_replace(lower(p_name), '[^a-z0-9]+', '', 'g') END AS native_key, p_name AS brand_name, CASE WHEN p_type = 'PROMO' THEN 'biosimilar' ELSE 'centrally_authorised' END AS licence_type, '20' || lpad((p_size % 20)::VARCHAR, 2, '0') || '-03-' || lpad((p_size % 28 + 1)::VARCHAR, 2, '0') AS first_approval_date FROM part WHERE p_brand <> 'Brand#2'""")
def ema_medicines(spark, d):
    p = t(spark, d, "part")
    rows = p.select(col("CASE WHEN p_brand = 'Brand#2' THEN 'Veterinary' ELSE 'Human' END", "Category"), F.col("p_name").alias("Name of medicine"), col("CASE WHEN p_partkey % 2 = 0 THEN concat('EMEA', p_partkey) ELSE '' END", "EMA product number"), col("CASE WHEN p_type = 'PROMO' THEN 'Yes' ELSE 'no' END", "Biosimilar"), col("concat(lpad(CAST(p_size % 28 + 1 AS STRING), 2, '0'), '/03/20', lpad(CAST(p_size % 20 AS STRING), 2, '0'))", "Marketing authorisation date"), F.col("p_partkey").cast("string").alias("Status"))
    return A.ema_registrations(rows).select(F.col("status").cast("long").alias("p_partkey"), "native_key", "brand_name", "licence_type", "first_approval_date")


_FDA = """o AS (SELECT o_orderkey, o_custkey AS appl, o_orderkey % 4 AS ty, CASE o_orderkey % 6 WHEN 0 THEN 'http://a.gov/drugsatfda_docs/label/x' || o_orderkey || 'lbl.pdf#page=3' WHEN 1 THEN 'https://a.gov/https://a.gov/drugsatfda_docs/nda/1999/y' || o_orderkey || 'r.pdf' WHEN 2 THEN 'https://a.gov/z' || o_orderkey || 'toc.cfm' WHEN 3 THEN ' ' ELSE 'https://a.gov/q' || o_orderkey || '.htm' END AS url, strftime(o_orderdate, '%Y-%m-%d') AS dt FROM orders)"""


@query(f"""WITH {_FDA} SELECT 'BLA' || appl AS native_key, CASE o_orderkey % 6 WHEN 0 THEN 'https://a.gov/drugsatfda_docs/label/' || substr(dt, 1, 4) || '/x' || o_orderkey || 'lbl.pdf' WHEN 1 THEN 'https://a.gov/drugsatfda_docs/nda/1999/y' || o_orderkey || 'r.pdf' ELSE url END AS source_url, CASE WHEN o_orderkey % 6 = 0 THEN 'page=3' END AS fragment,
 CASE o_orderkey % 6 WHEN 0 THEN 'label' WHEN 1 THEN 'review' WHEN 2 THEN 'review_index' ELSE CASE ty WHEN 0 THEN 'approval_letter' WHEN 1 THEN 'label' WHEN 2 THEN 'review' ELSE 'other' END END AS doc_type, CASE WHEN appl % 2 = 0 THEN 'AP' END AS submission_status FROM o WHERE trim(url) <> '' AND appl % 3 > 0""")
def fda_documents(spark, d):
    o = t(spark, d, "orders")
    url = "CASE o_orderkey % 6 WHEN 0 THEN concat('http://a.gov/drugsatfda_docs/label/x', o_orderkey, 'lbl.pdf#page=3') WHEN 1 THEN concat('https://a.gov/https://a.gov/drugsatfda_docs/nda/1999/y', o_orderkey, 'r.pdf') WHEN 2 THEN concat('https://a.gov/z', o_orderkey, 'toc.cfm') WHEN 3 THEN ' ' ELSE concat('https://a.gov/q', o_orderkey, '.htm') END"
    docs = o.select(col("concat('000', o_custkey)", "ApplNo"), F.lit("SUPPL").alias("SubmissionType"), F.lit("1").alias("SubmissionNo"), (F.col("o_orderkey") % 4).alias("type_id"), col(url, "url"), F.lit("").alias("title"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"))
    types = spark.createDataFrame([(0, "Letter"), (1, "Medication Guide"), (2, "Review")], "type_id long, description string")
    c = t(spark, d, "customer")
    reg = c.filter("c_custkey % 3 > 0").select(col("concat('BLA', c_custkey)", "native_key"), F.col("c_custkey").cast("string").alias("appl"))
    subs = c.filter("c_custkey % 2 = 0 AND c_custkey > 0").select(col("concat('0', c_custkey)", "ApplNo"), F.lit("SUPPL").alias("SubmissionType"), F.lit("1").alias("SubmissionNo"), F.lit("AP").alias("status"), F.lit("20200102").alias("status_date"))
    return A.fda_documents(reg, docs, types, subs).select("native_key", "source_url", "fragment", "doc_type", "submission_status")


@query("""SELECT 'BLA' || p_partkey AS native_key, upper(substr(p_name, 1, 1)) || substr(regexp_replace(p_name, ' .*', ''), 2) AS brand FROM part WHERE p_partkey % 5 > 0 AND (p_partkey % 3 = 0 OR p_partkey % 7 = 0) AND p_partkey > 0""")
def added_products(spark, d):
    p = t(spark, d, "part").filter("p_partkey > 0")
    products = p.select(col("concat('00', p_partkey)", "ApplNo"), F.upper(F.split("p_name", " ")[0]).alias("DrugName"), F.col("p_type").alias("ActiveIngredient"))
    apps = p.filter("p_partkey % 7 > 0").select(F.col("p_partkey").cast("string").alias("ApplNo"), col("CASE WHEN p_partkey % 3 = 0 THEN 'bla' ELSE 'NDA' END", "ApplType"), F.col("p_brand").alias("SponsorName"))
    known = p.filter("p_partkey % 5 = 0").select(col("concat('BLA', p_partkey)", "native_key"))
    return A.added_products(known, products, apps).select("native_key", F.col("brand_name").alias("brand"))


@query(r"""WITH l AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?is)<a[^>]+href="([^"]+)"[^>]*>', 1)) AS href FROM pages), a AS (SELECT page_id, CASE WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*://') THEN href WHEN href LIKE '/%' THEN regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1) || href
 ELSE CASE WHEN regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^?#]*/)', 1) = '' THEN regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1) || '/' ELSE regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^?#]*/)', 1) END || href END AS u FROM l) SELECT DISTINCT page_id, regexp_replace(u, '^http://', 'https://') AS source_url FROM a""")
def absolute_links(spark, d):
    l = t(spark, d, "pages").select("page_id", "url", F.explode(F.regexp_extract_all("html", F.lit(r'(?is)<a[^>]+href="([^"]+)"[^>]*>'))).alias("href"))
    return l.select("page_id", A.absolute(F.col("url"), F.col("href")).alias("source_url")).distinct()


@query("""SELECT p_partkey, 'Biosimilar ' || p_name AS title, 'https://site/l' || p_partkey AS landing_url, CASE WHEN p_partkey % 4 > 0 THEN 'https://site/m' || p_partkey END AS pdf_url, array_to_string(CASE p_partkey % 3 WHEN 0 THEN ['immunogenicity', 'labeling'] WHEN 1 THEN ['analytical'] ELSE ['general'] END, ',') AS topics FROM part WHERE p_partkey % 2 = 0""")
def guidance_catalog(spark, d):
    word = "CASE WHEN p_partkey % 2 = 0 THEN 'Biosimilar ' ELSE 'Oncology ' END"
    rows = t(spark, d, "part").select(col(f"concat('<a href=\"/l', p_partkey, '\">', {word}, p_name, '</a>')", "title"), col("CASE WHEN p_partkey % 4 > 0 THEN concat('<a href=\"https://site/m', p_partkey, '\">PDF</a>') ELSE '' END", "media"), F.lit("<b>Final</b>").alias("status"), F.lit("01/02/2020").alias("issued"), col("concat('FDA-', p_partkey, '. ')", "docket"))
    g = A.guidances(rows, "https://site").withColumn("p_partkey", F.regexp_extract("docket", "([0-9]+)", 1).cast("long"))
    extra = F.when(F.col("p_partkey") % 3 == 0, "Labeling and Immunogenicity").when(F.col("p_partkey") % 3 == 1, "Quality").otherwise("x")
    return g.select("p_partkey", "title", "landing_url", "pdf_url", F.array_join(A.topics(extra), ",").alias("topics"))


@query("""WITH c AS (SELECT p_partkey, 'Title ' || p_partkey AS title, 'L' || p_partkey AS landing, CASE WHEN p_partkey % 9 > 0 THEN 'P' || p_partkey END AS pdf FROM part WHERE p_partkey % 2 = 0), u AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'L' ELSE 'P' END || p_partkey AS url, p_size % 5 = 0 AS gone FROM part WHERE p_partkey % 5 = 0)
SELECT 'P' || c.p_partkey AS source_url, CASE WHEN u.p_partkey IS NOT NULL THEN 'g' || u.p_partkey END AS guidance_id, false AS not_in_catalog FROM c LEFT JOIN u ON u.url = c.landing OR u.url = c.pdf WHERE pdf IS NOT NULL
UNION ALL SELECT url, 'g' || p_partkey, NOT gone FROM u WHERE p_partkey NOT IN (SELECT u.p_partkey FROM c JOIN u ON (u.url = c.landing OR u.url = c.pdf) WHERE pdf IS NOT NULL)""")
def enriched_guidances(spark, d):
    p = t(spark, d, "part")
    cat = p.filter("p_partkey % 2 = 0").select(col("concat('Title ', p_partkey)", "title"), col("concat('L', p_partkey)", "landing_url"), col("CASE WHEN p_partkey % 9 > 0 THEN concat('P', p_partkey) END", "pdf_url"), F.lit("final").alias("status"), F.lit("2020-01-01").alias("published_at"))
    cur = p.filter("p_partkey % 5 = 0").select(col("concat(CASE WHEN p_partkey % 3 = 0 THEN 'L' ELSE 'P' END, p_partkey)", "url"), col("concat('g', p_partkey)", "guidance_id"), col("CASE WHEN p_size % 5 = 0 THEN 'withdrawn' ELSE 'active' END", "status"), F.lit("2019").alias("published_at"), col("concat('Curated ', p_partkey)", "title"))
    return A.enriched(cat, cur).select("source_url", "guidance_id", "not_in_catalog")


@query("""SELECT DISTINCT 'prog' || (s_suppkey % 3) AS program_id, 'NCT' || p_partkey AS nct_id FROM part JOIN (SELECT DISTINCT s_suppkey FROM supplier) s ON contains('sb' || (p_partkey % 40) || 'trial' || regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') || 'org', 'sb' || s_suppkey)""")
def trial_search(spark, d):
    p = t(spark, d, "part").select(col("concat('NCT', p_partkey)", "nct_id"), col("concat('SB-', p_partkey % 40, ' trial')", "brief_title"), F.col("p_name").alias("official_title"), F.array().cast("array<string>").alias("other_ids"), F.lit("org").alias("org_id"))
    codes = t(spark, d, "supplier").select(col("concat('prog', s_suppkey % 3)", "program_id"), col("concat('SB ', s_suppkey)", "code"))
    return A.trials(p, codes)


@query("""WITH v AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC) AS k FROM lineitem)
SELECT o_orderkey AS doc_id, 'sha' || l_partkey AS doc_version_sha256, c_name AS brand_name, CASE WHEN o_custkey % 3 = 0 THEN 'US' WHEN o_custkey % 3 = 1 THEN 'EU' END AS jurisdiction, CASE o_orderpriority WHEN '1-URGENT' THEN 'unknown' ELSE 'regulator' END AS default_speaker, 'p' || (o_custkey % 4) AS program_id, CASE WHEN o_custkey % 4 < 3 THEN 'code,p' || (o_custkey % 4) ELSE '' END AS name_variants
FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_custkey % 2 = 0 LEFT JOIN v ON l_orderkey = o_orderkey AND k = 1""")
def document_metadata(spark, d):
    o = t(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"), col("CASE o_custkey % 3 WHEN 0 THEN 'fda' WHEN 1 THEN 'ema' ELSE 'xx' END", "agency"), F.lit("product").alias("doc_kind"), col("CASE o_orderpriority WHEN '1-URGENT' THEN 'odd' ELSE 'sbd' END", "doc_type"), F.lit("t").alias("title"), F.lit("u").alias("source_url"), F.col("o_custkey").alias("registration_id"), col("concat('p', o_custkey % 4)", "program_id"), F.lit(None).cast("string").alias("jurisdiction"))
    reg = t(spark, d, "customer").filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("registration_id"), F.col("c_name").alias("brand_name"), F.col("c_custkey").cast("string").alias("native_key"))
    prog = spark.range(3).select(col("concat('p', id)", "program_id"), F.lit("i").alias("ingredient"), F.lit("biosimilar").alias("role"), F.array(F.lit("code")).alias("codes"), F.lit(None).cast("array<string>").alias("aliases"))
    ver = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.struct("l_linenumber", "l_partkey").alias("id"), col("concat('sha', l_partkey)", "sha256"), F.lit("path").alias("path"), F.col("l_shipdate").alias("retrieved_at"))
    return A.metadata(o, reg, prog, ver).select("doc_id", "doc_version_sha256", "brand_name", "jurisdiction", "default_speaker", "program_id", F.array_join("name_variants", ",").alias("name_variants"))


# Metrics and logs.
_KINDS = "[" + ", ".join(f"'{k}'" for k in M.COUNTERS) + "]"


@query(f"""WITH e AS (SELECT user_id AS run_id, CASE WHEN user_id % 11 = 0 AND event_id % 10 = 1 THEN 'crash' ELSE {_KINDS}[(event_id % 10 + 1)::INT] END AS kind, CASE WHEN event_type = 'error' AND user_id % 3 > 0 THEN 'error' WHEN event_id % 4 = 0 THEN 'warning' ELSE 'info' END AS level, CASE WHEN user_id % 4 = 0 AND event_id % 10 IN (0, 4, 6) THEN 0 ELSE event_id % 3 END AS n FROM events),
c AS (SELECT run_id, {", ".join(f"sum(CASE WHEN kind = '{k}' THEN n ELSE 0 END)::BIGINT AS {k}" for k in M.COUNTERS)}, count(*) FILTER (level = 'error') AS errors, count(*) FILTER (level = 'warning') AS warnings, bool_or(kind = 'crash') AS crash FROM e GROUP BY 1)
SELECT * EXCLUDE (crash), CASE WHEN crash THEN 'failed' WHEN errors = 0 AND fetch_failed = 0 THEN 'ok' WHEN registrations > 0 OR fetched > 0 THEN 'partial' ELSE 'failed' END AS status FROM c""")
def run_status(spark, d):
    """Events of all runs appended to a stored log in two parts, and what the log says of each run."""
    kind = f"CASE WHEN user_id % 11 = 0 AND event_id % 10 = 1 THEN 'crash' ELSE element_at(array({_KINDS[1:-1]}), CAST(event_id % 10 + 1 AS INT)) END"
    e = t(spark, d, "events").select(F.col("user_id").cast("string").alias("run_id"), col(kind, "kind"), col("CASE WHEN event_type = 'error' AND user_id % 3 > 0 THEN 'error' WHEN event_id % 4 = 0 THEN 'warning' ELSE 'info' END", "level"), col("CASE WHEN user_id % 4 = 0 AND event_id % 10 IN (0, 4, 6) THEN 0 ELSE event_id % 3 END", "n"), (F.col("event_id") % 2).alias("_part"))
    log = RunLog(spark, stored_path(spark, "log"))
    for part in (0, 1):
        log.append(e.filter(F.col("_part") == part).drop("_part"))
    return M.run_counters(log.events()).withColumn("run_id", F.col("run_id").cast("long"))


def stored_path(spark, name: str) -> str:
    return f"{SH.shared_folder(spark)}/lodestone/{name}-{uuid.uuid4().hex}"


@query("SELECT coalesce(o.k, n.k) AS k, coalesce(nullif(n.v, ''), o.v) AS v, o.n AS n FROM (SELECT c_custkey AS k, c_name AS v, c_nationkey AS n FROM customer) o FULL JOIN (SELECT c_custkey + 100 AS k, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS v FROM customer) n ON o.k = n.k")
def stored_upsert(spark, d):
    """Two batches merged into a stored table, the first replayed: what the table holds."""
    c = t(spark, d, "customer")
    table = StoredTable(spark, stored_path(spark, "registrations"), "k long, v string, n long")
    first = c.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("v"), F.col("c_nationkey").cast("long").alias("n"))
    table.upsert("1", first, ["k"])
    table.upsert("2", c.select((F.col("c_custkey") + 100).alias("k"), col("CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END", "v")), ["k"])
    table.upsert("1", first, ["k"])
    return table.read()


@query("""SELECT o_custkey AS doc_id, o_orderpriority AS sha256, arg_min('p' || o_orderkey, strftime(o_orderdate, '%Y%m%d') || 'p' || o_orderkey) AS path, strftime(min(o_orderdate), '%Y-%m-%d') AS retrieved, strftime(max(o_orderdate), '%Y-%m-%d') AS verified FROM orders GROUP BY 1, 2""")
def stored_versions(spark, d):
    """Fetches of all years brought year by year into a stored version history."""
    o = t(spark, d, "orders").select(F.col("o_custkey").alias("doc_id"), F.col("o_orderpriority").alias("sha256"), col("concat('p', o_orderkey)", "path"), F.lit(1).cast("long").alias("size"), F.col("o_orderdate").cast("timestamp").alias("at"), F.year("o_orderdate").alias("y"))
    store = VersionStore(spark, stored_path(spark, "versions"))
    years = [r.y for r in o.select("y").distinct().orderBy("y").collect()]  # a few
    for y in [*years, *years[:1]]:
        store.add(str(y), o.filter(F.col("y") == y).drop("y"))
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return store.read().select("doc_id", "sha256", "path", day("retrieved_at").alias("retrieved"), day("last_verified_at").alias("verified"))


@query("""SELECT l_linestatus AS engine, l_returnflag AS status, count(*) AS n, sum(l_quantity)::BIGINT AS pages, sum(l_linenumber)::BIGINT AS seconds, round(sum(l_linenumber) / sum(l_quantity), 6) AS sec_per_page FROM lineitem GROUP BY 1, 2""")
def prep_status(spark, d):
    p = t(spark, d, "lineitem").select(F.col("l_linestatus").alias("engine"), F.col("l_returnflag").alias("status"), F.col("l_quantity").cast("long").alias("pages"), F.col("l_linenumber").cast("long").alias("seconds"), F.lit(0).alias("needs_review"))
    return M.prep_status(p).select("engine", "status", "n", "pages", "seconds", F.round("sec_per_page", 6).alias("sec_per_page"))


@query("""WITH r AS (SELECT c_mktsegment AS p, ['ema', 'fda'][(c_custkey % 2 + 1)::INT] AS a, c_custkey AS id, c_name AS brand, CASE WHEN c_nationkey < 20 THEN '20' || lpad(c_nationkey::VARCHAR, 2, '0') END AS dt FROM customer WHERE c_nationkey <> 3),
x AS (SELECT p, a, arg_min(brand, coalesce(dt, '9999') || lpad(id::VARCHAR, 9, '0')) AS b, count(*) - 1 AS n, min(dt) AS dt FROM r GROUP BY 1, 2), y AS (SELECT c_mktsegment AS p, ['ema', 'fda'][(c_custkey % 2 + 1)::INT] AS a, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2),
z AS (SELECT p, a, coalesce(b, '-') || CASE WHEN x.n > 0 THEN ' +' || x.n ELSE '' END || ' | ' || coalesce(dt, '-') || ' | ' || coalesce(f, 0) || '/' || coalesce(y.n, 0) AS cell FROM x FULL JOIN y USING (p, a)) SELECT p AS program_id, max(cell) FILTER (WHERE a = 'ema') AS ema, max(cell) FILTER (WHERE a = 'fda') AS fda FROM z GROUP BY 1""")
def status_pivot(spark, d):
    c, o = t(spark, d, "customer"), t(spark, d, "orders")
    agency = col("element_at(array('ema', 'fda'), CAST(c_custkey % 2 + 1 AS INT))", "agency")
    reg = c.filter("c_nationkey != 3").select(F.col("c_mktsegment").alias("program_id"), agency, F.col("c_custkey").alias("reg_id"), F.col("c_name").alias("brand"), col("CASE WHEN c_nationkey < 20 THEN concat('20', lpad(CAST(c_nationkey AS STRING), 2, '0')) END", "approved"))
    docs = o.join(c, o.o_custkey == c.c_custkey).select(F.col("c_mktsegment").alias("program_id"), agency, F.when(F.col("o_orderstatus") == "F", "fetched").otherwise("pending").alias("status"))
    return M.status_cells(reg, docs, ["ema", "fda"])


@query("""WITH g AS (SELECT l_orderkey AS page, l_linenumber % 2 AS tbl, l_returnflag || l_linestatus AS value, count(*) AS a FROM lineitem GROUP BY 1, 2, 3), f AS (SELECT l_orderkey AS page, l_suppkey % 2 AS tbl, l_returnflag || l_linestatus AS value, count(*) AS b FROM lineitem WHERE l_quantity > 10 GROUP BY 1, 2, 3)
SELECT page, g.tbl::BIGINT AS gold_table, f.tbl::BIGINT AS "table", sum(least(a, b))::BIGINT AS overlap FROM g JOIN f USING (page, value) GROUP BY 1, 2, 3""")
def table_overlaps(spark, d):
    l = t(spark, d, "lineitem").withColumn("value", F.concat("l_returnflag", "l_linestatus"))
    gold = l.select(F.col("l_orderkey").alias("page"), (F.col("l_linenumber") % 2).cast("long").alias("tbl"), "value")
    return M.overlaps(gold, l.filter("l_quantity > 10").select(F.col("l_orderkey").alias("page"), (F.col("l_suppkey") % 2).alias("tbl"), "value"))


@query("""WITH g AS (SELECT l_orderkey AS page, l_linenumber % 2 AS tbl, l_returnflag || l_linestatus AS value, count(*) AS a FROM lineitem GROUP BY 1, 2, 3), f AS (SELECT l_orderkey AS page, l_suppkey % 2 AS tbl, l_returnflag || l_linestatus AS value, count(*) AS b FROM lineitem WHERE l_quantity > 10 GROUP BY 1, 2, 3),
o AS (SELECT page, g.tbl AS gt, f.tbl AS ft, sum(least(a, b)) AS n FROM g JOIN f USING (page, value) GROUP BY 1, 2, 3), one AS (SELECT page, min(gt) AS gt, arg_min(ft, (gt * 1000000 - n * 10 + ft)) AS ft FROM o GROUP BY 1),
two AS (SELECT o.page, o.gt, min(o.ft) AS ft FROM o JOIN one ON one.page = o.page AND o.gt > one.gt AND o.ft <> one.ft GROUP BY 1, 2) SELECT page, gt::BIGINT AS gold_table, ft::BIGINT AS "table" FROM (SELECT * FROM one UNION ALL SELECT * FROM two)""")
def table_matching(spark, d):
    l = t(spark, d, "lineitem").withColumn("value", F.concat("l_returnflag", "l_linestatus"))
    gold = l.select(F.col("l_orderkey").alias("page"), (F.col("l_linenumber") % 2).cast("long").alias("tbl"), "value")
    return M.matched(gold, l.filter("l_quantity > 10").select(F.col("l_orderkey").alias("page"), (F.col("l_suppkey") % 2).alias("tbl"), "value"))


@query(f"""WITH l AS ({_LINES}) SELECT doc_id AS doc, pos // 7 AS page, string_agg(regexp_replace(lower(line), '\\s+', '', 'g'), '' ORDER BY pos) AS body FROM l GROUP BY 1, 2""")
def gold_page_texts(spark, d):
    b = _lines(spark, d).select(F.col("doc_id").alias("doc"), col("pos DIV 7", "page"), "pos", F.col("line").alias("text"))
    return M.page_texts(b)


@query("""SELECT 'raw/web/' || substr(sha, 1, 2) || '/' || sha || '.html' AS key FROM (SELECT DISTINCT sha256(html) AS sha FROM pages) WHERE sha NOT IN (SELECT sha256(html) FROM pages WHERE page_id % 3 = 0)""")
def content_addressed_put(spark, d):
    p = t(spark, d, "pages").select("page_id", F.sha2("html", 256).alias("sha256"), F.lit("web").alias("agency"), F.lit(".html").alias("ext"))
    stored = p.filter("page_id % 3 = 0").select(F.concat(F.lit("raw/web/"), F.substring("sha256", 1, 2), F.lit("/"), "sha256", F.lit(".html")).alias("key"))
    return O.missing_objects(p.drop("page_id"), stored).select("key")


@query("""WITH RECURSIVE """ + NEAR_PAIRS + """, o AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS i FROM (SELECT a AS doc_id FROM p UNION SELECT b FROM p)),
e AS (SELECT 0::BIGINT AS i, []::BIGINT[] AS reps, NULL::BIGINT AS doc_id, NULL::BIGINT AS rep UNION ALL
 SELECT o.i, CASE WHEN m.r IS NULL THEN list_append(e.reps, o.doc_id) ELSE e.reps END, o.doc_id, coalesce(m.r, o.doc_id) FROM e JOIN o ON o.i = e.i + 1, LATERAL (SELECT min(p.a) AS r FROM p WHERE p.b = o.doc_id AND list_contains(e.reps, p.a)) m)
SELECT d.doc_id, coalesce(e.rep, k.rep, d.doc_id) AS representative FROM documents d LEFT JOIN k USING (doc_id) LEFT JOIN e ON e.doc_id = k.rep AND e.i > 0""")
def near_dup_reps(spark, d):
    """Greedy election in id order over the classes' representatives, whose verdict holds for all members: copies have the same earlier neighbours."""
    shared_folder(spark)
    docs = t(spark, d, "documents")
    member, between = ND.near_classes(docs)
    return L.elected_members(member, between, docs.select("doc_id", F.col("doc_id").alias("rank")))
