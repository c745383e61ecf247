"""Resolution, claims, planning, index, structure, table, narrative and store rules: each maps driver tables onto the inputs of a library operator, beside its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone.functions import text as X
from lodestone.operators import claims as C
from lodestone.operators import indexing as I
from lodestone.operators import metrics as M
from lodestone.operators import narrative as N
from lodestone.operators import relational as R
from lodestone.operators import resolution as E
from lodestone.operators import search as Q
from lodestone.operators import selection as L
from lodestone.operators import structure as S
from lodestone.operators import tables as T
from lodestone.operators.shared import task_count
from lodestone.plans.retrieval_queries import t
from lodestone.sources import agencies as A
from lodestone.sources import stores as O

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def col(expr: str, name: str):
    return F.expr(expr).alias(name)


def shared_folder(spark) -> None:
    """Names the checkpoint folder: the session's, or a temporary one in local mode only."""
    if not spark.sparkContext.getCheckpointDir():
        found = spark.conf.get("spark.checkpoint.dir", None)
        if not found and not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        import tempfile

        spark.sparkContext.setCheckpointDir(found or tempfile.mkdtemp())


_ALIAS = "(SELECT DISTINCT split_part(p_name, ' ', 1) AS alias FROM part)"


@query(f"""WITH c AS (SELECT p_partkey, regexp_replace(lower(p_name), '[^a-z0-9]+', '', 'g') AS c FROM part), a AS (SELECT alias, regexp_replace(lower(alias), '[^a-z0-9]+', '', 'g') AS a FROM {_ALIAS})
SELECT p_partkey, alias FROM c JOIN a ON c = a OR (length(a) >= 5 AND starts_with(c, a))""")
def name_match_theta(spark, d):
    p = t(spark, d, "part")
    names, aliases = p.select("p_partkey", F.col("p_name").alias("name")), p.select(F.split("p_name", " ")[0].alias("alias")).distinct()
    return E.name_matches(names, aliases).select("p_partkey", "alias")


_PROGRAMS = """a AS (SELECT 'P' || w AS program_id, (row_number() OVER (ORDER BY w))::INT AS ord, w AS alias, ['fda', 'ema', 'hc'][(length(w) % 3 + 1)::INT] AS agency FROM (SELECT DISTINCT split_part(p_name, ' ', 1) AS w FROM part)
  UNION ALL SELECT 'B' || b, (100 + row_number() OVER (ORDER BY b))::INT, b, NULL FROM (SELECT DISTINCT p_brand AS b FROM part)),
r AS (SELECT p_partkey AS reg_id, ['fda', 'ema', 'hc'][(p_partkey % 3 + 1)::INT] AS agency, unnest([p_name, p_brand]) AS name FROM part),
n AS (SELECT reg_id, agency, regexp_replace(lower(name), '[^a-z0-9]+', '', 'g') AS c FROM r), m AS (SELECT *, regexp_replace(lower(alias), '[^a-z0-9]+', '', 'g') AS al FROM a)"""


def _program_aliases(spark, d):
    from pyspark.sql import Window as W

    p = t(spark, d, "part")
    words = p.select(F.split("p_name", " ")[0].alias("alias")).distinct()
    first = words.select(F.concat(F.lit("P"), "alias").alias("program_id"), F.row_number().over(W.orderBy("alias")).alias("ord"), "alias", col("element_at(array('fda', 'ema', 'hc'), CAST(length(alias) % 3 + 1 AS INT))", "agency"))
    brands = p.select(F.col("p_brand").alias("alias")).distinct()
    return first.unionByName(brands.select(F.concat(F.lit("B"), "alias").alias("program_id"), (F.row_number().over(W.orderBy("alias")) + 100).alias("ord"), "alias", F.lit(None).cast("string").alias("agency")))


def _part_registrations(spark, d):
    return t(spark, d, "part").select(F.col("p_partkey").alias("reg_id"), col("element_at(array('fda', 'ema', 'hc'), CAST(p_partkey % 3 + 1 AS INT))", "agency"), F.array("p_name", "p_brand").alias("names"))


@query(f"""WITH {_PROGRAMS} SELECT reg_id, arg_min(program_id, (CASE WHEN m.agency = n.agency THEN 0 ELSE 1 END) * 1000 + ord) AS program_id FROM n JOIN m ON c = al OR (length(al) >= 5 AND starts_with(c, al)) GROUP BY reg_id""")
def program_match(spark, d):
    return E.match_programs(_part_registrations(spark, d), _program_aliases(spark, d))


@query(f"""WITH {_PROGRAMS} SELECT DISTINCT reg_id FROM n WHERE EXISTS (SELECT 1 FROM m WHERE program_id LIKE 'Ps%' AND (c = al OR (length(al) >= 5 AND starts_with(c, al))))""")
def excluded_registrations(spark, d):
    return E.excluded(_part_registrations(spark, d), _program_aliases(spark, d).filter("program_id LIKE 'Ps%'")).select("reg_id")


@query("""SELECT p_partkey AS row_id FROM part WHERE starts_with(regexp_replace(lower(p_name), '[^a-z0-9]+', '', 'g'), 'small') OR contains(lower(p_type), 'promo')""")
def catalog_keep(spark, d):
    rows = t(spark, d, "part").select(F.col("p_partkey").alias("row_id"), F.col("p_name").alias("name"), F.col("p_type").alias("ingredient"))
    return E.kept_rows(rows, spark.createDataFrame([("Small",)], "alias string"), ["Promo"], False).select("row_id")


_REG = """r AS (SELECT s_suppkey AS id, ['fda', 'ema', 'hc'][(s_suppkey % 3 + 1)::INT] AS agency, substr(md5((s_suppkey % 61)::VARCHAR), 1, CASE WHEN s_suppkey % 7 = 0 THEN 7 ELSE 8 END) || CASE WHEN s_suppkey % 7 = 0 THEN 'z' ELSE '' END AS name,
  'h' || (s_suppkey % 37)::VARCHAR AS who, CASE WHEN s_suppkey % 11 = 0 THEN true WHEN s_suppkey % 5 = 0 THEN NULL ELSE false END AS ref, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE '20' || lpad((s_suppkey % 90 + 10)::VARCHAR, 2, '0') END AS approved FROM supplier),
e1 AS (SELECT x.id AS a, y.id AS b, CASE WHEN x.name = y.name THEN 'same_brand' WHEN x.agency = y.agency THEN 'same_holder' ELSE 'similar_name' END AS rule FROM r x JOIN r y ON x.id < y.id AND (x.name = y.name OR (x.ref IS DISTINCT FROM true AND y.ref IS DISTINCT FROM true AND
  CASE WHEN x.agency = y.agency THEN x.agency = 'ema' AND x.who = y.who ELSE levenshtein(x.name, y.name) <= 1 OR (levenshtein(x.name, y.name) <= 3 AND substr(x.name, 1, 3) = substr(y.name, 1, 3)) END)))"""
_CLOSURE = """u1 AS (SELECT a, b FROM e1 UNION SELECT b, a FROM e1), w1 AS (SELECT id, id AS c FROM r UNION SELECT u1.b, w1.c FROM w1 JOIN u1 ON u1.a = w1.id), c1 AS (SELECT id, min(c) AS c FROM w1 GROUP BY id),
h AS (SELECT who, agency, count(DISTINCT c) AS n FROM r JOIN c1 USING (id) WHERE ref IS DISTINCT FROM true GROUP BY 1, 2), ha AS (SELECT who, count(DISTINCT c) AS n FROM r JOIN c1 USING (id) WHERE ref IS DISTINCT FROM true GROUP BY 1),
g AS (SELECT h.who FROM h JOIN ha USING (who) GROUP BY h.who HAVING max(h.n) = 1 AND max(ha.n) > 1), f AS (SELECT who, min(id) AS a FROM r WHERE ref IS DISTINCT FROM true AND who IN (SELECT who FROM g) GROUP BY 1),
e2 AS (SELECT * FROM e1 UNION ALL SELECT f.a, r.id, 'same_holder_cross' FROM r JOIN f USING (who) WHERE ref IS DISTINCT FROM true AND r.id <> f.a),
u2 AS (SELECT a, b FROM e2 UNION SELECT b, a FROM e2), w2 AS (SELECT id, id AS c FROM r UNION SELECT u2.b, w2.c FROM w2 JOIN u2 ON u2.a = w2.id), c2 AS (SELECT id, min(c) AS cluster FROM w2 GROUP BY id)"""


def _registrations(spark, d):
    s = t(spark, d, "supplier")
    brand = "concat(substring(md5(CAST(s_suppkey % 61 AS STRING)), 1, CASE WHEN s_suppkey % 7 = 0 THEN 7 ELSE 8 END), CASE WHEN s_suppkey % 7 = 0 THEN 'z' ELSE '' END)"
    return s.select(F.col("s_suppkey").alias("id"), col("element_at(array('fda', 'ema', 'hc'), CAST(s_suppkey % 3 + 1 AS INT))", "agency"), col(brand, "brand"), col("concat('H', CAST(s_suppkey % 37 AS STRING), ' Holdings Ltd.')", "holder"), col("CASE WHEN s_suppkey % 11 = 0 THEN true WHEN s_suppkey % 5 = 0 THEN NULL ELSE false END", "reference"), col("CASE WHEN s_suppkey % 4 != 0 THEN concat('20', lpad(CAST(s_suppkey % 90 + 10 AS STRING), 2, '0')) END", "approved"))


@query(f"""WITH RECURSIVE {_REG}, {_CLOSURE} SELECT id, cluster, coalesce((SELECT array_to_string(list_sort(list(DISTINCT rule)), ',') FROM e2 JOIN c2 x ON x.id = e2.a WHERE x.cluster = c2.cluster), 'single_registration') AS basis FROM c2""")
def registration_clusters(spark, d):
    shared_folder(spark)
    return E.clusters(_registrations(spark, d)).select("id", "cluster", F.array_join("basis", ",").alias("basis"))


@query(f"""WITH RECURSIVE {_REG}, {_CLOSURE}, m AS (SELECT r.*, cluster, CASE agency WHEN 'fda' THEN 0 WHEN 'ema' THEN 1 ELSE 2 END AS place, coalesce(approved, '9999') AS dt FROM r JOIN c2 USING (id)),
p AS (SELECT cluster, bool_or(ref IS true AND agency = 'fda') AS fda, bool_or(ref IS true) AS anyref, min(dt) AS first, count(*) AS n, arg_min(id, place || dt || lpad(id::VARCHAR, 9, '0')) AS lead, arg_min(name, place || dt || lpad(id::VARCHAR, 9, '0')) AS base FROM m GROUP BY 1),
k AS (SELECT *, row_number() OVER (PARTITION BY lower(base) ORDER BY first, lead) AS k, bool_or(fda) OVER () AS any_fda FROM p)
SELECT cluster, CASE WHEN k = 1 THEN base ELSE base || '-' || k END AS program_id, CASE WHEN fda OR (anyref AND NOT any_fda) THEN 'reference' ELSE 'biosimilar' END AS role, lead, n FROM k""")
def cluster_programs(spark, d):
    shared_folder(spark)
    marked = E.clusters(_registrations(spark, d))
    return E.programs(marked, spark.createDataFrame([], "name string")).select("cluster", "program_id", "role", "lead", "n")


@query(f"""WITH {_REG} SELECT a, b FROM (SELECT x.id AS a, y.id AS b, x.name AS x, y.name AS y FROM r x JOIN r y ON x.id < y.id AND x.name <> y.name) WHERE levenshtein(x, y) <= 1 OR (levenshtein(x, y) <= 3 AND substr(x, 1, 3) = substr(y, 1, 3))""")
def similar_name_pairs(spark, d):
    return E.similar_names(_registrations(spark, d).select("id", F.col("brand").alias("name")))


@query("""SELECT l_suppkey, l_returnflag AS flag FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, first, l_returnflag) AS k FROM (SELECT l_suppkey, l_returnflag, count(*) AS n, min(l_orderkey * 10 + l_linenumber) AS first FROM lineitem GROUP BY 1, 2)) WHERE k = 1""")
def majority_value(spark, d):
    rows = t(spark, d, "lineitem").select("l_suppkey", F.col("l_returnflag").alias("flag"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("o"))
    return E.majority(rows, ["l_suppkey"], "flag", "o")


_CLAIM = """c AS (SELECT o_orderkey AS claim_id, CASE WHEN o_orderkey % 29 = 0 THEN ' ' ELSE 'Brand ' || (o_custkey % 4) || ' lists ' || (o_orderkey % 40) END AS text, CASE WHEN o_orderkey % 23 = 0 THEN 'guess' ELSE 'fact' END AS kind,
  CASE WHEN o_orderkey % 3 = 0 THEN []::VARCHAR[] WHEN o_orderkey % 7 = 0 THEN ['B' || (o_orderkey % 4)] ELSE ['B' || (o_custkey % 4)] END AS products, CASE WHEN o_orderkey % 17 = 0 THEN ['S1', 'S99'] WHEN o_orderkey % 19 = 0 THEN [] ELSE ['S1', 'S2', 'S3', 'S4', 'S5', 'S6', 'S7'] END AS spans FROM orders),
s AS (SELECT l_orderkey AS answer_id, 'S' || l_linenumber AS sid, min(CASE WHEN l_partkey % 5 < 4 THEN 'B' || (l_partkey % 4) END) AS product, min('quantity ' || l_quantity::INT || ' of ' || (l_partkey % 40)) AS text, bool_or(l_returnflag = 'R') AS review FROM lineitem GROUP BY 1, 2)"""


def _claims(spark, d):
    o = t(spark, d, "orders")
    return o.select(
        F.col("o_orderkey").alias("claim_id"), F.col("o_orderkey").alias("answer_id"), col("CASE WHEN o_orderkey % 29 = 0 THEN ' ' ELSE concat('Brand ', o_custkey % 4, ' lists ', o_orderkey % 40) END", "text"), col("CASE WHEN o_orderkey % 23 = 0 THEN 'guess' ELSE 'fact' END", "kind"),
        col("CASE WHEN o_orderkey % 3 = 0 THEN CAST(array() AS ARRAY<STRING>) WHEN o_orderkey % 7 = 0 THEN array(concat('B', o_orderkey % 4)) ELSE array(concat('B', o_custkey % 4)) END", "products"),
        col("CASE WHEN o_orderkey % 17 = 0 THEN array('S1', 'S99') WHEN o_orderkey % 19 = 0 THEN CAST(array() AS ARRAY<STRING>) ELSE array('S1', 'S2', 'S3', 'S4', 'S5', 'S6', 'S7') END", "spans"),
    )


def _spans(spark, d):
    l = t(spark, d, "lineitem")
    return l.groupBy(F.col("l_orderkey").alias("answer_id"), col("concat('S', l_linenumber)", "sid")).agg(col("min(CASE WHEN l_partkey % 5 < 4 THEN concat('B', l_partkey % 4) END)", "product"), col("min(concat('quantity ', CAST(l_quantity AS INT), ' of ', l_partkey % 40))", "text"), col("bool_or(l_returnflag = 'R')", "needs_review"))


def _answers(spark, d):
    """Claims whose seven spans do not all exist cite those that do."""
    c, s = _claims(spark, d), _spans(spark, d)
    there = s.groupBy("answer_id").agg(F.collect_set("sid").alias("_there"))
    j = c.join(there, "answer_id", "left")
    return j.withColumn("spans", F.when(F.size("spans") == 7, F.array_intersect("spans", F.coalesce("_there", F.array().cast("array<string>")))).otherwise(F.col("spans"))).drop("_there"), s


@query(f"""WITH {_CLAIM}, x AS (SELECT c.* EXCLUDE (spans), CASE WHEN len(spans) = 7 THEN list_filter(spans, lambda z: list_contains(coalesce(t.sids, []), z)) ELSE spans END AS spans FROM c LEFT JOIN (SELECT answer_id, list(sid) AS sids FROM s GROUP BY 1) t ON t.answer_id = c.claim_id),
m AS (SELECT claim_id, bool_or(s.sid IS NULL) AS unknown, list(DISTINCT s.product) FILTER (WHERE s.product IS NOT NULL) AS cited, flatten(list(regexp_extract_all(coalesce(s.text, ''), '[0-9]+'))) AS held, bool_or(coalesce(s.review, false)) AS review FROM (SELECT claim_id, unnest(spans) AS sid FROM x) q LEFT JOIN s ON s.answer_id = q.claim_id AND s.sid = q.sid GROUP BY 1),
v AS (SELECT x.*, coalesce(cited, []) AS cited, coalesce(held, []) AS held, coalesce(unknown, true) AS unknown, coalesce(review, false) AS review, 'B' || regexp_extract(text, 'Brand ([0-3])', 1) AS named, regexp_extract_all(regexp_replace(text, 'Brand [0-3]', ' '), '[0-9]+') AS nums FROM x LEFT JOIN m USING (claim_id)),
w AS (SELECT *, CASE WHEN trim(text) = '' OR kind = 'guess' OR len(spans) = 0 THEN 'invalid_claim_shape' WHEN unknown THEN 'unknown_span_id' WHEN len(list_filter(products, lambda p: NOT list_contains(cited, p))) > 0 THEN 'product_not_in_cited_sources' WHEN len(cited) > 0 AND len(products) = 0 THEN 'product_scope_missing'
 WHEN NOT list_contains(products, named) THEN 'named_product_not_declared' WHEN len(list_filter(nums, lambda n: NOT list_contains(held, n))) > 0 THEN 'number_not_in_cited_sources' ELSE 'accepted' END AS verdict FROM v)
SELECT claim_id, verdict, CASE WHEN verdict = 'number_not_in_cited_sources' THEN array_to_string(list_sort(list_distinct(list_filter(nums, lambda n: NOT list_contains(held, n)))), ',') ELSE '' END AS missing, review AS needs_review FROM w""")
def claim_check(spark, d):
    names = spark.createDataFrame([(f"B{i}", X.name_pattern(f"Brand {i}")) for i in range(4)], "product string, pattern string")
    claims, spans = _answers(spark, d)
    return C.check(claims, spans, names).select("claim_id", "verdict", F.array_join("missing", ",").alias("missing"), "needs_review")


@query(f"""WITH {_CLAIM}, n AS (SELECT o_orderkey, count(s.sid) AS n FROM orders LEFT JOIN s ON answer_id = o_orderkey GROUP BY 1)
SELECT o_orderkey, CASE WHEN o_orderkey % 31 = 0 THEN 'dry_run' WHEN o_orderstatus = 'P' THEN 'error' WHEN n = 0 OR o_orderkey % 5 = 0 THEN 'not_found' WHEN o_orderkey % 3 > 0 THEN 'partial' ELSE 'answered' END AS status FROM orders JOIN n USING (o_orderkey)""")
def answer_states(spark, d):
    n = _spans(spark, d).groupBy(F.col("answer_id").alias("o_orderkey")).agg(F.count("sid").alias("n"))
    o = t(spark, d, "orders").join(n, "o_orderkey", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    k = F.col("o_orderkey")
    return o.select("o_orderkey", C.answer_status(F.col("n"), k % 5, k % 3, F.col("o_orderstatus") == "P", k % 31 == 0).alias("status"))


_HIT = """h AS (SELECT l_orderkey AS search, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rank, l_partkey AS chunk_id, CASE WHEN l_suppkey % 3 > 0 THEN 'p' || (l_suppkey % 4) END AS parent_key, l_returnflag AS product, l_suppkey AS document_id, l_quantity AS score, l_tax > 0.06 AS needs_review, l_linestatus AS speaker, l_quantity::BIGINT AS cost FROM lineitem),
b AS (SELECT search, coalesce('p:' || parent_key, 'c:' || chunk_id) AS block_key, min(rank) AS first_rank, arg_min(product, rank) AS product, arg_min(document_id, rank) AS document_id, max(score) AS score, bool_or(needs_review) AS needs_review, count(*) AS n_chunks, arg_min(cost, rank) AS cost FROM h GROUP BY 1, 2)"""


def _hits(spark, d):
    from pyspark.sql import Window as W

    l = t(spark, d, "lineitem")
    w = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return l.select(F.col("l_orderkey").alias("search"), F.row_number().over(w).alias("rank"), F.col("l_partkey").alias("chunk_id"), col("CASE WHEN l_suppkey % 3 > 0 THEN concat('p', l_suppkey % 4) END", "parent_key"), F.col("l_returnflag").alias("product"), F.col("l_suppkey").alias("document_id"), F.col("l_quantity").alias("score"), (F.col("l_tax") > 0.06).alias("needs_review"), F.col("l_linestatus").alias("speaker"), F.col("l_quantity").cast("long").cast("string").alias("text"))


@query(f"""WITH {_HIT}, sp AS (SELECT search, block_key, array_to_string(list(speaker ORDER BY r), ',') AS speakers FROM (SELECT search, coalesce('p:' || parent_key, 'c:' || chunk_id) AS block_key, speaker, min(rank) AS r FROM h GROUP BY 1, 2, 3) GROUP BY 1, 2)
SELECT search, 'E' || row_number() OVER (PARTITION BY search ORDER BY first_rank) AS block_id, block_key, product, document_id, score, needs_review, speakers, n_chunks FROM b JOIN sp USING (search, block_key)""")
def evidence_blocks(spark, d):
    return C.blocks(_hits(spark, d)).select("search", "block_id", "block_key", "product", "document_id", "score", "needs_review", F.array_join("speakers", ",").alias("speakers"), F.size("chunk_ids").cast("long").alias("n_chunks"))


@query(f"""WITH RECURSIVE {_HIT}, o AS (SELECT *, min(first_rank) OVER (PARTITION BY search, product) AS met, row_number() OVER (PARTITION BY search, product ORDER BY first_rank) AS nth FROM b),
i AS (SELECT *, row_number() OVER (PARTITION BY search ORDER BY nth, met) AS turn FROM o),
f AS (SELECT search, block_key, turn, cost, CASE WHEN cost <= 60 THEN cost ELSE 0 END AS used, cost <= 60 AS admitted FROM i WHERE turn = 1
 UNION ALL SELECT i.search, i.block_key, i.turn, i.cost, CASE WHEN f.used + i.cost <= 60 THEN f.used + i.cost ELSE f.used END, f.used + i.cost <= 60 FROM f JOIN i ON i.search = f.search AND i.turn = f.turn + 1)
SELECT search, block_key, turn::INT AS turn, admitted FROM f""")
def round_robin_pack(spark, d):
    blocks = C.blocks(_hits(spark, d)).withColumn("cost", F.col("text").cast("long"))
    return C.round_robin(blocks, 60).select("search", "block_key", "turn", "admitted")


_LINES = "SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents"


@query(f"""WITH l AS ({_LINES}), o AS (SELECT doc_id // 8 AS search, doc_id, pos, line, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM l)
SELECT search, doc_id, start, start + length(line) AS "end", 'S' || row_number() OVER (PARTITION BY search ORDER BY doc_id, pos) AS sid FROM o WHERE trim(line) <> ''""")
def segment_numbering(spark, d):
    docs = t(spark, d, "documents").select(F.expr("doc_id DIV 8").alias("search"), F.col("doc_id").alias("pos"), F.col("doc_id").cast("string").alias("block_id"), "text")
    return C.segments(docs).select("search", F.col("pos").alias("doc_id"), "start", "end", "sid")


_WORDS = Q.Routing(
    products=[("(?i)the", "P1"), ("(?i)tion", "P2"), ("(?i)enn", "P3")], agencies=[("(?i)que", "ema"), ("(?i)and", "fda")], guidance="(?i)ment|ungen", all_products="(?i)zu", reference="(?i)oo", doc_types=[("(?i)ier", ["label", "product_information"]), ("(?i)eur", ["review"])],
    label_sections=[("(?i)ra", "indications"), ("(?i)ou", "dosage")], biosimilars=["P1", "P2"], references=["P3"],
)
_RQ = """q AS (SELECT conv_id * 1000 + turn AS qid, text, regexp_matches(text, '(?i)the') AS a, regexp_matches(text, '(?i)tion') AS b, regexp_matches(text, '(?i)enn') AS c, regexp_matches(text, '(?i)zu') AS every, regexp_matches(text, '(?i)que') AS ema, regexp_matches(text, '(?i)and') AS fda, regexp_matches(text, '(?i)oo') AS oo,
  regexp_matches(text, '(?i)ment|ungen') AS guidance, regexp_matches(text, '(?i)ier') AS lab, regexp_matches(text, '(?i)eur') AS rev, regexp_matches(text, '(?i)ra') AS ra, regexp_matches(text, '(?i)ou') AS ou FROM conversations WHERE role = 'user'),
p AS (SELECT *, list_filter([CASE WHEN a THEN 'P1' END, CASE WHEN b THEN 'P2' END, CASE WHEN c THEN 'P3' END, CASE WHEN every AND NOT a THEN 'P1' END, CASE WHEN every AND NOT b THEN 'P2' END], lambda x: x IS NOT NULL) AS p0 FROM q),
z AS (SELECT *, c OR oo AS reference, CASE WHEN oo AND NOT c AND len(p0) > 0 THEN list_append(p0, 'P3') ELSE p0 END AS products, CASE WHEN ema <> fda THEN CASE WHEN ema THEN 'ema' ELSE 'fda' END END AS agency,
  list_filter([CASE WHEN lab THEN 'label' END, CASE WHEN lab THEN 'product_information' END, CASE WHEN rev THEN 'review' END], lambda x: x IS NOT NULL) AS types, CASE WHEN lab THEN list_filter([CASE WHEN ra THEN 'indications' END, CASE WHEN ou THEN 'dosage' END], lambda x: x IS NOT NULL) ELSE [] END AS secs FROM p)"""


def _questions(spark, d):
    return t(spark, d, "conversations").filter("role = 'user'").select((F.col("conv_id") * 1000 + F.col("turn")).alias("qid"), "text")


@query(f"WITH {_RQ} SELECT qid, array_to_string(products, ',') AS products, agency, guidance, reference, array_to_string(types, ',') AS doc_types, array_to_string(secs, ',') AS label_sections FROM z")
def route_questions(spark, d):
    r = Q.routed(_questions(spark, d), _WORDS)
    return r.select("qid", *[F.array_join(c, ",").alias(c) for c in ("products", "doc_types", "label_sections")], "agency", "guidance", "reference")


@query(f"""WITH {_RQ}, e AS (SELECT *, CASE WHEN NOT (len(products) > 0 OR agency IS NOT NULL OR guidance OR len(types) > 0) THEN ['open']
  WHEN len(products) > 0 THEN list_concat(CASE WHEN len(types) > 0 THEN flatten(list_transform(products, lambda x: [x || '|plain', x || '|typed'])) ELSE list_transform(products, lambda x: x || '|plain') END, CASE WHEN guidance THEN ['|rules'] ELSE [] END)
  WHEN len(types) > 0 THEN ['|scope', '|typed'] ELSE ['|scope'] END AS plan FROM z), s AS (SELECT *, unnest(plan) AS s, generate_subscripts(plan, 1) - 1 AS ord FROM e)
SELECT qid, ord::INT AS ord, CASE WHEN s <> 'open' AND split_part(s, '|', 1) <> '' THEN split_part(s, '|', 1) END AS product, CASE WHEN s <> 'open' THEN agency END AS agency, s = '|rules' OR (s = '|scope' AND guidance) AS guidance, CASE WHEN s = 'open' OR reference THEN '' ELSE 'P3' END AS excluded,
  CASE WHEN s LIKE '%typed' THEN array_to_string(types, ',') ELSE '' END AS doc_types, CASE WHEN s LIKE '%typed' THEN array_to_string(secs, ',') ELSE '' END AS label_sections FROM s""")
def search_plan_rows(spark, d):
    p = Q.planned(Q.routed(_questions(spark, d), _WORDS), _WORDS.references)
    return p.select("qid", "ord", "product", "agency", "guidance", *[F.array_join(c, ",").alias(c) for c in ("excluded", "doc_types", "label_sections")])


@query("""SELECT l_orderkey AS qid, l_partkey AS chunk_id, ord, rank, row_number() OVER (PARTITION BY l_orderkey ORDER BY ord, rank)::INT AS place FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY ord, rank) AS k FROM (SELECT l_orderkey, l_suppkey % 5 AS l_partkey, l_linenumber % 3 AS ord, (l_partkey * 100 + l_quantity)::BIGINT * 10 + l_linenumber AS rank FROM lineitem)) WHERE k = 1""")
def multi_search_dedup(spark, d):
    l = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("qid"), (F.col("l_suppkey") % 5).alias("chunk_id"), (F.col("l_linenumber") % 3).alias("ord"), ((F.col("l_partkey") * 100 + F.col("l_quantity")).cast("long") * 10 + F.col("l_linenumber")).alias("rank"))
    return Q.merged(l)


@query("""SELECT l_orderkey, l_linenumber, l_partkey AS chunk_id, coalesce('parent ' || s_name, 'own ' || p_name) AS parent_text FROM lineitem JOIN part ON p_partkey = l_partkey LEFT JOIN (SELECT * FROM supplier WHERE s_suppkey % 2 = 0) ON s_suppkey = p_partkey % 100""")
def hit_parent_join(spark, d):
    hits = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("chunk_id"))
    chunks = t(spark, d, "part").select(F.col("p_partkey").alias("chunk_id"), F.lit(1).alias("index_document_id"), (F.col("p_partkey") % 100).alias("parent_key"), F.concat(F.lit("own "), "p_name").alias("text"), F.array(F.lit(1)).alias("pages"))
    parents = t(spark, d, "supplier").filter("s_suppkey % 2 = 0").select(F.lit(1).alias("index_document_id"), F.col("s_suppkey").alias("parent_key"), F.concat(F.lit("parent "), "s_name").alias("text"), F.array(F.lit(2)).alias("pages"))
    return Q.with_parents(hits, chunks, parents).select("l_orderkey", "l_linenumber", "chunk_id", "parent_text")


@query("""WITH c AS (SELECT l_suppkey AS search, l_orderkey * 10 + l_linenumber AS chunk_id, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey) AS was, round(l_tax * 100)::BIGINT AS score FROM lineitem), u AS (SELECT search, chunk_id, min(was) AS was, arg_min(score, was) AS score FROM c GROUP BY 1, 2)
SELECT search, chunk_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY search ORDER BY score DESC, was)::INT AS rank FROM u) WHERE rank <= 10""")
def rerank_order(spark, d):
    from pyspark.sql import Window as W

    rows = t(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_tax")
    parts = task_count(rows.count())
    l = rows.repartition(parts, "l_suppkey").withColumn("rank", F.row_number().over(W.partitionBy("l_suppkey").orderBy("l_orderkey", "l_linenumber", "l_partkey")))
    c = l.select(F.col("l_suppkey").alias("search"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("chunk_id"), "rank", F.round(F.col("l_tax") * 100).cast("long").alias("score"))
    u = c.groupBy("search", "chunk_id").agg(F.min("rank").alias("rank"), F.min_by("score", "rank").alias("score"))
    return Q.reranked(u.select("search", "chunk_id", "rank"), u.select("search", "chunk_id", "score"), 10, parts).select("search", "chunk_id", "score", "rank")


_VERS = "v AS (SELECT o_custkey AS document_id, 'h' || (o_orderkey % 997) AS sha256, o_orderdate AS retrieved_at, o_orderkey AS id FROM orders), pr AS (SELECT l_orderkey * 10 + l_linenumber AS id, 'h' || (l_orderkey % 499) AS sha256, CASE WHEN l_suppkey % 2 = 0 THEN 'v2+a' ELSE 'v1+b' END AS engine, CASE WHEN l_orderkey % 499 % 5 = 1 THEN 'skipped' WHEN l_orderkey % 499 % 5 = 2 THEN 'failed' WHEN l_returnflag = 'R' THEN 'failed' ELSE 'ok' END AS status, 'why ' || l_linenumber AS reason, l_partkey FROM lineitem)"


@query(f"""WITH {_VERS}, n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY retrieved_at DESC, id DESC) AS k FROM v) WHERE k = 1),
g AS (SELECT sha256, bool_or(status = 'ok') AS ok, max(CASE WHEN status = 'ok' THEN (CASE WHEN engine LIKE 'v2+%' THEN 1 ELSE 0 END) * 1000000000 + id END) AS best, min(CASE WHEN status = 'skipped' THEN id END) AS sk FROM pr GROUP BY 1)
SELECT document_id, sha256, CASE WHEN ok THEN 'index' WHEN sk IS NOT NULL THEN 'retire' ELSE 'not_parsed' END AS action, CASE WHEN ok THEN CASE WHEN best >= 1000000000 THEN 'v2+a' ELSE 'v1+b' END END AS prep_engine, CASE WHEN ok THEN '' WHEN sk IS NOT NULL THEN 'prep skipped' WHEN g.sha256 IS NOT NULL THEN 'failed' ELSE 'not preprocessed yet' END AS reason FROM n LEFT JOIN g USING (sha256)""")
def index_candidates(spark, d):
    v = t(spark, d, "orders").select(F.col("o_custkey").alias("document_id"), col("concat('h', o_orderkey % 997)", "sha256"), F.col("o_orderdate").alias("retrieved_at"), F.col("o_orderkey").alias("id"))
    p = t(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), col("concat('h', l_orderkey % 499)", "sha256"), col("CASE WHEN l_suppkey % 2 = 0 THEN 'v2+a' ELSE 'v1+b' END", "engine"), col("CASE WHEN l_orderkey % 499 % 5 = 1 THEN 'skipped' WHEN l_orderkey % 499 % 5 = 2 THEN 'failed' WHEN l_returnflag = 'R' THEN 'failed' ELSE 'ok' END", "status"), col("concat('why ', l_linenumber)", "reason"))
    return I.candidates(v, p, "v2").withColumn("reason", F.regexp_replace("reason", "^prep skipped:.*", "prep skipped"))


_KEY = "document_id, sha256, prep_engine, chunker, embed_model, meta_hash"


@query(f"""WITH w AS (SELECT c_custkey AS document_id, 's' || (c_custkey % 3) AS sha256, 'e' AS prep_engine, 'c' AS chunker, 'm' AS embed_model, c_mktsegment AS meta_hash FROM customer WHERE c_custkey % 4 > 0),
s AS (SELECT c_custkey AS index_id, c_custkey AS document_id, 's' || (c_nationkey % 3) AS sha256, 'e' AS prep_engine, 'c' AS chunker, 'm' AS embed_model, c_mktsegment AS meta_hash, CASE WHEN c_custkey % 10 = 3 THEN 'failed' ELSE 'ok' END AS status, c_acctbal < 2000 AS retired FROM customer WHERE c_custkey % 5 > 0)
SELECT document_id, sha256, index_id, CASE WHEN w.meta_hash IS NOT NULL AND status = 'ok' AND NOT retired THEN 'cached' WHEN w.meta_hash IS NOT NULL AND status = 'ok' THEN 'reactivated' WHEN w.meta_hash IS NOT NULL THEN 'indexed' WHEN document_id IN (SELECT document_id FROM w) AND NOT retired THEN 'retired' ELSE 'kept' END AS outcome FROM w FULL JOIN s USING ({_KEY})""")
def incremental_actions(spark, d):
    c = t(spark, d, "customer")
    key = lambda h: [F.col("c_custkey").alias("document_id"), F.concat(F.lit("s"), (F.col(h) % 3).cast("string")).alias("sha256"), F.lit("e").alias("prep_engine"), F.lit("c").alias("chunker"), F.lit("m").alias("embed_model"), F.col("c_mktsegment").alias("meta_hash")]
    wanted = c.filter("c_custkey % 4 > 0").select(*key("c_custkey"))
    stored = c.filter("c_custkey % 5 > 0").select(F.col("c_custkey").alias("index_id"), *key("c_nationkey"), col("CASE WHEN c_custkey % 10 = 3 THEN 'failed' ELSE 'ok' END", "status"), (F.col("c_acctbal") < 2000).alias("retired"))
    return I.decided(wanted, stored).select("document_id", "sha256", "index_id", "outcome")


@query("""WITH s AS (SELECT sha256(p_brand) AS h, arg_min(p_partkey, p_partkey) AS vector FROM part WHERE p_partkey % 2 = 0 GROUP BY 1), c AS (SELECT p_partkey AS chunk_id, sha256(p_brand || (p_partkey % 2)) AS h1, sha256(p_brand) AS h2 FROM part)
SELECT chunk_id, vector FROM (SELECT chunk_id, CASE WHEN chunk_id % 3 = 0 THEN h1 ELSE h2 END AS h FROM c) JOIN s USING (h)""")
def vector_reuse(spark, d):
    p = t(spark, d, "part")
    texts = p.select(F.col("p_partkey").alias("chunk_id"), F.sha2(F.when(F.col("p_partkey") % 3 == 0, F.concat("p_brand", (F.col("p_partkey") % 2).cast("string"))).otherwise(F.col("p_brand")), 256).alias("embed_hash"))
    stored = p.filter("p_partkey % 2 = 0").select(F.sha2("p_brand", 256).alias("embed_hash"), F.col("p_partkey").alias("id"), F.col("p_partkey").alias("vector"))
    return I.to_embed(texts, stored)[0].select("chunk_id", "vector")


@query("""SELECT o_custkey, h, coalesce(r0, seen) AS retrieved_at, coalesce(seen, v0) AS last_verified_at, r0 IS NULL AS is_new FROM (SELECT o_custkey, o_orderpriority AS h, min(o_orderdate) AS r0, max(o_orderdate) AS v0 FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2)
FULL JOIN (SELECT o_custkey, o_orderpriority AS h, max(o_orderdate) AS seen FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1, 2) USING (o_custkey, h)""")
def version_history(spark, d):
    o = t(spark, d, "orders").withColumnRenamed("o_orderpriority", "h")
    old = o.filter("o_orderstatus = 'F'").groupBy("o_custkey", "h").agg(F.min("o_orderdate").alias("retrieved_at"), F.max("o_orderdate").alias("last_verified_at"))
    return R.add_versions(old, o.filter("o_orderstatus != 'F'").select("o_custkey", "h", F.col("o_orderdate").alias("at")), ["o_custkey"], "h", "at")
