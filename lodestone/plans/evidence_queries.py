"""Keyword search, parity and recall reports, catalog folds, boxes, carried scopes and question rewriting over the driver tables, each with its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.functions import text as X
from lodestone.operators import relational as R
from lodestone.operators import sections, trigrams
from lodestone.operators import search as Q
from lodestone.operators import spatial as SP
from lodestone.plans.retrieval_queries import _V, asked, t, vectors

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


MUST, SOME = ["(?i)[aeiou]{2}"], ["(?i)secret|token|license", "[0-9]{3,}"]
_hits = lambda p: f"len(regexp_extract_all(line, '{p}'))"


@query(f"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS block FROM documents)
SELECT doc_id, block::INTEGER AS block, ({' + '.join(map(_hits, [*MUST, *SOME]))})::BIGINT AS score FROM l
WHERE {' AND '.join(_hits(p) + ' > 0' for p in MUST)} AND ({' OR '.join(_hits(p) + ' > 0' for p in SOME)}) ORDER BY score DESC, doc_id, block LIMIT 20""")
def locate_keywords(spark, d):
    """The 20 blocks with most matches: every MUST pattern and one of SOME."""
    lines = t(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("block", "line"))
    n = {p: F.regexp_count("line", F.lit(p)) for p in [*MUST, *SOME]}
    every = lines.filter(" AND ".join(f"line rlike '{p}'" for p in MUST)).filter(" OR ".join(f"line rlike '{p}'" for p in SOME))
    return every.select("doc_id", "block", sum(n.values(), F.lit(0)).cast("long").alias("score")).orderBy(F.desc("score"), "doc_id", "block").limit(20)


@query("""WITH s AS (SELECT doc_id, ' ' || trim(regexp_replace(lower(coalesce(text, '')), '[^a-z]+', ' ', 'g')) || ' ' AS s FROM documents),
g AS (SELECT doc_id, i, substring(s, i, 3) AS g FROM (SELECT doc_id, s, unnest(range(1, length(s) - 1)) AS i FROM s)),
m AS (SELECT g, count(*) AS n FROM g GROUP BY 1), c AS (SELECT substring(g, 1, 2) AS c, sum(n) AS n FROM m GROUP BY 1),
p AS (SELECT m.g, ln((m.n + 0.1::DOUBLE) / (c.n + 2.7::DOUBLE)) AS lp FROM m JOIN c ON substring(m.g, 1, 2) = c.c),
w AS (SELECT doc_id, lp, avg(lp) OVER w AS run, count(*) OVER w AS k FROM g JOIN p USING (g) WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS 19 PRECEDING)),
a AS (SELECT doc_id, avg(lp) AS m, min(CASE WHEN k = 20 THEN run END) AS worst FROM w GROUP BY 1)
SELECT s.doc_id, round(coalesce(m, 0), 6) + 0 AS lm_score, round(coalesce(worst, m, 0), 6) + 0 AS lm_worst FROM s LEFT JOIN a USING (doc_id)""")
def trigram_windows(spark, d):
    docs = t(spark, d, "documents")
    s = trigrams.scored(docs, trigrams.log_table(trigrams.counts(docs)))
    return s.select("doc_id", *[F.round(c, 6).alias(c) for c in ("lm_score", "lm_worst")])


@query("""WITH e AS (SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem WHERE l_orderkey % 7 > 0 GROUP BY 1, 2), s AS (SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem WHERE l_quantity < 49 AND l_orderkey % 11 > 0 GROUP BY 1, 2)
SELECT l_orderkey, coalesce(sum(e.n), 0)::BIGINT AS n_export, coalesce(sum(s.n), 0)::BIGINT AS n_stored, CASE WHEN count(s.n) = 0 THEN 'missing' WHEN count(e.n) = 0 THEN 'not exported' WHEN bool_and(e.n IS NOT DISTINCT FROM s.n) THEN 'equal' ELSE 'differs' END AS state
FROM e FULL JOIN s USING (l_orderkey, l_partkey) GROUP BY 1""")
def version_verify(spark, d):
    """Multiset equality of an export and what is stored, per document; either side may hold what the other lacks."""
    l = t(spark, d, "lineitem")
    return R.multisets_equal(l.filter("l_orderkey % 7 > 0"), l.filter("l_quantity < 49 AND l_orderkey % 11 > 0"), ["l_orderkey"], "l_partkey")


_TOP10 = f"""WITH {_V}, c AS (SELECT q.vec_id AS search, c.vec_id, list_inner_product(list_transform(q.embedding, lambda x: round(x::DOUBLE, 2)), list_transform(c.embedding, lambda x: round(x::DOUBLE, 2))) AS score FROM embeddings q, embeddings c WHERE q.vec_id % 50 = 0),
a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY search ORDER BY score DESC, vec_id DESC) AS r FROM s) WHERE r <= 10), g AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY search ORDER BY score DESC, vec_id DESC) AS r FROM c) WHERE r <= 10)"""


def scaled_round(x, places: int):
    """Rounds as SQL engines on doubles do: scaled, half away from zero, scaled back; Spark's round goes by the decimal digits, which differs where scaling meets a half."""
    y = F.abs(x * 10**places)
    low = F.floor(y).cast("double")
    return F.signum(x) * F.when(y - low >= 0.5, low + 1).otherwise(low) / 10**places + 0.0  # no negative zero


def _ranked(spark, d, fused: bool = False):
    return Q.dense_top(vectors(spark, d), asked(spark, d), 10, fused=fused).withColumnRenamed("chunk_id", "vec_id")


@query(_TOP10 + """, x AS (SELECT search, list(vec_id ORDER BY r) AS i, list(round(score, 3) ORDER BY r) AS s FROM a GROUP BY 1), y AS (SELECT search, list(vec_id ORDER BY r) AS i, list(round(score, 3) ORDER BY r) AS s FROM g GROUP BY 1)
SELECT search, CASE WHEN x.i = y.i THEN 'match' WHEN list_sort(x.i) = list_sort(y.i) OR x.s = y.s THEN 'tie' ELSE 'mismatch' END AS state FROM x JOIN y USING (search)""")
def search_parity(spark, d):
    """Ranking by whole vectors against one by an index that stores two decimals: equal, the same set or rounded scores, or different."""

    def lists(found, name: str):
        grouped = found.groupBy("search").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", scaled_round(F.col("score"), 3).alias("s")))).alias("x"))
        return grouped.select("search", F.col("x.vec_id").alias(f"{name}_i"), F.col("x.s").alias(f"{name}_s"))

    coarse = lambda c: F.transform(F.col(c).cast("array<double>"), lambda x: F.round(x, 2)).alias(c)
    stored = Q.dense_top(vectors(spark, d).select("chunk_id", coarse("v"), "g"), asked(spark, d).select("search", coarse("q")), 10, fused=True).withColumnRenamed("chunk_id", "vec_id")
    both = lists(_ranked(spark, d, fused=True), "w").join(lists(stored, "g"), "search")
    state = F.when(F.col("w_i") == F.col("g_i"), "match").when((F.array_sort("w_i") == F.array_sort("g_i")) | (F.col("w_s") == F.col("g_s")), "tie").otherwise("mismatch")
    return both.select("search", state.alias("state"))


@query(_TOP10 + """, n AS (SELECT label AS own, count(*) AS n_relevant FROM embeddings GROUP BY 1)
SELECT search, n_relevant, count(*) FILTER (label = own) AS n_hits, round(count(*) FILTER (label = own) / least(10, n_relevant), 9) AS recall, round(count(*) FILTER (label <> own) / count(*), 9) AS other_share, count(*) FILTER (label = own) = least(10, n_relevant) AS full_answer
FROM a JOIN n USING (own) GROUP BY 1, 2""")
def retrieval_metrics(spark, d):
    """Recall at 10, share of other labels, and whether everything possible was found, per search."""
    n = t(spark, d, "embeddings").groupBy(F.col("label").alias("own")).agg(F.count(F.lit(1)).alias("n_relevant"))
    own = asked(spark, d).select("search", "own").join(n, "own")
    hits = _ranked(spark, d).join(t(spark, d, "embeddings").select("vec_id", "label"), "vec_id").join(own, "search").groupBy("search", "n_relevant").agg(F.count_if(F.col("label") == F.col("own")).alias("n_hits"), F.count(F.lit(1)).alias("_n"))
    best = F.least(F.lit(10), F.col("n_relevant"))
    return hits.select("search", "n_relevant", "n_hits", F.round(F.col("n_hits") / best, 9).alias("recall"), F.round((F.col("_n") - F.col("n_hits")) / F.col("_n"), 9).alias("other_share"), (F.col("n_hits") == best).alias("full_answer"))


@query("""SELECT l_orderkey, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS presentations, min(l_shipdate) AS first_date, min(l_shipdate) FILTER (l_returnflag = 'R') AS first_r, CASE WHEN bool_or(l_returnflag = 'R') THEN 'R' ELSE arg_min(l_returnflag, l_linenumber * 256 + ascii(l_returnflag)) END AS licence FROM lineitem GROUP BY 1""")
def catalog_fold(spark, d):
    """One row per licence number: its presentations, earliest dates, and the licence type with one kind taking precedence."""
    r = F.col("l_returnflag") == "R"
    return t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_set("l_returnflag")), ",").alias("presentations"), F.min("l_shipdate").alias("first_date"), F.min(F.when(r, F.col("l_shipdate"))).alias("first_r"), F.when(F.bool_or(r), "R").otherwise(F.min_by("l_returnflag", F.struct("l_linenumber", "l_returnflag"))).alias("licence"))


@query("""WITH s AS (SELECT conv_id, turn, coalesce(text, '') AS text, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS opened FROM conversations)
SELECT conv_id, opened, count(*) AS n_rows, md5(string_agg(text, ' ' ORDER BY turn, text)) AS scope FROM s WHERE opened IS NOT NULL GROUP BY 1, 2""")
def carried_scopes(spark, d):
    """Rows after one that opens a scope are appended to it."""
    w = W.partitionBy("conv_id").orderBy("turn")
    s = t(spark, d, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text"), F.last(F.when(F.col("role") == "user", F.col("turn")), ignorenulls=True).over(w).alias("opened")).filter("opened IS NOT NULL")
    whole = F.array_sort(F.collect_list(F.struct("turn", "text")))["text"]
    return s.groupBy("conv_id", "opened").agg(F.count(F.lit(1)).alias("n_rows"), F.md5(F.array_join(whole, " ")).alias("scope"))


@query("""SELECT o_custkey, o_orderkey, CASE WHEN lag(o_orderstatus) OVER w IS DISTINCT FROM o_orderstatus THEN o_orderstatus || ': ' ELSE '' END || o_orderpriority AS shown FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)""")
def heading_lead_in(spark, d):
    """The heading stands before the first row of each run only."""
    w = W.partitionBy("o_custkey").orderBy("o_orderkey")
    fresh = ~F.lag("o_orderstatus").over(w).eqNullSafe(F.col("o_orderstatus"))
    return t(spark, d, "orders").select("o_custkey", "o_orderkey", F.concat(F.when(fresh, F.concat("o_orderstatus", F.lit(": "))).otherwise(""), "o_orderpriority").alias("shown"))


@query("""WITH b AS (SELECT n_nationkey, n_nationkey % 5 AS page, n_nationkey * 2 AS l, n_nationkey * 3 AS b, n_nationkey * 2 + 10 AS r, n_nationkey * 3 + 25 AS t FROM nation), p AS (SELECT l_linenumber % 5 AS page, l_quantity AS x, l_partkey % 100 AS y FROM lineitem)
SELECT n_nationkey, count(x) AS n_lines, coalesce(sum(y), 0)::BIGINT AS sum_y FROM b LEFT JOIN p ON b.page = p.page AND x BETWEEN l - 2 AND r + 2 AND y BETWEEN b.b - 2 AND t + 2 GROUP BY 1""")
def lines_in_boxes(spark, d):
    """Line centres inside boxes of their page, with a tolerance of 2."""
    k, n = F.col("n_nationkey"), lambda e: e.cast("double")
    boxes = t(spark, d, "nation").select(k.alias("id"), (k % 5).alias("page"), n(k * 2).alias("l"), n(k * 3).alias("b"), n(k * 2 + 10).alias("r"), n(k * 3 + 25).alias("t"))
    x, y = n(F.col("l_quantity")), n(F.col("l_partkey") % 100)
    points = t(spark, d, "lineitem").select((F.col("l_linenumber") % 5).alias("page"), F.col("l_orderkey").alias("id"), x.alias("l"), y.alias("b"), x.alias("r"), y.alias("t"))
    inside = SP.within(points, boxes, ["page"]).groupBy(F.col("box").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("n_lines"), F.sum("b").cast("long").alias("sum_y"))
    return boxes.select(F.col("id").alias("n_nationkey")).join(inside, "n_nationkey", "left").fillna(0)


@query("""WITH i AS (SELECT l_orderkey, l_partkey % 200 AS x0, l_partkey % 200 + l_quantity::BIGINT AS x1 FROM lineitem), f AS (SELECT *, coalesce(x0 > max(x1) OVER (PARTITION BY l_orderkey ORDER BY x0, x1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS fresh FROM i),
g AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY l_orderkey ORDER BY x0, x1 ROWS UNBOUNDED PRECEDING) AS col FROM f)
SELECT l_orderkey, col::BIGINT AS col, min(x0) AS x0, max(x1) AS x1, count(*) AS n FROM g GROUP BY 1, 2""")
def merged_columns(spark, d):
    """Table columns as merged horizontal extents of words; words without a place come last, each a column of its own."""
    quantity = F.rint(F.col("l_quantity")).cast("long")
    i = t(spark, d, "lineitem").select("l_orderkey", (F.col("l_partkey") % 200).alias("x0"), (F.col("l_partkey") % 200 + quantity).alias("x1"))
    order = [F.asc_nulls_last("x0"), F.asc_nulls_last("x1")]
    w = W.partitionBy("l_orderkey").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    f = i.withColumn("fresh", F.coalesce(F.col("x0") > F.max("x1").over(w), F.lit(True)))
    return R.islands(f, ["l_orderkey"], order, F.col("fresh"), "col").groupBy("l_orderkey", "col").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.count(F.lit(1)).alias("n"))


TERMS = {"ation": ["deed", "act"], "ion": ["act", "state"], "er": ["doer"]}


@query("""WITH a AS (SELECT item_id, text, replace(text, 'ation', ' ') AS r1 FROM benchmark), b AS (SELECT *, replace(r1, 'ion', ' ') AS r2 FROM a),
c AS (SELECT *, list_filter([CASE WHEN r1 <> text THEN 'deed' END, CASE WHEN r1 <> text OR r2 <> r1 THEN 'act' END, CASE WHEN r2 <> r1 THEN 'state' END, CASE WHEN contains(r2, 'er') THEN 'doer' END], lambda x: x IS NOT NULL) AS e FROM b)
SELECT item_id, CASE WHEN len(e) > 0 THEN text || chr(10) || array_to_string(e, '; ') ELSE text END AS expanded FROM c""")
def glossary_expansion(spark, d):
    return t(spark, d, "benchmark").select("item_id", X.glossary_expand(F.col("text"), TERMS).alias("expanded"))


@query("""WITH q AS (SELECT n_regionkey, 'How do ' || string_agg(n_name, ', ' ORDER BY n_name) || ' compare (' || max(n_name) || ')?' AS q FROM nation GROUP BY 1),
p AS (SELECT a.n_nationkey, a.n_regionkey, a.n_name, string_agg(b.n_name, '|' ORDER BY b.n_name) AS others FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey <> b.n_nationkey GROUP BY 1, 2, 3),
r AS (SELECT n_nationkey, n_name, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(q, others, '', 'g'), '(\\s*,)+', ',', 'g'), '\\(\\s*,\\s*', '(', 'g'), '\\s*,\\s*\\)', ')', 'g'), '^\\s*,\\s*|\\(\\s*\\)', '', 'g'), '[ \\t]{2,}', ' ', 'g') AS q FROM p JOIN q USING (n_regionkey))
SELECT n_nationkey, n_name || ': ' || trim(q) AS question FROM r""")
def product_questions(spark, d):
    """A question that names several products, once for each of them."""
    n = t(spark, d, "nation")
    names = n.groupBy("n_regionkey").agg(F.array_sort(F.collect_list("n_name")).alias("names"))
    names = names.withColumn("q", F.concat(F.lit("How do "), F.array_join("names", ", "), F.lit(" compare ("), F.array_max("names"), F.lit(")?")))
    others = F.array_join(F.array_remove("names", F.col("n_name")), "|")
    return n.join(names, "n_regionkey").select("n_nationkey", X.product_question(F.col("q"), others, F.col("n_name")).alias("question"))


@query()
def page_section_paths(spark, d):
    """Heading path of each block of each page."""
    from lodestone.sources.html import page_blocks

    row = F.struct("pos", (F.col("label") == "section_header").alias("heading"), "level", "text")
    docs = page_blocks(t(spark, d, "pages")).groupBy("page_id").agg(F.array_sort(F.collect_list(row)).alias("b"))
    each = docs.select("page_id", F.posexplode(F.arrays_zip(F.col("b.pos").alias("pos"), sections.section_paths(F.col("b")).alias("path"))).alias("_k", "e"))
    return each.select("page_id", F.col("e.pos").alias("pos"), F.array_join("e.path", " > ").alias("path"))
