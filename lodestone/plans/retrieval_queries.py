"""Retrieval, evidence, resolution, merge, metric and relational queries over the driver tables, each with its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.functions import text as X
from lodestone.operators import containment as CT
from lodestone.operators import metrics as M
from lodestone.operators import relational as R
from lodestone.operators import search as Q
from lodestone.operators.shared import written

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def t(spark, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def bounded(df: DataFrame, rows: int = 10_000) -> DataFrame:
    """Broadcasts a plan or query table once a count proves it small."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def vectors(spark, d) -> DataFrame:
    """Chunks of the embeddings table for dense_top: components as they are."""
    return t(spark, d, "embeddings").select(F.col("vec_id").alias("chunk_id"), F.col("embedding").alias("v"), F.col("label").alias("g"))


def asked(spark, d) -> DataFrame:
    """(search, q): every vector whose id 50 divides asks for its nearest among all."""
    return t(spark, d, "embeddings").filter("vec_id % 50 = 0").select(F.col("vec_id").alias("search"), F.col("embedding").alias("q"), F.col("label").alias("own"))


def top(df: DataFrame, k: int, by: list[str]) -> DataFrame:
    """Best k per search: score, then id, both descending; Spark cuts groups before the shuffle (WindowGroupLimit)."""
    w = W.partitionBy("search").orderBy(*[F.desc(c) for c in by])
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


_V = """s AS (SELECT q.vec_id AS search, q.label AS own, c.vec_id, c.label, list_inner_product(q.embedding::DOUBLE[], c.embedding::DOUBLE[]) AS score FROM embeddings q, embeddings c WHERE q.vec_id % 50 = 0)"""


@query(f"WITH {_V} SELECT search, vec_id, round(score, 9) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY search ORDER BY score DESC, vec_id DESC)::INT AS rank FROM s) WHERE rank <= 10")
def dense_topk(spark, d):
    return Q.dense_top(vectors(spark, d), asked(spark, d), 10).select("search", F.col("chunk_id").alias("vec_id"), F.round("score", 9).alias("score"), "rank")


@query(f"WITH {_V} SELECT search, vec_id, round(score, 9) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY search ORDER BY score DESC, vec_id DESC)::INT AS rank FROM s WHERE label <> own) WHERE rank <= 10")
def dense_topk_filtered(spark, d):
    """Every search sees the other labels only."""
    labels = t(spark, d, "embeddings").select(F.col("label").alias("g")).distinct()
    others = labels.select(F.col("g").alias("own")).join(labels, F.col("g") != F.col("own")).groupBy("own").agg(F.collect_set(F.col("g").cast("long")).alias("allow"))  # once per label, not per search
    found = Q.dense_top(vectors(spark, d), asked(spark, d).join(others, "own"), 10)
    return found.select("search", F.col("chunk_id").alias("vec_id"), F.round("score", 9).alias("score"), "rank")


_H = """w AS (SELECT DISTINCT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS w FROM documents), b AS (SELECT DISTINCT item_id, unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS w FROM benchmark),
sp AS (SELECT item_id, doc_id, count(*) AS sparse FROM b JOIN w USING (w) WHERE w <> '' GROUP BY 1, 2)"""


def words_of(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("w")).filter("w != ''").distinct()


_I = """i AS (SELECT b.item_id, c.vec_id, list_inner_product(q.embedding::DOUBLE[], c.embedding::DOUBLE[]) AS score FROM benchmark b JOIN embeddings q ON q.vec_id = b.item_id, embeddings c),
sh AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, vec_id DESC) AS r FROM i) WHERE r <= 200)"""


def shortlists(spark, d) -> tuple[DataFrame, DataFrame]:
    """For every benchmark item, whose question vector is the one of its number: its dense shortlist, and the words it shares with each document on it."""
    b = t(spark, d, "benchmark")
    ask = b.select(F.col("item_id").alias("search")).join(t(spark, d, "embeddings").select(F.col("vec_id").alias("search"), F.col("embedding").alias("q")), "search")
    short = written(Q.dense_top(vectors(spark, d), ask, Q.shortlist_size(10)).drop("rank"))
    docs = t(spark, d, "documents").join(short.select(F.col("chunk_id").alias("doc_id")).distinct(), "doc_id", "left_semi")  # words of shortlisted documents only
    tokens = words_of(docs, "doc_id").select(F.col("doc_id").alias("chunk_id"), F.col("w").alias("token"), F.lit(1).alias("w"))
    words = words_of(b, "item_id").select(F.col("item_id").alias("search"), F.col("w").alias("token"), F.lit(1).alias("w"))
    return short, Q.sparse_scores(short, tokens, words)


@query(f"""WITH {_H}, {_I}, h AS (SELECT sh.item_id, sh.vec_id, sh.score + 0.3::DOUBLE * coalesce(sparse, 0) AS score FROM sh LEFT JOIN sp ON sp.item_id = sh.item_id AND sp.doc_id = sh.vec_id)
SELECT item_id, vec_id, round(score, 9) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, vec_id DESC)::INT AS rank FROM h) WHERE rank <= 10""")
def hybrid_topk(spark, d):
    """Dense shortlist of max(200, 20 k), then dense + 0.3 sparse, for every benchmark item in one plan."""
    short, sparse = shortlists(spark, d)
    h = Q.hybrid(short, sparse, 10, F.col("score") + Q.SPARSE_WEIGHT * F.coalesce("sparse", F.lit(0)))
    return h.select(F.col("search").alias("item_id"), F.col("chunk_id").alias("vec_id"), F.round("score", 9).alias("score"), "rank")


@query(f"WITH {_H} SELECT item_id, doc_id, sparse FROM sp")
def sparse_score_pairs(spark, d):
    """Shared words of every item and every document that has one. Documents are dealt by id once; their words meet the items' and are counted where they are."""
    asked_words = bounded(words_of(t(spark, d, "benchmark"), "item_id"), 500_000)
    words = words_of(t(spark, d, "documents").select("doc_id", "text").repartition("doc_id"), "doc_id")
    return words.join(asked_words, "w").groupBy("item_id", "doc_id").agg(F.count(F.lit(1)).alias("sparse"))


@query("SELECT o_orderkey, p FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS p FROM orders) WHERE p IS NULL OR p NOT IN ('1-URGENT', '5-LOW')")
def exclude_null_safe(spark, d):
    p = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority"))
    o = t(spark, d, "orders").select("o_orderkey", p.alias("p"))
    return o.filter(F.col("p").isNull() | ~F.col("p").isin("1-URGENT", "5-LOW"))


@query("SELECT s_nationkey, s_suppkey FROM (SELECT *, s_acctbal > 9000 AS sec, bool_or(s_acctbal > 9000) OVER (PARTITION BY s_nationkey) AS any_sec FROM supplier) WHERE sec OR NOT any_sec")
def narrow_unless_empty(spark, d):
    s = t(spark, d, "supplier").withColumn("sec", F.col("s_acctbal") > 9000).withColumn("some", F.max("sec").over(W.partitionBy("s_nationkey")))
    return s.filter("sec OR NOT some").select("s_nationkey", "s_suppkey")


@query("""WITH RECURSIVE e AS (SELECT DISTINCT o_custkey AS a, o_orderkey + 1000000 AS b FROM orders WHERE o_totalprice > 300000), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r AS (SELECT a AS id, a AS c FROM u UNION SELECT u.b, r.c FROM r JOIN u ON u.a = r.id) SELECT id, min(c) AS component FROM r GROUP BY id""")
def components(spark, d):
    e = t(spark, d, "orders").filter("o_totalprice > 300000").select(F.col("o_custkey").alias("a"), (F.col("o_orderkey") + 1000000).alias("b"))
    if not spark.sparkContext.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        import tempfile

        spark.sparkContext.setCheckpointDir(folder or tempfile.mkdtemp())
    return R.components(e)


@query("SELECT coalesce(o.k, n.k) AS k, coalesce(CASE WHEN n.v <> '' THEN n.v END, o.v) AS v, least(o.dt, n.dt) AS dt FROM (SELECT c_custkey AS k, c_name AS v, c_acctbal AS dt FROM customer) o FULL JOIN (SELECT c_custkey + 100 AS k, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS v, c_acctbal AS dt FROM customer) n ON o.k = n.k")
def fieldwise_upsert(spark, d):
    c = t(spark, d, "customer")
    old = c.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("v"), F.col("c_acctbal").alias("dt"))
    new = c.select((F.col("c_custkey") + 100).alias("k"), F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_mktsegment")).alias("v"), F.col("c_acctbal").alias("dt"))
    return R.upsert(old, new, ["k"], earliest=("dt",))


@query("SELECT doc_id, item_id FROM documents JOIN benchmark ON contains(regexp_replace(lower(documents.text), '\\s+', '', 'g'), regexp_replace(lower(benchmark.text), '\\s+', '', 'g'))")
def quote_containment(spark, d):
    """Every benchmark passage in every document, in comparison form."""
    quotes = t(spark, d, "benchmark").select(F.col("item_id").alias("quote_id"), F.col("text").alias("quote"))
    texts = t(spark, d, "documents").select(F.col("doc_id").alias("text_id"), F.col("text").alias("body"))
    return CT.contained(texts, quotes, norm=M.gold_norm).select(F.col("text_id").alias("doc_id"), F.col("quote_id").alias("item_id"))


@query("""WITH c AS (SELECT doc_id, pos, regexp_replace(lower(line), '\\s+', '', 'g') AS body FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)),
q AS (SELECT doc_id, substr(regexp_replace(lower(text), '\\s+', '', 'g'), 40, 5 + doc_id % 40) AS quote FROM documents)
SELECT DISTINCT c.doc_id, pos FROM c JOIN q ON c.doc_id = q.doc_id AND quote <> '' AND contains(body, quote)""")
def quotes_in_chunks(spark, d):
    """The chunks (lines) of a quote's own document that contain it: the document is the key, whatever the quote's length."""
    docs = t(spark, d, "documents")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    texts = lines.select(F.struct("doc_id", (F.col("pos") + 1).cast("long").alias("pos")).alias("text_id"), F.col("line").alias("body"), F.col("doc_id").alias("doc"))
    quotes = docs.select(F.col("doc_id").alias("quote_id"), F.substring(M.gold_norm(F.col("text")), F.lit(40), (5 + F.col("doc_id") % 40).cast("int")).alias("quote"), F.col("doc_id").alias("doc"))
    return CT.contained(texts, quotes, "doc", M.gold_norm).select("text_id.doc_id", "text_id.pos").distinct()


@query("WITH l AS (SELECT l_orderkey, l_returnflag AS v, count(*) AS c FROM lineitem GROUP BY 1, 2), r AS (SELECT o_orderkey AS l_orderkey, o_orderstatus AS v, count(*) AS o FROM orders GROUP BY 1, 2) SELECT l_orderkey, sum(c)::BIGINT AS n_left, sum(least(c, coalesce(o, 0)))::BIGINT AS n_shared FROM l LEFT JOIN r USING (l_orderkey, v) GROUP BY 1")
def multiset_overlap(spark, d):
    l = t(spark, d, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("v"))
    r = t(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("v"))
    return R.multiset_overlap(l, r, ["l_orderkey"], "v")


@query("SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, count(*) AS n, grouping_id(l_returnflag, l_linestatus)::BIGINT AS gid FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def rollup_status(spark, d):
    return t(spark, d, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.count(F.lit(1)).alias("n"), F.grouping_id().cast("long").alias("gid"))


@query("SELECT user_id, min(ts) AS started, max(ts) AS ended, count(*) AS n FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, s")
def session_windows(spark, d):
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    gap = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lag("ts").over(w).cast("timestamp"))
    e = t(spark, d, "events").withColumn("fresh", F.coalesce(gap > 30 * 60 * 1_000_000, F.lit(True)))
    return R.islands(e, ["user_id"], ["ts", "event_id"], F.col("fresh"), "s").groupBy("user_id", "s").agg(F.min("ts").alias("started"), F.max("ts").alias("ended"), F.count(F.lit(1)).alias("n")).drop("s")


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def tumbling_windows(spark, d):
    return t(spark, d, "events").groupBy(F.date_trunc("hour", "ts").alias("start"), "event_type").agg(F.count(F.lit(1)).alias("n"))
