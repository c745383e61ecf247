"""Small cases of the findings of round 4, each against the query's SQL or a plain version."""

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from lodestone import catalog


def same_as_sql(spark, tmp_path, name, **tables):
    """A query on small tables against its SQL, as bags of rows."""
    con = duckdb.connect()
    for n, pdf in tables.items():
        pdf.to_parquet(f"{tmp_path}/{n}.parquet", index=False)
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM '{tmp_path}/{n}.parquet'")
    got, want = catalog.queries()[name](spark, str(tmp_path)).toPandas(), con.execute(catalog.oracle_sql()[name]).df()
    cols = sorted(want.columns)
    key = lambda df: sorted(map(tuple, df[cols].astype(object).where(df[cols].notna(), None).values.tolist()), key=repr)
    assert key(got) == key(want)
    return got


def test_page_titles_common_references_and_copies(spark, tmp_path):
    html = ["<title>a&amp;&amp b &eacute; &#39;x&nbsp;\xa0y</title>", "<title>a&amp;&amp b &eacute; &#39;x&nbsp;\xa0y</title>", "<TITLE>other</TITLE>", None]
    pages = pd.DataFrame({"page_id": [1, 1, 1, 2], "url": ["u"] * 4, "html": html})
    assert len(same_as_sql(spark, tmp_path, "page_titles", pages=pages)) == 3


def test_scaled_round_as_sql_rounds(spark):
    from lodestone.plans.evidence_queries import scaled_round

    values = [0.45649999999999996, 0.0014999999999999999, 1.0005, -0.45649999999999996, 2.6745, -0.0001, 8.5, None] + [i / 10000 + 0.1 - 0.1 for i in range(-3000, 3000, 7)]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "x double").select(scaled_round(F.col("x"), 3)).collect()]
    con = duckdb.connect()
    assert got == [con.execute("SELECT round(?::DOUBLE, 3)", [v]).fetchall()[0][0] for v in values]


def test_search_parity_near_ties_as_sql(spark, tmp_path):
    import numpy as np

    rng = np.random.default_rng(3)
    v = rng.integers(-20, 21, (400, 24)).astype(np.float32) / np.float32(100)  # two decimals: many scores that only rounding tells apart
    e = pd.DataFrame({"vec_id": range(400), "embedding": list(v), "label": [0] * 400})
    e.loc[0, "vec_id"] = 400
    assert len(same_as_sql(spark, tmp_path, "search_parity", embeddings=e)) == 8


def test_few_quotes_of_a_key_need_no_stretches(spark, monkeypatch):
    from lodestone.operators import containment as CT

    monkeypatch.setattr(CT, "_stretches", lambda *a: (_ for _ in ()).throw(AssertionError("stretches")))
    texts = spark.createDataFrame([(1, 7, "abcde"), (2, 7, "xbcx"), (3, 8, "bc"), (4, None, "bc"), (5, 7, None)], "text_id long, k long, body string")
    quotes = spark.createDataFrame([(1, 7, "bc"), (1, 7, "bc"), (2, 8, "abc"), (3, None, "bc"), (4, 8, "")], "quote_id long, k long, quote string")
    assert sorted(tuple(r) for r in CT.contained(texts, quotes, "k").collect()) == [(1, 1), (2, 1)]


def test_many_clusters_of_one_name(spark):
    import time

    from lodestone.operators import resolution

    n = 20_000  # the step was once cubic in this number
    wanted = spark.range(n).selectExpr("id AS cluster", "CASE WHEN id % 7 = 3 THEN 'Brand-2' WHEN id % 7 = 5 THEN 'Brand-2-4' WHEN id = 11 THEN 'brand-900' ELSE 'Brand' END AS base", "named_struct('o', id) AS order")
    taken = spark.createDataFrame([("BRAND-5",), ("brand-2-3",), ("other",), (None,)], "name string")
    t0 = time.time()
    got = {r.cluster: r.program_id for r in resolution.unique_names(wanted, taken).collect()}
    assert time.time() - t0 < 60
    held, want, start = {"brand-5", "brand-2-3", "other"}, {}, {}
    for r in sorted(wanted.collect()):
        low, k = r.base.lower(), start.get(r.base.lower(), 1)
        while (low if k == 1 else f"{low}-{k}") in held:
            k += 1
        held.add(low if k == 1 else f"{low}-{k}")
        start[low], want[r.cluster] = k, r.base if k == 1 else f"{r.base}-{k}"
    assert got == want


def test_trigrams_are_counted_inside_tasks(spark, tmp_path):
    docs = pd.DataFrame({"doc_id": range(5), "text": ["Ab c1d", None, "", "zzzz" * 100, "é x"], "lang": "en"})
    got = same_as_sql(spark, tmp_path, "trigram_counts", documents=docs)
    assert len(got) and "MapInArrow" in catalog.queries()["trigram_counts"](spark, str(tmp_path))._jdf.queryExecution().toString()


def test_sparse_scores_of_all_pairs(spark, tmp_path):
    docs = pd.DataFrame({"doc_id": [1, 2, 3, 900], "text": ["the cat, the hat", "no match", None, "hat"]})
    items = pd.DataFrame({"item_id": [5, 6], "text": ["The hat", "cat hat the"]})
    got = same_as_sql(spark, tmp_path, "sparse_score_pairs", documents=docs, benchmark=items)  # no vectors needed: no shortlist cuts the pairs
    assert len(got) == 4


def test_near_pairs_keep_members_of_a_class(spark, tmp_path):
    text = "alpha beta gamma delta epsilon zeta theta kappa"
    docs = pd.DataFrame({"doc_id": [1, 2, 3, 4], "lang": ["en", "en", "en", "de"], "text": [text, text.upper() + "!", text + " omega", text]})
    got = same_as_sql(spark, tmp_path, "near_dup_pairs", documents=docs)
    assert {(r.a, r.b) for r in got.itertuples()} == {(1, 2), (1, 3)}  # different texts of one set, and a near one


def test_table_cells_come_from_one_pass(spark):
    from lodestone.plans.document_queries import _cells

    plan = _cells(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1


def test_beginnings_of_names_are_never_broadcast(spark, tmp_path, monkeypatch):
    from lodestone.operators import resolution

    names = spark.range(50).selectExpr("id AS k", "concat('Brandname ', id) AS name")
    aliases = spark.range(2000).selectExpr("concat('Brand', char(97 + id % 26)) AS alias", "id AS n")  # by estimate the larger side
    for most, join in ((resolution.MOST_ALIASES, "BroadcastHashJoin"), (0, "SortMergeJoin")):
        monkeypatch.setattr(resolution, "MOST_ALIASES", most)
        met = resolution.name_matches(names, aliases)
        plan = met._jdf.queryExecution().executedPlan().toString()
        assert join in plan and "BuildLeft" not in plan and met.count() == 50 * 77
    part = pd.DataFrame({"p_partkey": [1, 2, 3, 4], "p_name": ["small ring", "smaller x", "hot bolt", "Small-ring two"], "p_brand": ["Brand#1", "Brand#12", "Brand#1", "hot"]})
    for name in ("program_match", "excluded_registrations"):
        same_as_sql(spark, tmp_path, name, part=part)


def test_similar_names_meet_in_blocks(spark, tmp_path, monkeypatch):
    from lodestone.operators import resolution

    monkeypatch.setattr(resolution, "BLOCK", 8)
    monkeypatch.setattr(resolution, "TASK_PAIRS", 1000)
    found = same_as_sql(spark, tmp_path, "similar_name_pairs", supplier=pd.DataFrame({"s_suppkey": range(3000)}))
    assert len(found) > 10_000
    names = spark.createDataFrame([(1, "abcdefgh"), (1, "abcdefgh"), (2, "abcdefgx"), (2, "abcdefgh"), (3, None), (4, "abcxyzgh"), (5, "short"), (6, "shorx")], "id long, name string")
    assert sorted(tuple(r) for r in resolution.similar_names(names).collect()) == [(1, 2), (1, 4), (2, 4)]
    plan = resolution.similar_names(names)._jdf.queryExecution().optimizedPlan().toString()  # names are compared once, not id by id
    assert not any("id#" in line for line in plan.splitlines() if "levenshtein" in line)


def test_clusters_link_one_registration_of_a_name_and_agency(spark):
    from lodestone.operators import resolution

    r = spark.range(400).selectExpr("id", "element_at(array('fda', 'ema', 'hc'), CAST(id % 3 + 1 AS INT)) AS agency", "CASE WHEN id % 2 = 0 THEN 'abcdefgh' ELSE 'abcdefgx' END AS brand", "concat('H', id, ' Ltd.') AS holder", "id % 11 = 0 AS reference")
    links = resolution.first_links(r)
    assert links.filter("rule = 'similar_name'").count() <= 6  # once all pairs of ids
    got = resolution.clusters(r.withColumn("approved", F.lit(None).cast("string"))).select("cluster", F.array_join("basis", ",").alias("b")).distinct().collect()
    assert [tuple(x) for x in got] == [(0, "same_brand,similar_name")]


def test_multisets_are_grouped_in_parts_by_rows(spark, tmp_path, monkeypatch):
    from lodestone.operators import relational, shared

    l = pd.DataFrame({"l_orderkey": [1, 1, 1, 2, 7, 11, 3, 3, None, None], "l_partkey": [5, 5, 6, 5, 5, 5, None, None, 4, None], "l_quantity": [1.0, 1.0, 1.0, 49.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0]}).convert_dtypes()
    same_as_sql(spark, tmp_path, "version_verify", lineitem=l)
    monkeypatch.setattr(shared, "TASK_ROWS", 100)
    rows = spark.range(2500).selectExpr("id % 50 AS k", "id AS v")
    met = relational.multisets_equal(rows, rows.filter("v != 49"), ["k"], "v")
    assert "Join" not in (plan := met._jdf.queryExecution().optimizedPlan().toString()) and ", 50" in next(x for x in plan.splitlines() if "RepartitionByExpression" in x)
    assert {tuple(r) for r in met.filter("k >= 48").collect()} == {(48, 50, 50, "equal"), (49, 50, 49, "differs")}


def test_filters_of_many_groups_hold_no_list(spark, tmp_path):
    orders = pd.DataFrame({"o_orderkey": range(40), "o_orderstatus": list("FOP ") * 10, "o_orderpriority": ["2-HIGH", "1-URGENT", "5-LOW", "3-MEDIUM", "2-HIGH"] * 8, "o_custkey": [1, 3] * 20})
    got = same_as_sql(spark, tmp_path, "search_filters", orders=orders, nation=pd.DataFrame({"n_nationkey": range(25)}).astype("int32"))
    assert len(got) > 10
    plan = catalog.queries()["search_filters"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in plan and "Window" not in plan


def test_reranked_rows_are_dealt_by_their_number(spark, tmp_path, monkeypatch):
    from lodestone.operators import shared

    monkeypatch.setattr(shared, "TASK_ROWS", 10)
    l = pd.DataFrame({"l_suppkey": [i % 3 for i in range(120)], "l_orderkey": [i // 2 for i in range(120)], "l_linenumber": [i % 4 for i in range(120)], "l_partkey": range(120), "l_tax": [i % 5 / 100 for i in range(120)]})
    same_as_sql(spark, tmp_path, "rerank_order", lineitem=l)
    plan = catalog.queries()["rerank_order"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert all(", 13" in x for x in plan.splitlines() if "RepartitionByExpression" in x) and "RepartitionByExpression" in plan
