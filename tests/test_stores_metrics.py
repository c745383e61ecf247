"""Sinks, metrics, model seams and page rules on small inputs with results worked out by hand."""

import json
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone import models
from lodestone.functions import repair
from lodestone.operators import metrics
from lodestone.sources import agencies, stores


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_retrieval_metrics(spark):
    groups = spark.createDataFrame(
        [(1, "a", "d1", "Ten  Percent"), (1, "b", "d1", "never said"), (1, "b", "d2", "in the parent"), (2, "c", "d3", "gone")],
        "qid int, grp string, doc string, quote string",
    )
    hits = spark.createDataFrame(
        [(1, 1, "d1", "about ten percent", "k1", "p", "P1", True), (1, 2, "d2", "x", "k2", "it stands IN THE parent", "P2", False), (2, 3, "d9", "gone", "k3", "gone", None, None)],
        "qid int, chunk_id int, doc string, text string, parent_key string, parent_text string, program string, named boolean",
    )
    contexts = spark.createDataFrame([(1, 100), (2, 300)], "qid int, tokens int")
    r = metrics.retrieval(groups, hits, contexts).first()
    assert (r.n_groups, r.n_questions, r.full, r.median_tokens, r.other_share) == (3, 2, 1, 200.0, 0.5)
    assert r.recall == pytest.approx(1 / 3) and r.ctx_recall == pytest.approx(2 / 3)


def test_extraction_metrics(spark):
    schema = "page int, tbl int, row int, col int, value string"
    gold = spark.createDataFrame([(1, 0, 0, 0, "dose"), (1, 0, 0, 1, "10"), (1, 0, 1, 0, "rate"), (1, 0, 1, 1, "20"), (1, 1, 0, 0, "other"), (2, 0, 0, 0, "alone")], schema)
    found = spark.createDataFrame([(1, 5, 0, 0, "dose"), (1, 5, 0, 1, "10"), (1, 5, 1, 0, "rate"), (1, 5, 1, 1, "21"), (1, 6, 0, 0, "dose"), (1, 7, 0, 0, "other"), (1, 7, 0, 1, "")], schema)
    assert rows(metrics.matched(gold, found)) == [(1, 0, 5), (1, 1, 7)]
    pages = metrics.extraction(gold, found)
    want = {1: (5, 4, 2, 1, 3, 2), 2: (1, 0, 0, 0, 1, 0)}
    assert {r.page: (r.cell_n, r.cell_hit, r.num_n, r.num_hit, r.row_n, r.row_hit) for r in pages.collect()} == want
    r = metrics.ratios(pages).first()
    assert (r.pages, r.cell_recall, r.num_cell_recall, r.row_exact) == (2, 66.7, 50.0, 50.0)



def test_unshifted_texts_stay(spark):
    df = spark.createDataFrame([("plain words of the text",), (None,), ("",)], "text string")
    logs = np.zeros(27**3)
    assert rows(df.select("text", repair.decode_shifted(F.col("text"), logs).alias("got"))) == sorted([("plain words of the text",) * 2, (None, None), ("", "")], key=str)


def test_model_seams(spark):
    texts = spark.createDataFrame([("two words",), ("two words",), ("Other",)], "text string")
    got = models.embedded(texts).collect()
    assert len(got) == 2 and all(sum(x * x for x in r.dense) == pytest.approx(1, abs=1e-6) for r in got)
    pairs = spark.createDataFrame([("s", 1, "two words", "words here"), ("s", 2, "", "x")], "search string, chunk_id long, query string, passage string")
    assert rows(models.scored_pairs(pairs)) == [("s", 1, 0.5), ("s", 2, 0.0)]


def test_sinks(spark, tmp_path):
    stores.write_manifest(spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "doc_id long, sha256 string"), f"{tmp_path}/manifest")
    lines = [json.loads(x) for p in sorted(Path(tmp_path, "manifest").glob("part-*")) for x in p.read_text().splitlines()]
    assert [x["doc_id"] for x in lines] == [1, 2, 3]
    chunks = spark.createDataFrame([(1, 1, "k1")], "chunk_id long, index_document_id int, parent_key string")
    parents = spark.createDataFrame([(1, "k1", "x"), (1, "k2", "y"), (2, "k1", "z")], "index_document_id int, parent_key string, text string")
    stores.write_export(chunks, parents, spark.createDataFrame([(1,)], "index_document_id int"), f"{tmp_path}/export")
    assert rows(spark.read.parquet(f"{tmp_path}/export/parents")) == [(1, "k1", "x")]
    spark.createDataFrame([("/data/raw/a/b.pdf",), ("a/c.pdf",)], "path string").write.parquet(f"{tmp_path}/versions")
    assert stores.copy_tables(spark, {"versions": f"{tmp_path}/versions"}, f"{tmp_path}/copy", {"versions": "path"}, "/data/raw") == {"versions": 2}
    assert rows(spark.read.parquet(f"{tmp_path}/copy/versions")) == [("a/b.pdf",), ("a/c.pdf",)]
    with pytest.raises(ValueError):
        stores.copy_tables(spark, {}, f"{tmp_path}/copy", {}, "/data/raw")


def test_rekeyed_versions(spark):
    v = spark.createDataFrame(
        [(1, 1, "old", "f", 10, True), (1, 2, "new", "f", 11, True), (2, 3, "a", "g", 5, True), (3, 4, "h", "h", 5, True), (4, 5, "x", None, 5, True), (5, 6, "p", "m", 5, True), (5, 7, "q", "n", 5, True)],
        "doc_id long, id long, sha256 string, fingerprint string, size long, html boolean",
    )
    moves = stores.rekeyed(v)
    assert rows(moves) == [(1, 1, 2, "old", "f", "rekeyed"), (2, 3, None, "a", "g", "rekeyed"), (3, None, None, None, None, "unchanged"), (4, None, None, None, None, "skipped_no_raw"), (5, None, None, None, None, "unresolved")]
    parses = spark.createDataFrame([("old", 1), ("h", 2)], "sha256 string, n int")
    assert rows(stores.rewritten(parses, moves)) == [("f", 1), ("h", 2)]


def test_pages_of_an_agency(spark):
    html = """<table id="exampleApplOrig"><tr><th>head</th></tr><tr><td>01/31/2020</td><td>ORIG-1</td><td><a href="/x.pdf">Label</a> <a href="/y.pdf">Letter</a></td></tr></table>"""
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert [r[2:] for r in rows(agencies.overview_rows(pages))] == [("2020-01-31", "ORIG-1", "/x.pdf", "Label"), ("2020-01-31", "ORIG-1", "/y.pdf", "Letter")]
    stated = spark.createDataFrame([("<p>Date of decision: 2019-05-06</p><p>Date RDS issued: 2019-08-09</p>", "rds"), ("<p>Date of decision: 2019-05-06</p>", "label")], "html string, doc_type string")
    a, b = agencies.page_dates(F.col("html"), F.col("doc_type"))
    assert rows(stated.select(a, b)) == [("2019-05-06", "2019-08-09"), (None, None)]


def test_rewriting_by_document(spark):
    """Two documents with one old hash and two new ones: each row follows its own document."""
    moves = spark.createDataFrame([(1, "old", "new1", "rekeyed"), (2, "old", "new2", "rekeyed"), (3, "x", "y", "unresolved")], "doc_id long, old_sha string, new_sha string, action string")
    table = spark.createDataFrame([(1, "old", "a"), (2, "old", "b"), (4, "old", "c"), (3, "x", "d")], "doc_id long, sha256 string, v string")
    assert sorted(tuple(r) for r in stores.rewritten(table, moves).collect()) == [(1, "new1", "a"), (2, "new2", "b"), (3, "x", "d"), (4, "old", "c")]
    assert sorted(tuple(r) for r in stores.rewritten(table.drop("doc_id"), moves).collect()) == [("new1", "a"), ("new1", "b"), ("new1", "c"), ("x", "d")]


def test_copy_in_order_of_reference(spark, tmp_path):
    docs = spark.createDataFrame([(1, None, "/srv/raw/a"), (2, 1, "/srv/raw/b")], "id long, parent_id long, path string")
    docs.write.parquet(f"{tmp_path}/s/docs")
    spark.createDataFrame([(7, 2), (8, None)], "id long, doc_id long").write.parquet(f"{tmp_path}/s/versions")
    places = {"versions": f"{tmp_path}/s/versions", "docs": f"{tmp_path}/s/docs"}
    refs = {"versions": [("doc_id", "docs")], "docs": [("parent_id", "docs")]}
    assert list(stores.copy_tables(spark, places, f"{tmp_path}/t", {"docs": "path"}, "/srv", refs).items()) == [("docs", 2), ("versions", 2)]
    with pytest.raises(ValueError, match="not empty"):
        stores.copy_tables(spark, places, f"{tmp_path}/t", {}, "/srv", refs)
    spark.createDataFrame([(9, 55)], "id long, doc_id long").write.mode("append").parquet(f"{tmp_path}/s/versions")
    with pytest.raises(ValueError, match="lacks"):
        stores.copy_tables(spark, places, f"{tmp_path}/t2", {}, "/srv", refs)
    with pytest.raises(ValueError, match="circle"):
        stores.copy_tables(spark, places, f"{tmp_path}/t3", {}, "/srv", {"docs": [("id", "versions")], "versions": [("doc_id", "docs")]})


def test_export_is_held_to_its_manifest(spark, tmp_path):
    chunks = spark.createDataFrame([(1, 1, "k1")], "chunk_id long, index_document_id int, parent_key string")
    parents = spark.createDataFrame([(1, "k1", "x"), (1, "k2", "y")], "index_document_id int, parent_key string, text string")
    stores.write_export(chunks, parents, spark.createDataFrame([(1,)], "index_document_id int"), f"{tmp_path}/e")
    assert stores.read_export(spark, f"{tmp_path}/e")["parents"].count() == 1
    chunks.write.mode("append").parquet(f"{tmp_path}/e/chunks")
    with pytest.raises(ValueError, match="chunks"):
        stores.read_export(spark, f"{tmp_path}/e")


def test_every_csv_file_has_its_own_last_block(spark, tmp_path):
    from lodestone.sources import catalogs

    (tmp_path / "a.csv").write_text("BLA,Proper Name\n1,x\nBLA,Proper Name\n2,y\n")
    (tmp_path / "b.csv").write_text("junk\nBLA,Proper Name\n3,z\n4,w\n")
    assert sorted(r.n for r in catalogs.last_csv_block(spark, str(tmp_path), ("bla", "proper name"), "bla INT, n STRING").collect()) == ["w", "y", "z"]


def test_reply_contract():
    from lodestone.operators.claims import KINDS, contract

    c = contract(["S1", "S2"], ["P"])["properties"]["claims"]["items"]["properties"]
    assert c["citation_span_ids"]["items"] == {"type": "string", "enum": ["S1", "S2"]} and c["products"]["items"] == {"enum": ["P"]} and c["kind"]["enum"] == KINDS
    assert contract([f"S{i}" for i in range(501)], [])["properties"]["claims"]["items"]["properties"]["citation_span_ids"]["items"]["pattern"] == "^S[0-9]+$"
