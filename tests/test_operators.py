import json
import zipfile

import duckdb
import pytest
from pyspark.sql import functions as F

from lodestone import catalog
from lodestone.functions import text as X
from lodestone.operators import tables
from lodestone.operators.sections import paths
from lodestone.sources import catalogs
from lodestone.sources.html import blocks_of, page_cells

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for n in TABLES:
        con.sql(f"CREATE VIEW {n} AS SELECT * FROM '{SF}/{n}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_against_oracle(spark, duck, name):
    got, want = catalog.queries()[name](spark, SF).toPandas(), duck.sql(catalog.oracle_sql()[name]).df()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    rows = lambda d: sorted(repr(tuple(float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else x for x in r)) for r in d[cols].astype(object).where(d[cols].notna(), None).itertuples(index=False, name=None))
    assert rows(got) == rows(want)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).head()[0]


@pytest.mark.parametrize("value,dayfirst,want", [("2024-04-22T10", False, "2024-04-22"), ("20240422", False, "2024-04-22"), ("22/04/2024", True, "2024-04-22"), ("04/22/2024", False, "2024-04-22"), ("22/04/2024", False, None), ("April 22, 2024", False, "2024-04-22"), ("22 Apr 2024", False, "2024-04-22"), ("soon", False, None), (None, False, None)])
def test_iso_date(spark, value, dayfirst, want):
    assert one(spark, X.iso_date(F.lit(value).cast("string"), dayfirst)) == want


def test_names_and_numbers(spark):
    assert one(spark, X.norm_name(F.lit("CT-P43"))) == "ctp43"
    assert one(spark, X.holder_key(F.lit("The Acme Holdings B.V."))) == "acme"
    assert one(spark, X.numbers(F.lit("1,000 of ABP654 at 2.5 and 2.5"))) == ["1000", "2.5"]
    assert one(spark, X.study_ids(F.lit("NCT01234567 and 2019-000123-17"))) == ["NCT01234567", "2019-000123-17"]


def test_html_blocks():
    html = "<nav><p>no</p></nav><main><h2>Head</h2><p>a  b</p><table><tr><th>x</th><td>1</td></tr></table></main><p>out</p>"
    assert blocks_of(html) == [("section_header", 2, "Head"), ("text", None, "a b"), ("table", None, "| x | 1 |")]


def test_html_spans(spark):
    html = """<table><tr><th rowspan="2">Arm</th><th colspan="2">Result</th></tr><tr><th>n</th><th>a|b</th></tr>
    <tr><td rowspan="9">A</td><td>1</td><td colspan="x">2</td></tr><tr></tr><tr><td>3</td></tr></table><table></table>"""
    assert blocks_of(html) == [("table", None, "| Arm | Result | Result |\n| Arm | n | a/b |\n| A | 1 | 2 |\n| A |  |  |\n| A | 3 |  |")]
    pages = spark.createDataFrame([(1, html), (2, None), (3, "<p>no table</p>")], "page_id long, html string")
    cells = page_cells(pages)
    got = [tuple(r) for r in cells.orderBy("pos").collect()]
    assert [x[3:7] for x in got] == [(0, 0, 2, 1), (0, 1, 1, 2), (1, 1, 1, 1), (1, 2, 1, 1), (2, 0, 3, 1), (2, 1, 1, 1), (2, 2, 1, 1), (4, 1, 1, 1)]
    assert [x[8] for x in got] == [True] * 4 + [False] * 4 and {x[:2] for x in got} == {(1, 0)}
    grid = tables.grids(cells.withColumn("key", F.concat_ws("-", "page_id", "tbl")), "key").collect()
    assert [list(r) for r in grid[0].grid] == [["Arm", "Result", "Result"], ["Arm", "n", "a|b"], ["A", "1", "2"], ["A", "", ""], ["A", "3", ""]] and grid[0].n_head == 2


def test_section_paths():
    rows = [(True, None, "1. Scope"), (False, None, "a"), (True, None, "1.2 Aim"), (True, None, "Loose"), (False, None, "b"), (True, None, "IV. Next"), (False, None, "c")]
    assert paths(rows) == [["1. Scope"], ["1. Scope"], ["1. Scope", "1.2 Aim"], ["1. Scope", "1.2 Aim", "Loose"], ["1. Scope", "1.2 Aim", "Loose"], ["IV. Next"], ["IV. Next"]]
    assert paths([(True, 2, "x"), (True, 3, " y  z "), (True, 2, "w")]) == [["x"], ["x", "y z"], ["w"]]


def test_page_section_paths(spark):
    blocks = catalog.queries()["html_blocks"](spark, SF).toPandas().sort_values(["page_id", "pos"])
    want = {}
    for page, b in blocks.groupby("page_id"):
        levels = {}
        for pos, label, level, text in b[["pos", "label", "level", "text"]].itertuples(index=False):
            if label == "section_header":
                levels = {k: v for k, v in levels.items() if k < level} | {level: " ".join(text.split())}
            want[page, pos] = " > ".join(v for _, v in sorted(levels.items()))
    assert {(r.page_id, r.pos): r.path for r in catalog.queries()["page_section_paths"](spark, SF).collect()} == want


def test_question_rewriting(spark):
    assert one(spark, X.glossary_expand(F.lit("abc ab c"), {"ab": ["x", "y"], "abc": ["y"]})) == "abc ab c\ny; x"
    assert one(spark, X.glossary_expand(F.lit("none"), {"ab": ["x"]})) == "none"
    assert one(spark, X.product_question(F.lit("Do A1, B2 and C3 (B2, C3) differ?"), F.lit("B2|C3"), F.lit("A1"))) == "A1: Do A1, and differ?"


def test_catalogs(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"meta": {}, "data": [{"a": 1}, {"a": 2}]}))
    assert catalogs.json_rows(spark, str(tmp_path / "c.json")).count() == 2
    (tmp_path / "c.csv").write_text("title\nBLA,Proper Name\n1,x\nBLA,Proper Name\n2,y\n3,z\n")
    assert [r.n for r in catalogs.last_csv_block(spark, str(tmp_path / "c.csv"), ("bla", "proper name"), "bla INT, n STRING").orderBy("bla").collect()] == ["y", "z"]
    with zipfile.ZipFile(tmp_path / "c.zip", "w") as z:
        z.writestr("Products.txt", "a\tb\n1\t2")
    assert catalogs.zip_tsv(spark, str(tmp_path / "c.zip"), "products").count() == 2


def test_stream(spark, tmp_path):
    from lodestone.streaming.events import hourly_counts

    spark.read.parquet(f"{SF}/events.parquet").write.parquet(str(tmp_path / "events"))
    q = hourly_counts(spark, str(tmp_path / "events")).writeStream.outputMode("complete").format("memory").queryName("hourly").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("hourly").agg(F.sum("n")).head()[0] == 1000


def test_store_keys(spark):
    from lodestone.sources.stores import outside, store_key

    cases = {"/srv/s/raw/a": "raw/a", "/srv/sx/raw/a": "/srv/sx/raw/a", "D:\\w\\data\\raw\\b\\c": "raw/b/c", "raw/a": "raw/a", "": "", None: None}
    assert [one(spark, store_key(F.lit(k).cast("string"), "/srv/s")) for k in cases] == list(cases.values())
    assert [one(spark, outside(F.lit(k), "/srv/s")) for k in ("/srv/s/raw/a", "/x", "raw/a")] == [False, True, False]


def test_registrations(spark):
    from lodestone.sources.registrations import registrations

    products = spark.createDataFrame([(2, "ABC IV", "Co", "d2"), (1, "ABC", "Co", "d1"), (3, " ", "Co", "d3"), (None, "X", "Co", "d4"), (5, "Lone's", None, "d5")], "drug_code long, brand_name string, company_name string, din string")
    made = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, None)], "drug_code long, ingredient_name string")
    status = spark.createDataFrame([(1, 0, "Old", "2020-05-01", None), (1, 1, "Not read", "2000-01-01", None), (2, 0, "", "", "2019-03-02")], "drug_code long, pos int, status string, original_market_date string, history_date string")
    got = {r.native_key: r.asDict() for r in registrations(products, made, status).collect()}
    assert got == {
        "DPD:abc:co": dict(native_key="DPD:abc:co", brand_name="Abc", ingredient="a, b", holder="Co", status="Old", first_market_date="2019-03-02", din=["d1", "d2"], drug_code=[1, 2], other_names=["ABC IV"]),
        "DPD:lones:": dict(native_key="DPD:lones:", brand_name="Lone's", ingredient=None, holder=None, status=None, first_market_date=None, din=["d5"], drug_code=[5], other_names=[]),
    }


def test_grid_cells(spark):
    from lodestone.operators.grids import grid_cells

    rows = [(1, 0, y, 20, y + 10, f"row {k}") for k, y in enumerate((90, 70, 50))]
    rows += [(1, x, y + up, x + 10, y + up + 10, f"{k}.5") for k, y in enumerate((90, 70, 50)) for x, up in ((40, 2), (80, -2))]
    rows += [(1, 30, 30, 36, 40, "far"), (1, 60, 30, 66, 40, "note"), (1, 0, 30, 5, 40, " ")]
    rows += [(2, 0, 10 * k, 5, 10 * k + 8, "12") for k in range(7)] + [(3, 0, 10 * k, 5, 10 * k + 8, "word") for k in range(9)]
    cells = grid_cells(spark.createDataFrame(rows, "k int, l int, b int, r int, t int, text string"), "k").collect()
    want = {(r, 0): f"row {r}" for r in range(3)} | {(r, c): f"{r}.5" for r in range(3) for c in (1, 2)} | {(3, 0): "far", (3, 1): "note"}
    assert {(c.row, c.col): c.text for c in cells} == want and {c.k for c in cells} == {1}
