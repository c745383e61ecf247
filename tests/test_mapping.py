"""Program mapping, unique names, targets, page runs to a parser, character references, object store: on cases with known results."""

import random

from pyspark.sql import functions as F

from lodestone import models
from lodestone.functions import text as X
from lodestone.operators import claims as C
from lodestone.operators import mapping, resolution, structure
from lodestone.sources.stored import ObjectTable

CATALOG = "id long, agency string, native_key string, brand string, holder string, reference boolean, approved string, ingredient string, names array<string>"


def row(i, agency, brand, holder="Co", reference=None, approved="2020-01-01", ingredient="ingredient-x"):
    return (i, agency, f"{agency}:{brand}", brand, holder, reference, approved, ingredient, [brand])


REGS = [
    row(1, "fda", "Curated One"), row(2, "ema", "Alphabrand", "Acme"), row(3, "fda", "Alphabrand", "Acme", approved="2019-01-01"), row(4, "ema", "Betabrand", "Bcorp"),
    row(5, "fda", "Hidden", "Hco"), row(6, "fda", "Origin", "Ref", True, "2010-01-01"),
]


def mapped(spark, rows=REGS, **kw):
    df = spark.createDataFrame(rows, CATALOG)
    aliases = spark.createDataFrame([("P1", 0, "fda", "Curated One"), ("P1", 0, None, "C-1")], "program_id string, ord int, agency string, alias string")
    out = spark.createDataFrame([("Hidden",)], "alias string")
    taken = spark.createDataFrame([("betabrand",)], "name string")
    got, new = mapping.mapped(df, aliases, out, taken, **kw)
    return {r.id: (r.program_id, r.action) for r in got.collect()}, {r.program_id: r.role for r in new.collect()}


def test_all_of_a_catalog(spark):
    got, new = mapped(spark)
    assert got == {1: ("P1", "curated"), 2: ("Alphabrand", "auto"), 3: ("Alphabrand", "auto"), 4: ("Betabrand-2", "auto"), 5: (None, "held_out"), 6: ("Origin", "auto")}
    assert new == {"Alphabrand": "biosimilar", "Betabrand-2": "biosimilar", "Origin": "reference"}


def test_without_new_programs(spark):
    got, new = mapped(spark, auto=False)
    assert {i for i, x in got.items() if x == (None, "unmapped")} == {2, 3, 4, 6} and got[5] == (None, "held_out") and not new


def test_an_unknown_product_widens_to_its_ingredient(spark):
    asked = []

    def widen(ingredient):
        asked.append(ingredient)
        return spark.createDataFrame(REGS, CATALOG)

    got, new = mapped(spark, [REGS[1]], requested=True, widen=widen)
    assert asked == ["ingredient-x"] and set(new) == {"Alphabrand"}
    assert got == {1: ("P1", "curated"), 2: ("Alphabrand", "auto"), 3: ("Alphabrand", "auto"), 4: (None, "skipped"), 5: (None, "skipped"), 6: (None, "skipped")}
    assert mapped(spark, [REGS[0]], requested=True, widen=widen) == ({}, {})  # nothing that the registry does not know


def test_names_count_on_until_free(spark):
    rng = random.Random(1)
    wanted = [(i, rng.choice(["Brandara", "brandara", "Brandara-2", "Other"]), rng.random()) for i in range(25)]
    taken = {"brandara", "brandara-2", "x"}
    want, held = {}, set(taken)
    for i, base, _ in sorted(wanted, key=lambda w: w[2]):
        name, n = base, 2
        while name.lower() in held:
            name, n = f"{base}-{n}", n + 1
        held.add(name.lower())
        want[i] = name
    df = spark.createDataFrame(wanted, "cluster long, base string, o double").withColumn("order", F.struct("o"))
    got = resolution.unique_names(df, spark.createDataFrame([(x,) for x in taken], "name string")).collect()
    assert {r.cluster: r.program_id for r in got} == want


def test_targets(spark):
    programs = spark.createDataFrame([("P1", "x", False), ("P2", "x", True), ("P3", "y", False)], "program_id string, ingredient string, holdout boolean")
    names = spark.createDataFrame([("P1", "CT-P43"), ("P3", "Why")], "program_id string, name string")
    got = lambda *a, **k: sorted(tuple(r) for r in resolution.resolve_target(programs, names, *a, **k).collect())
    assert got(["ct p43", "Unknown"], None) == [("P1", "selected"), ("Unknown", "unknown")]
    assert got(None, "x") == [("P1", "selected"), ("P2", "excluded")] and got(None, "x", include_holdout=True) == [("P1", "selected"), ("P2", "selected")]


def test_page_runs_go_to_the_parser(spark):
    class Pages:
        def pages(self, content, first, last, mode):
            return [("text", None, p, f"{content.decode()} {p} {mode}") for p in range(first, last + 1)]

    routes = [("a", p, r) for p, r in [(1, "DIGITAL"), (2, "DIGITAL"), (3, "IMAGE"), (4, "MIXED"), (6, "MIXED"), (7, "BROKEN_TEXT")]]
    runs = structure.page_runs(spark.createDataFrame(routes, "doc string, page int, route string")).withColumnRenamed("doc", "path")
    assert sorted((r["mode"], r["first"], r["last"]) for r in runs.collect()) == [("auto", 3, 4), ("auto", 6, 6), ("full", 7, 7), ("none", 1, 2)]
    files = spark.createDataFrame([("a", b"x"), ("b", b"y")], "path string, content binary")
    got = sorted((r.page, r.text) for r in models.parsed_runs(files, runs, Pages).collect())
    assert got == [(1, "x 1 none"), (2, "x 2 none"), (3, "x 3 auto"), (4, "x 4 auto"), (6, "x 6 auto"), (7, "x 7 full")]


def test_character_references(spark):
    import html

    cases = ["a &amp; b", "&lt;b&gt; &quot;x&quot; &#39;y&#39;", "caf&eacute; &#8212; &#x41; &hellip;", "&amp;eacute; stays", "AT&T; &unknown; R&D", "", None, "&amp;lt;"]
    got = [r[0] for r in spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, t string").orderBy("i").select(X.unescaped(F.col("t"))).collect()]
    assert got == [c if c is None else html.unescape(c).replace(" ", " ") for c in cases]
    assert spark.createDataFrame([("<p>a<br>b</p>&nbsp; &eacute;",)], "t string").select(X.strip_html(F.col("t"))).head()[0] == "a b é"


def test_object_store(spark, tmp_path):
    store = ObjectTable(spark, f"file://{tmp_path}/o")
    items = spark.createDataFrame([(1, "ema", ".pdf", b"one"), (2, "ema", ".pdf", b"one"), (3, "ema", ".html", b"<main>x</main><p>1</p>"), (4, "fda", ".pdf", b"one")], "i int, agency string, ext string, content binary")
    first = {r.i: (r.key, r.new) for r in store.put(items).collect()}
    assert all(new for _, new in first.values()) and first[1] == first[2] and first[1][0] != first[4][0]
    again = store.put(spark.createDataFrame([(5, "ema", ".html", b"<main>x</main><p>2</p>"), (6, "ema", ".pdf", b"two")], items.schema))  # only what changes on every request differs
    assert {r.i: r.new for r in again.collect()} == {5: False, 6: True}
    assert store.keys().count() == 4
    got = {r.key: bytes(r.content) for r in store.get(spark.createDataFrame([(first[1][0],), ("none",)], "key string")).collect()}
    assert got == {first[1][0]: b"one"}
    (tmp_path / "o" / "whole" / "half").write_text("")  # a marker needs its part; parts without a marker are not read
    (tmp_path / "o" / "whole" / "half").unlink()
    items.selectExpr("'k' AS key", "'s' AS sha256", "1L AS size", "content").write.parquet(f"file://{tmp_path}/o/parts/unfinished")
    assert store.keys().count() == 4


def test_comparator_names_are_no_filter(spark):
    pattern = X.name_pattern("Brandara", reference=True)
    rows = spark.createDataFrame([("about Brandara",), ("compared to EU-Brandara",), ("and US Brandara too",), ("EU-Brandara and Brandara",)], "t string")
    assert [r[0] for r in rows.select(F.col("t").rlike(pattern)).collect()] == [True, False, False, True]
    assert spark.createDataFrame([("EU-Brandara",)], "t string").select(F.col("t").rlike(X.name_pattern("Brandara"))).head()[0]


def test_prompt_budget(spark):
    blocks = spark.createDataFrame([("s", 1, "A", "w" * 400, "h", 2), ("s", 2, "A", "w" * 4000, "h", 2), ("s", 3, "B", "w" * 40, None, 1), ("s", 4, None, "w" * 40, "", 0)], "search string, first_rank int, product string, text string, section string, n_lines int")
    got = {r.first_rank: (r.cost, r.admitted, r.reason) for r in C.prompt_pack(blocks, spark.createDataFrame([("s", "q" * 8)], "search string, question string"), 300, 100).collect()}
    assert got == {1: (117, True, None), 2: (1017, False, "whole_block_exceeds_input_budget"), 3: (18, True, None), 4: (10, True, None)}
