"""Listings with a failing host, an empty page and a missing month; configuration and parsed JSON; positional export; replay; model batches and cached scores."""

import json
from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from lodestone import models
from lodestone.operators import replay as RP
from lodestone.sources import documents as D
from lodestone.sources import listing as LS
from lodestone.sources.stored import StoredTable


def put(folder, url, text):
    (folder / quote(url, safe="")).write_text(text)


def test_listings(spark, tmp_path):
    for k, body in enumerate(["<li>a</li><a>next</a>", "<li>b</li><li>c</li><a>next</a>", "<a>next</a>", "<li>never</li>"]):
        put(tmp_path, f"https://one.org/list?page={k}", body)
    put(tmp_path, "https://two.org/0", "<li>only</li>")  # no link on
    put(tmp_path, "https://m.org/2024-02", "no rows")
    put(tmp_path, "https://m.org/2023-12", "<li>x</li>")
    put(tmp_path, "https://m.org/2023-11", "<li>older</li>")
    put(tmp_path, "https://down.org/0", "<li>unseen</li>")
    page = dict(rows="<li>", next="next")
    listings = [dict(name="one", url="https://one.org/list?page={page}", **page), dict(name="two", url="https://two.org/{page}", **page), dict(name="months", url="https://m.org/{month}", rows="<li>", last="2024-03"), dict(name="down", url="https://down.org/{page}", **page), dict(name="bare", url="https://m.org/{month}", rows="<li>", last="2020-03", most=2), dict(name="months down", url="https://down.org/{month}", rows="<li>", last="2024-03")]
    argument = json.dumps({"folder": str(tmp_path), "down": ["down.org"]})
    df = LS.read_listings(spark, listings, "lodestone.sources.listing:files", argument, tries=2, pause=0)
    assert df.rdd.getNumPartitions() == 6
    got = {}
    for r in df.collect():
        got.setdefault(r.listing, []).append((r.key, r.status))
    assert got == {
        "one": [("0", "ok"), ("1", "ok"), ("2", "empty")],
        "two": [("0", "ok")],
        "months": [("2024-03", "missing"), ("2024-02", "empty"), ("2024-01", "missing"), ("2023-12", "ok")],
        "down": [("0", "failed")],
        "bare": [("2020-03", "missing"), ("2020-02", "missing")],
        "months down": [("2024-03", "failed")],
    }
    assert [(r.listing, r.key, bytes(r.content)) for r in LS.latest_month(df.filter("listing = 'months'")).collect()] == [("months", "2023-12", b"<li>x</li>")]
    assert [(r.key, r.pos, r.item) for r in LS.items(df.filter("listing = 'one'"), "<li>(.*?)</li>").orderBy("key", "pos").collect()] == [("0", 0, "a"), ("1", 0, "b"), ("1", 1, "c")]


def test_listings_are_read_lazily(spark, tmp_path):
    df = LS.read_listings(spark, [dict(name="x", url="https://a.org/{page}")], "no.such.module:make")
    assert df.columns == [f.split(" ")[0] for f in LS.SCHEMA.split(", ")]  # no fetcher is made before an action
    with pytest.raises(Exception, match="No module named"):
        df.collect()


def test_endless_listing_is_bounded():
    seen = [r[1] for r in LS.walked(dict(name="x", url="https://a.org/{page}", rows="."), lambda url: b"row")]
    assert seen == [str(k) for k in range(LS.MOST_PAGES)]


def test_polite_fetching():
    now, slept, calls = [0.0], [], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    def polite(*answers, **kw):
        left = list(answers)

        def fetch(url):
            calls.append(url)
            a = left.pop(0)
            if isinstance(a, Exception):
                raise a
            return a

        return LS.Polite(fetch, clock=lambda: now[0], sleep=sleep, **kw)

    p = polite((500, b""), ConnectionError("cut"), (200, b"x"))
    assert p.get("https://a.org/1") == b"x" and p.get("https://a.org/1") == b"x" and len(calls) == 3
    assert [s for s in slept if s] == [2, 4]  # pauses between tries are longer than the host's own
    slept.clear()
    p = polite((200, b"x"), (200, b"y"), (200, b"z"))
    p.get("https://a.org/1"), p.get("https://a.org/2"), p.get("https://b.org/1")
    assert [s for s in slept if s] == [1.0]  # one host waits, the other does not
    p = polite((429, b""), (200, b"x"))
    for _ in range(2):
        with pytest.raises(LS.FetchFailed) as e:
            p.get("https://a.org/1")
        assert e.value.kind == "blocked"
    now[0] += LS.COOLDOWN + 1
    assert p.get("https://a.org/1") == b"x"
    calls.clear()
    for status, kind in ((404, "missing"), (403, "failed")):
        with pytest.raises(LS.FetchFailed) as e:
            polite((status, b"")).get("https://a.org/1")
        assert e.value.kind == kind
    assert len(calls) == 2  # no second try
    with pytest.raises(LS.FetchFailed) as e:
        polite((200, b"12345"), most_bytes=4).get("https://a.org/1")
    assert e.value.kind == "large"


def test_config_and_parsed(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"programs": [{"id": "P1", "role": "reference", "ingredient": "x", "codes": ["C-1"], "aliases": {"ema": ["N", "M"]}, "holdout": True, "other": 1}, {"id": "P2"}], "glossary": {"ab": ["c", "d"]}, "guidances": [{"id": "g", "url": "u"}]}))
    c = D.config(spark, str(tmp_path / "c.json"))
    assert [(r.program_id, r.ord, r.holdout) for r in c["programs"].orderBy("ord").collect()] == [("P1", 0, True), ("P2", 1, False)]
    assert {(r.program_id, r.agency, r.name) for r in c["names"].collect()} == {("P1", None, "P1"), ("P1", None, "C-1"), ("P1", "ema", "N"), ("P1", "ema", "M"), ("P2", None, "P2")}
    assert [tuple(r) for r in c["glossary"].collect()] == [("ab", ["c", "d"])] and c["guidances"].count() == 1
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "1.json").write_text(json.dumps({"document_id": 1, "sha256": "s", "engine": "e", "unknown": {}, "blocks": [{"type": "text", "page": 1, "text": "a", "bbox": [1, 2, 3, 4]}, {"type": "table", "page": 2, "n_rows": 1, "cells": [{"r": 0, "c": 0, "text": "x", "header": True}]}]}))
    (tmp_path / "p" / "2.json").write_text(json.dumps({"document_id": 2, "blocks": []}))
    b = D.parsed_blocks(D.parsed_documents(spark, str(tmp_path / "p"))).orderBy("pos").collect()
    assert [(r.document_id, r.pos, r.type, r.text) for r in b] == [(1, 0, "text", "a"), (1, 1, "table", None)] and b[1].cells[0].header
    (tmp_path / "ids.txt").write_text("3 1\n\n 2\t3 ")
    assert sorted(r.id for r in D.id_list(spark, str(tmp_path / "ids.txt")).collect()) == [1, 2, 3]


def export(spark, path, n=95):
    df = spark.range(n).select(F.col("id").alias("chunk_id"), F.concat(F.lit("text "), "id").alias("text"), F.array(F.col("id").cast("double")).alias("dense"))
    D.write_positional(df, f"file://{path}", {"chunks": ["chunk_id", "text"], "dense": ["dense"]}, ["chunk_id"], rows=20)


def test_positional_round_trip(spark, tmp_path):
    export(spark, tmp_path)
    got = D.read_positional(spark, f"file://{tmp_path}").collect()
    assert len(got) == 95 and all(r.text == f"text {r.chunk_id}" and r.dense == [r.chunk_id] for r in got)
    assert json.loads((tmp_path / "manifest.json").read_text())["rows"] == 95


def test_positional_export_with_a_row_too_few_is_refused(spark, tmp_path):
    export(spark, tmp_path)
    part = sorted((tmp_path / "dense").glob("part=*"))[1]
    keep = spark.read.parquet(str(part)).limit(5).toPandas()
    for f in part.iterdir():
        f.unlink()
    keep.to_parquet(part / "part-0.parquet")
    with pytest.raises(ValueError, match="dense"):
        D.read_positional(spark, f"file://{tmp_path}")
    with pytest.raises(ValueError, match="manifest"):
        D.read_positional(spark, f"file://{tmp_path}/nothing")


def test_numbers_without_a_global_window(spark):
    df = spark.createDataFrame([(x,) for x in [5, 3, 9, 1, 7, 7, 2]], "x int").repartition(3)
    assert [r.n for r in D.renumbered(df, ["x"], "n").orderBy("x", "n").collect()] == list(range(1, 8))


STAGES = [("ocr", "1"), ("fix", "3"), ("structure", "2")]


def test_replay_plan(spark):
    rows = [("a", "r+ocr.1+fix.3+structure.2", "ok"), ("b", "r+ocr.1+fix.2+structure.2", "ok"), ("c", "r+ocr.1+fix.3+structure.1", "ok"), ("d", "r+ocr.0+fix.3+structure.2", "ok"), ("e", "q+ocr.1+fix.3+structure.2", "ok"), ("f", "r+ocr.1", "ok"), ("g", "r+ocr.1+fix.3+structure.2+more.1", "ok"), ("h", "r+ocr.1+fix.2+structure.2", "failed"), ("i", "r+ocr.1+fix.1", "ok"), ("i", "r+ocr.1+fix.3+structure.1", "ok"), ("j", "r+ocr.1+fix.3+structure.2", "ok"), ("j", "r+ocr.1+fix.1", "ok")]
    got = {(r.sha256, r.engine): (r.action, r.from_stage) for r in RP.planned(spark.createDataFrame(rows, "sha256 string, engine string, status string"), "r", STAGES, {"fix", "structure"}).collect()}
    want = [("current", None), ("replay", 1), ("replay", 2), ("reparse", None), ("reparse", None), ("replay", 1), ("reparse", None), ("none", None), ("none", None), ("replay", 2), ("current", None), ("none", None)]
    assert got == {(s, e): w for (s, e, _), w in zip(rows, want)}


def test_replay_runs_only_what_changed_and_once(spark, tmp_path):
    table = StoredTable(spark, f"file://{tmp_path}/t", "sha256 string, engine string, status string, text string")
    rows = [("a", "r+ocr.1+fix.3+structure.2", "ok", "A"), ("b", "r+ocr.1+fix.2+structure.2", "ok", "B"), ("c", "r+ocr.1+fix.3+structure.1", "ok", "C"), ("d", "r+ocr.0", "ok", "D")]
    table.commit("load", lambda old: spark.createDataFrame(rows, "sha256 string, engine string, status string, text string"))
    run = {n: (lambda df, n=n: df.withColumn("text", F.concat("text", F.lit(f"-{n}")))) for n in ("fix", "structure")}
    assert RP.replay(table, "r", STAGES, run) == 2
    now = RP.engine_of("r", STAGES)
    assert {r.sha256: (r.engine, r.text) for r in table.read().collect()} == {"a": (now, "A"), "b": (now, "B-fix-structure"), "c": (now, "C-structure"), "d": ("r+ocr.0", "D")}
    at = table.version()
    assert RP.replay(table, "r", STAGES, run) == 0 and table.version() == at


def test_batches_by_padded_cost():
    lengths = [10, 10, 12, 40, 41, 900, 8192, 20_000, 5]
    parts = models.padded_batches(lengths, 100)
    assert [lengths[p] for p in parts] == [[10, 10, 12], [40, 41], [900], [8192], [20_000], [5]]
    assert models.padded_batches([]) == []


def test_no_model_call_exceeds_the_cost(spark, tmp_path):
    class Recorder(models.HashEmbedder):
        def encode(self, texts):
            with open(tmp_path / f"{id(texts)}-{len(list(tmp_path.iterdir()))}", "w") as f:
                f.write(json.dumps([models.text_tokens(t) for t in texts]))
            return super().encode(texts)

    texts = spark.createDataFrame([("word " * n,) for n in range(1, 200)] + [(None,), ("word ",)], "text string").repartition(4)
    assert models.embedded(texts, Recorder, most=2000).count() == 199
    calls = [json.loads(f.read_text()) for f in tmp_path.iterdir()]
    assert sum(map(len, calls)) == 199 and all(max(c) * len(c) <= 2000 for c in calls) and max(map(len, calls)) > 5


def test_each_pair_is_scored_once_over_two_runs(spark, tmp_path):
    class Counting(models.OverlapScorer):
        def score(self, pairs):
            with open(tmp_path / f"n{len(list(tmp_path.iterdir()))}-{id(pairs)}", "w") as f:
                f.write(json.dumps(pairs))
            assert len(pairs) <= models.PASSAGES
            return super().score(pairs)

    cache = StoredTable(spark, f"file://{tmp_path}-cache", models.SCORES)
    pairs = [("s", i, "a b", f"b {i % 12}") for i in range(30)] + [("t", 1, "a b", "b 1"), ("t", 2, "c", "")]
    df = spark.createDataFrame(pairs, "search string, chunk_id long, query string, passage string")
    first = {(r.search, r.chunk_id): r.score for r in models.scored_with_cache(df, cache, "1", Counting).collect()}
    more = df.union(spark.createDataFrame([("u", 5, "a b", "new b")], df.schema))
    second = {(r.search, r.chunk_id): r.score for r in models.scored_with_cache(more, cache, "2", Counting).collect()}
    asked = [tuple(p) for f in tmp_path.iterdir() for p in json.loads(f.read_text())]
    assert len(asked) == len(set(asked)) == 14
    assert len(first) == 32 and second == first | {("u", 5): 0.5} and first["s", 3] == 0.5
    plain = {(r.search, r.chunk_id): r.score for r in models.scored_pairs(df).collect()}
    assert plain == first
