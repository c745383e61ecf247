"""corpus_pipeline.run as a whole: what line dedup leaves of copies, and what reaches the sequences."""

import random
from pathlib import Path

import corpus_pipeline
from lodestone.llm.common import shared_dir


def table(spark, tmp_path, rows):
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(path)
    return str(tmp_path)


def test_run_counts_fragments(spark, tmp_path):
    """An exact copy is emptied by line dedup, a near copy keeps its own line, clean documents keep all; nothing is lost after that."""
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghijklm", k=rng.randint(3, 8))) for _ in range(3000)]
    texts = {i: "\n".join(" ".join(rng.choices(words, k=12)) for _ in range(12)) for i in range(1, 41)}
    texts[50] = texts[1]
    texts[51] = "\n".join([*texts[2].split("\n")[:11], " ".join(rng.choices(words, k=12))])
    texts[60], texts[61] = None, "too short"
    sf = table(spark, tmp_path, [(i, t, "en", "ab"[i % 2], len(t or "")) for i, t in texts.items()])
    out = corpus_pipeline.run(spark, sf, keep_stages=True).collect()

    newest = max(Path(shared_dir(spark).removeprefix("file:")).glob("lodestone/pipeline-*"), key=lambda p: p.stat().st_mtime)
    read = lambda k: {r.doc_id: r.text for r in spark.read.parquet(f"file://{newest}/{k}").collect()}
    kept, left, groups = read(0), read(1), read(2)
    assert set(texts) - set(kept) == {60, 61} and set(left) == set(kept)
    assert {i for i in left if left[i] != texts[i]} == {50, 51}
    assert not left[50].strip() and left[51].split() == texts[51].split("\n")[-1].split()
    assert set(groups) == set(left)  # a fragment is no near copy of what it was cut from
    mixed = [r.doc_id for r in spark.read.parquet(f"file://{newest}/3").collect()]
    assert sorted({r.doc_id for r in out}) == sorted(set(mixed))
    assert sum(r.length for r in out) == sum(r.doc_tokens for r in out if r.start == 0)


def test_run_on_empty_table(spark, tmp_path):
    assert corpus_pipeline.run(spark, table(spark, tmp_path, [])).isEmpty()


def test_stages_on_nulls_ties_repeats_and_long_texts(spark, tmp_path):
    """Every stage in turn over rows with nulls in each column, equal texts, repeated rows, one very long text and columns with clashing names."""
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghijklm", k=rng.randint(3, 8))) for _ in range(2000)]
    text = lambda n: "\n".join(" ".join(rng.choices(words, k=12)) for _ in range(n))
    rows = [(i, text(8), "en", "a", 1) for i in range(30)]
    rows += [(None, text(8), "en", "a", 1), (31, text(8), None, "a", 1), (32, text(8), "en", None, None), (33, None, "en", "a", 0), (34, "", "en", "a", 0)]
    rows += [(35, rows[3][1], "en", "b", 1), rows[4], (36, text(4000), "en", "a", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(*r, "x", 7) for r in rows], schema + ", kept string, size int")
    cols, n = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        n[name] = docs.count()
        assert k == 4 or docs.columns == cols
    assert n["quality rules"] == len(rows) - 2 == n["line dedup"]  # null and empty texts have too few words
    left = {r.doc_id for r in spark.read.parquet(f"{tmp_path}/2").collect()}
    assert {None, 3, 31, 32, 36} <= left
    packed = docs.groupBy("sequence_id", "offset").count().filter("count > 1")
    assert packed.isEmpty() and n["packing"] >= n["mixing sources"]
    again = corpus_pipeline.STAGES[4][1](spark, spark.read.parquet(f"{tmp_path}/3"), str(tmp_path))
    assert sorted(map(str, again.drop("token_ids").collect())) == sorted(map(str, docs.drop("token_ids").collect()))


def test_stage_tables_go(spark, tmp_path):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(80)), "en", "a", 1) for i in range(5)]
    assert not corpus_pipeline.run(spark, table(spark, tmp_path, rows)).isEmpty()
    newest = max(Path(shared_dir(spark).removeprefix("file:")).glob("lodestone/pipeline-*"), key=lambda p: p.stat().st_mtime)
    assert [p.name for p in newest.iterdir()] == ["4"]
