"""Extra columns whose names clash with inner ones, repeated rows and odd values, for every operator and the pipeline."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lodestone.llm import katz, line_dedup, mixing, near_dup, packing, quality, rollups, secrets, suffix_dedup, topk

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = "_h _k _g _id _f _n _w _l _m _i _q _s _b _row _order _shard _source _start _copy _times gone grp kept size source_size taken target hash candidates n_words n_lines n_dropped n_shingles component_id sequence_id start length offset token_ids distance score held_out spans n_docs quota version n_tokens pos line v k".split()


@pytest.fixture(scope="module")
def rows():
    text = " ".join(f"word{i % 90} some{i % 37}" for i in range(80))
    out = [(i, f"{text} number {i * 7919} tail{i} more\nline {i} {'x' * i}", ["en", None][i % 2], ["a", "b", None][i % 3], i) for i in range(12)]
    out += [(20, None, None, None, None), (21, "", "en", "a", 0), (22, " \t\n\x0b ", "en", "a", 5), (None, "no id at all", "en", "a", 3), (23, "long " * 4000, "de", "b", 20000)]
    return out + out[:2]


@pytest.fixture(scope="module")
def plain(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def clash(plain):
    return plain.withColumns({c: F.lit("clash") for c in CLASH})


OPERATORS = {
    "quality": (lambda d: quality.judged(d, "doc_id"), ["doc_id", "n_words", "n_repeat_words", "base_failed"]),
    "packing": (packing.pack, ["doc_id", "start", "length", "doc_tokens"]),
    "suffix": (suffix_dedup.remove_repeats, ["doc_id", "n_bytes", "n_removed", "kept_sha256"]),
    "katz": (katz.score, ["doc_id", "held_out", "n_tokens", "n_known"]),
    "secrets": (secrets.find_secrets, ["doc_id", "n_assign", "base_sha256", "spans"]),
    "mixing": (mixing.mix, ["doc_id", "size", "source_size", "taken"]),
    "rollups": (rollups.counted, ["doc_id", "n_words", "n_tokens"]),
    "lines": (line_dedup.dedup_lines, ["doc_id", "text", "n_lines", "n_dropped"]),
    "near": (near_dup.near_duplicates, ["doc_id", "n_shingles", "component_id", "kept"]),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_columns_change_nothing(plain, clash, rows, name):
    run, cols = OPERATORS[name]
    a, b = (Counter(map(tuple, run(d).select(*cols).collect())) for d in (plain, clash))
    assert a == b
    if name != "packing":
        assert sum(a.values()) == len(rows)


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:4], ids=lambda s: s[0].replace(" ", "-"))
def test_stages_keep_columns(spark, plain, clash, stage):
    a, b = (stage[1](spark, d, "") for d in (plain, clash))
    assert a.columns == plain.columns and b.columns == clash.columns
    assert Counter(map(tuple, a.collect())) == Counter(map(tuple, b.select(*a.columns).collect()))
    assert b.filter("gone != 'clash' OR taken != 'clash'").isEmpty()


def test_topk_clash(spark):
    rows = [(i, [float(i % 7), 1.0]) for i in range(60)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    a, b = (Counter(map(tuple, topk.top_k(d, k=3).collect())) for d in (v, v.withColumns({c: F.lit("clash") for c in CLASH})))
    assert a == b and sum(a.values()) == 9
