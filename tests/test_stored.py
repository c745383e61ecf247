"""Stored tables: a replay, a lost race, three writers of one batch, a crash; stream sink; versions; run log."""

import pytest
from pyspark.sql import functions as F

from lodestone.sources.stored import RunLog, StoredTable, VersionStore

SCHEMA = "k long, v string, seen date"


def rows(spark, *values):
    return spark.createDataFrame(list(values), "k long, v string")


def state(table):
    return {r.k: r.v for r in table.read().collect()}


def test_batches_and_replay(spark, tmp_path):
    table = StoredTable(spark, f"file://{tmp_path}/t", SCHEMA)
    assert state(table) == {} and table.version() == 0
    assert table.upsert("a", rows(spark, (1, "x"), (2, "y")), ["k"])
    assert table.upsert("b", rows(spark, (1, ""), (3, "z")), ["k"])  # an empty value does not replace
    assert not table.upsert("a", rows(spark, (1, "again")), ["k"])
    assert state(table) == {1: "x", 2: "y", 3: "z"} and table.version() == 2
    assert {r.k for r in table.read(1).collect()} == {1, 2}
    table.upsert("c", rows(spark, (9, "w")), ["k"])
    assert len(list((tmp_path / "t" / "data").iterdir())) == 2  # the oldest snapshot is gone
    assert state(StoredTable(spark, f"file://{tmp_path}/t", SCHEMA)) == {1: "x", 2: "y", 3: "z", 9: "w"}


def test_a_lost_race_merges_again(spark, tmp_path):
    one, two = (StoredTable(spark, f"file://{tmp_path}/t", SCHEMA) for _ in range(2))
    calls = []

    def slow(old):
        if not calls:
            two.upsert("b", rows(spark, (2, "b")), ["k"])  # commits the version that `one` wants
        calls.append(old.count())
        return old.unionByName(rows(spark, (1, "a")).withColumn("seen", F.lit(None).cast("date")))

    assert one.commit("a", slow) and calls == [0, 1]
    assert state(one) == {1: "a", 2: "b"} and one.version() == 2


def test_three_writers_of_one_batch(spark, tmp_path):
    """A second writer of batch a sleeps while another batch and the first writer commit; then it wakes up."""
    slow, other, first = (StoredTable(spark, f"file://{tmp_path}/t", "k long, n long") for _ in range(3))
    add = lambda old: old.unionByName(spark.createDataFrame([(1, 7)], "k long, n long")).groupBy("k").agg(F.sum("n").alias("n"))
    woken = []

    def merge(old):
        if not woken:
            woken.append(1)
            assert other.commit("b", add) and first.commit("a", add)
        return add(old)

    assert not slow.commit("a", merge)
    assert [r.n for r in slow.read().collect()] == [14] and slow.version() == 2 and slow.committed("a")


def test_a_crash_leaves_no_version(spark, tmp_path):
    table = StoredTable(spark, f"file://{tmp_path}/t", SCHEMA)
    table.upsert("a", rows(spark, (1, "x")), ["k"])
    with pytest.raises(RuntimeError):
        table.commit("b", lambda old: (_ for _ in ()).throw(RuntimeError("lost")))
    assert table.version() == 1 and not table.committed("b")
    table.folder.create("batches/b/2", "")  # died between marker and commit
    assert not table.committed("b") and table.upsert("b", rows(spark, (1, "y")), ["k"]) and state(table) == {1: "y"}


def test_stream_sink(spark, tmp_path):
    table = StoredTable(spark, f"file://{tmp_path}/t", SCHEMA)
    source = tmp_path / "in"
    rows(spark, (1, "x"), (2, "y")).coalesce(1).write.parquet(str(source / "1"))
    rows(spark, (2, "z")).coalesce(1).write.parquet(str(source / "2"))

    def run(check):
        q = spark.readStream.schema("k long, v string").option("maxFilesPerTrigger", 1).parquet(f"{source}/*").writeStream.foreachBatch(table.sink("s", ["k"])).option("checkpointLocation", str(tmp_path / check)).trigger(availableNow=True).start()
        q.awaitTermination()

    run("c1")
    once = state(table)
    assert set(once) == {1, 2} and table.version() == 2
    run("c2")  # the query lost its checkpoint and replays its batches
    assert state(table) == once and table.version() == 2


def test_versions(spark, tmp_path):
    store = VersionStore(spark, f"file://{tmp_path}/v")
    seen = lambda *r: spark.createDataFrame(list(r), "doc_id long, sha256 string, path string, size long, at string").withColumn("at", F.to_timestamp("at"))
    store.add("1", seen((1, "a", "p1", 5, "2024-01-01"), (1, "a", "p2", 5, "2024-01-02"), (2, "b", "q", 6, "2024-01-01")))
    store.add("2", seen((1, "a", "other", 5, "2024-02-01"), (1, "c", "p3", 7, "2024-02-01")))
    store.add("2", seen((1, "d", "never", 7, "2024-02-01")))
    got = {(r.doc_id, r.sha256): (r.path, str(r.retrieved_at)[:10], str(r.last_verified_at)[:10]) for r in store.read().collect()}
    assert got == {(1, "a"): ("p1", "2024-01-01", "2024-02-01"), (2, "b"): ("q", "2024-01-01", "2024-01-01"), (1, "c"): ("p3", "2024-02-01", "2024-02-01")}


def test_run_log(spark, tmp_path):
    log = RunLog(spark, f"file://{tmp_path}/log")
    assert log.events().isEmpty()
    with log.run("r1") as run:
        run.event("fetched", n=3, agency="ema", url="u")
        run.events(spark.createDataFrame([("fetched", 2)], "kind string, n long"))
    with pytest.raises(ValueError):
        with log.run("r2") as run:
            run.event("fetched")
            raise ValueError("no catalog")
    spark.createDataFrame([("r3", "fetched")], "run_id string, kind string").write.parquet(f"file://{tmp_path}/log/parts/half")  # an append that was not finished
    from lodestone.operators.metrics import run_counters

    got = {r.run_id: (r.fetched, r.errors, r.status) for r in run_counters(log.events()).collect()}
    assert got == {"r1": (5, 0, "ok"), "r2": (1, 1, "failed")}
    assert [r.message for r in log.events().filter("kind = 'crash'").collect()] == ["ValueError: no catalog"]
