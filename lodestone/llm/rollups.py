"""Token counts in delta-maintained rollups.

A rollup holds additive totals (documents, tokens) by source, language and tokenizer version. Batches of changes come as
signed rows: an insert adds, a delete subtracts, a revision subtracts the old count and adds the new. A batch is summed map-side, merged
with the stored totals and published as their next version (lodestone.sources.stored): totals are read as they are stored, one row per group, however
many batches came before, and nothing is recounted or summed again. A batch that is committed again does nothing, one that failed halfway is merged
anew, and a writer that lost the race merges again with the new totals, whatever number of writers bring the same batch.

Defined cases: null source and language are groups of their own; a null text has 0 tokens; repeated rows count as often as they
come; groups whose documents and tokens all cancel are left out; an empty table gives no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.sources.stored import StoredTable

from .common import chunks, cut, shared_dir, table
from .tokens import default_path, worker_cache

KEYS = ["source", "lang", "version"]
SCHEMA = "source string, lang string, version string, n_docs long, n_tokens long"


def counted(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, source, lang, n_words, n_tokens) of whole texts."""
    path = path or default_path()

    def run(batches):
        import pyarrow as pa

        cache = worker_cache(path)
        for ids, source, lang, texts in chunks(batches, ["doc_id", "source", "lang", "text"], 4 << 20):
            n = cache.counts(texts)
            words = [len(t.split()) if t else 0 for t in texts]
            text = lambda c: pa.array([x.decode() if x is not None else None for x in c], pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), text(source), text(lang), pa.array(words, pa.int64()), pa.array(n)], ["doc_id", "source", "lang", "n_words", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("lang").cast("string"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, source string, lang string, n_words long, n_tokens long")


def inserts(rows: DataFrame, version: str, count: str) -> DataFrame:
    return rows.select("source", "lang", F.lit(version).alias("version"), F.lit(1).cast("long").alias("n_docs"), F.col(count).cast("long").alias("n_tokens"))


def deletes(rows: DataFrame, version: str, count: str) -> DataFrame:
    return inserts(rows, version, count).withColumns({c: -F.col(c) for c in ("n_docs", "n_tokens")})


def revisions(rows: DataFrame, version: str, old: str, new: str) -> DataFrame:
    return deletes(rows, version, old).union(inserts(rows, version, new))


class Rollup(StoredTable):
    """Stored totals in a shared folder, one row per group; a batch is merged into them once."""

    def __init__(self, spark: SparkSession, path: str, keep: int = 2):
        super().__init__(spark, path, SCHEMA, keep)

    def commit(self, batch: str, signed: DataFrame) -> bool:
        """Merges the batch into the stored totals; False if it was committed before."""
        total = lambda df: df.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        summed = total(signed)
        return super().commit(batch, lambda old: total(old.unionByName(summed)).filter("n_docs != 0 OR n_tokens != 0"))

    def totals(self) -> DataFrame:
        """The stored totals: one row per group."""
        return self.read()


def op8_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents enter under words-1 and word_bpe_49k-1; then word_bpe_49k-1 is revised by the final id; then documents labelled toxic leave; then the first batch is replayed."""
    docs = cut(counted(table(spark, sf_dir, "documents")).withColumn("n_final", F.col("n_tokens") + 1))
    toxic = table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id").distinct()
    rollup = Rollup(spark, f"{shared_dir(spark)}/lodestone/rollup-{uuid.uuid4().hex}")
    first = inserts(docs, "words-1", "n_words").union(inserts(docs, "word_bpe_49k-1", "n_tokens"))
    rollup.commit("1-insert", first)
    rollup.commit("2-revise", revisions(docs, "word_bpe_49k-1", "n_tokens", "n_final"))
    gone = docs.join(toxic, "doc_id", "left_semi")
    rollup.commit("3-delete", deletes(gone, "words-1", "n_words").union(deletes(gone, "word_bpe_49k-1", "n_final")))
    rollup.commit("1-insert", first)
    return rollup.totals()
