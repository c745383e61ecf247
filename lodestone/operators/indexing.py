"""Index decisions: which documents to index, and what an index run does with each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.operators.relational import latest

KEY = ["document_id", "sha256", "prep_engine", "chunker", "embed_model", "meta_hash"]
#: Fields of the metadata that may change without a new index.
VOLATILE = ["retrieved_at", "storage_path", "content_type"]


def meta_hash(record: Column, fields: list[str]) -> Column:
    """Hash of a record's lasting fields, in the order of their names."""
    kept = [record[f].alias(f) for f in sorted(fields) if f not in VOLATILE]
    return F.sha1(F.to_json(F.struct(*kept), {"ignoreNullFields": "false"}))


def candidates(versions: DataFrame, parses: DataFrame, engine: str) -> DataFrame:
    """document_id, sha256, action (index, retire, not_parsed), prep_engine, reason: the latest version of each document against its parses.

    Of several good parses the current engine's counts, else the newest. versions: document_id, sha256, retrieved_at, id; parses: id, sha256, engine, status, reason."""
    newest = latest(versions, ["document_id"], F.desc("retrieved_at"), F.desc("id")).select("document_id", "sha256")
    good = F.when(F.col("status") == "ok", F.struct(F.startswith("engine", F.lit(engine + "+")).alias("now"), F.col("id")))
    skipped = F.when(F.col("status") == "skipped", F.col("id"))
    per = parses.groupBy("sha256").agg(F.max_by("engine", good).alias("prep_engine"), F.max(good).isNotNull().alias("_ok"), F.min_by("reason", skipped).alias("_why"), F.min(skipped).isNotNull().alias("_skip"), F.lit(True).alias("_some"))
    j = newest.join(per, "sha256", "left")
    ok, skip, some = (F.coalesce(c, F.lit(False)) for c in ("_ok", "_skip", "_some"))
    action = F.when(ok, "index").when(skip, "retire").otherwise("not_parsed")
    reason = F.when(ok, "").when(skip, F.concat(F.lit("prep skipped: "), F.coalesce("_why", F.lit("")))).when(some, "failed").otherwise("not preprocessed yet")
    return j.select("document_id", "sha256", action.alias("action"), F.when(ok, F.col("prep_engine")).alias("prep_engine"), reason.alias("reason"))


def decided(wanted: DataFrame, stored: DataFrame) -> DataFrame:
    """Outcome per stored or wanted index document: cached, reactivated, indexed, retired (replaced by another of the document and model) or kept.

    wanted: the six key columns; stored: index_id, the key columns, status, retired (boolean). A stored one is retired where its document and model are
    wanted under another key."""
    new = wanted.select(*KEY, F.lit(True).alias("_want"))
    old = stored.withColumn("_have", F.lit(True))
    j = new.join(old, KEY, "full_outer")
    ask = wanted.select("document_id", "embed_model").distinct().withColumn("_asked", F.lit(True))
    j = j.join(ask, ["document_id", "embed_model"], "left")
    want, have = F.col("_want").isNotNull(), F.col("_have").isNotNull() & F.coalesce(F.col("status") == "ok", F.lit(False))
    outcome = F.when(want & have & ~F.col("retired"), "cached").when(want & have, "reactivated").when(want, "indexed").when(F.col("_asked").isNotNull() & ~F.coalesce("retired", F.lit(False)), "retired").otherwise("kept")
    return j.select(*KEY, "index_id", outcome.alias("outcome"))


def to_embed(texts: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(reused, missing): texts (chunk_id, embed_hash) with a stored vector of the same hash (embed_hash, id, vector; the first counts), and the distinct hashes without one."""
    first = stored.groupBy("embed_hash").agg(F.min_by("vector", "id").alias("vector"))
    return texts.join(first, "embed_hash"), texts.select("embed_hash").distinct().join(first, "embed_hash", "left_anti")


def status(index_documents: DataFrame) -> DataFrame:
    """Counts by model, chunker, status and whether it is active."""
    return index_documents.groupBy("embed_model", "chunker", "status", F.col("retired").alias("retired")).agg(F.count(F.lit(1)).alias("n"))
