"""Locations of stored objects: keys below a root instead of absolute paths."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the part after data/ of a path from another machine is the key.
FOREIGN = r"^.*[/\\]data[/\\]((?:raw|parsed)[/\\].+)$"
ABSOLUTE = r"^(?:[/\\]|[A-Za-z]:[/\\])"


def store_key(path: Column, root: str) -> Column:
    """The key of a path inside root, or inside the data folder of another machine; any other value as it is, null null."""
    inside = F.regexp_extract(path, f"^{re.escape(root.rstrip('/'))}/(.+)$", 1)
    foreign = F.translate(F.regexp_extract(path, FOREIGN, 1), "\\", "/")
    return F.when(inside != "", inside).when(foreign != "", foreign).otherwise(path)


def outside(path: Column, root: str) -> Column:
    """An absolute path that no key replaces."""
    return path.rlike(ABSOLUTE) & (store_key(path, root) == path)


def missing_objects(items: DataFrame, stored: DataFrame) -> DataFrame:
    """Put if absent: the distinct objects (agency, sha256, ext, ...) whose key is not in the store (key), with `key`."""
    key = F.concat(F.lit("raw/"), F.col("agency"), F.lit("/"), F.substring("sha256", 1, 2), F.lit("/"), F.col("sha256"), F.col("ext"))
    return items.withColumn("key", key).dropDuplicates(["key"]).join(stored.select("key"), "key", "left_anti")


def rekeyed(versions: DataFrame, tolerance: int = 64) -> DataFrame:
    """Versions under a new fingerprint: doc_id, keep_id, dropped_id, old_sha, new_sha, action.

    versions: doc_id, id, sha256, fingerprint (of the stored bytes; null if they are gone), size, html. For a document whose newest version is HTML and stored, the
    newest older version of the same page (same fingerprint, or, without bytes, a size within tolerance) stays and the newest goes; a single version is keyed anew."""
    from pyspark.sql import Window as W

    w = W.partitionBy("doc_id")
    v = versions.withColumn("_last", F.max("id").over(w)).withColumn("_n", F.count(F.lit(1)).over(w))
    newest = v.filter("id = _last AND html").select("doc_id", F.col("id").alias("new_id"), F.col("sha256").alias("_sha"), F.col("fingerprint").alias("new_sha"), F.col("size").alias("_size"), "_n")
    older = v.filter("id < _last").select("doc_id", "id", F.col("sha256").alias("_old"), "fingerprint", "size")
    same = F.when(F.col("fingerprint").isNotNull(), F.col("fingerprint") == F.col("new_sha")).otherwise(F.abs(F.coalesce("size", F.lit(0)) - F.coalesce("_size", F.lit(0))) <= tolerance)
    kept = newest.join(older, "doc_id").filter(same).groupBy("doc_id").agg(F.max("id").alias("keep_id"), F.max_by("_old", "id").alias("old_sha"))
    j = newest.join(kept, "doc_id", "left")
    single = F.col("keep_id").isNull() & (F.col("_n") == 1)
    action = F.when(F.col("new_sha").isNull(), "skipped_no_raw").when(F.col("keep_id").isNotNull(), "rekeyed").when(single & (F.col("_sha") == F.col("new_sha")), "unchanged").when(single, "rekeyed").otherwise("unresolved")
    done = action == "rekeyed"
    return j.select("doc_id", F.when(done, F.coalesce("keep_id", "new_id")).alias("keep_id"), F.when(done & F.col("keep_id").isNotNull(), F.col("new_id")).alias("dropped_id"), F.when(done, F.coalesce("old_sha", "_sha")).alias("old_sha"), F.when(done, F.col("new_sha")).alias("new_sha"), action.alias("action"))


def rewritten(table: DataFrame, moves: DataFrame) -> DataFrame:
    """A table keyed by sha256 after rekeying: rows of a moved version carry its new hash. A table with doc_id is met by document and hash; without, bytes that two
    documents shared go where the first of them went."""
    keys = ["doc_id", "sha256"] if "doc_id" in table.columns else ["sha256"]
    m = moves.filter("action = 'rekeyed'").select("doc_id", F.col("old_sha").alias("sha256"), F.col("new_sha").alias("_new"))
    m = m.groupBy(*keys).agg(F.min_by("_new", F.struct("doc_id", "_new")).alias("_new"))
    return table.join(m, keys, "left").withColumn("sha256", F.coalesce("_new", "sha256")).drop("_new").select(*table.columns)


def failed_fetches(docs: DataFrame, failures: DataFrame, versions: DataFrame) -> DataFrame:
    """docs (doc_id, status, error) after failures (doc_id, reason): the error is noted; the status becomes failed only without a version or while pending."""
    has = versions.select("doc_id").distinct().withColumn("_v", F.lit(True))
    j = docs.join(failures.groupBy("doc_id").agg(F.max("reason").alias("_why")), "doc_id", "left").join(has, "doc_id", "left")
    fails = F.col("_why").isNotNull() & (F.col("_v").isNull() | (F.col("status") == "pending"))
    return j.select("doc_id", F.when(fails, "failed").otherwise(F.col("status")).alias("status"), F.coalesce("_why", "error").alias("error"))


def write_manifest(records: DataFrame, path: str) -> None:
    """One JSON record per document, in the order of doc_id over the files."""
    records.repartitionByRange("doc_id").sortWithinPartitions("doc_id").write.mode("overwrite").json(path)


def write_export(chunks: DataFrame, parents: DataFrame, documents: DataFrame, path: str) -> None:
    """Index export: documents, chunks with their vectors, only the parents that chunks refer to, and a manifest with the rows of each."""
    chunks.write.mode("overwrite").parquet(f"{path}/chunks")
    documents.write.mode("overwrite").parquet(f"{path}/documents")
    parents.join(chunks.select("index_document_id", "parent_key").distinct(), ["index_document_id", "parent_key"], "left_semi").write.mode("overwrite").parquet(f"{path}/parents")
    spark = chunks.sparkSession
    counts = [(n, spark.read.parquet(f"{path}/{n}").count()) for n in ("chunks", "documents", "parents")]
    spark.createDataFrame(counts, "name string, rows long").coalesce(1).write.mode("overwrite").json(f"{path}/manifest")


def read_export(spark, path: str) -> dict[str, DataFrame]:
    """The tables of an export; refused if one has other rows than its manifest says."""
    out = {}
    for r in spark.read.schema("name string, rows long").json(f"{path}/manifest").collect():
        out[r["name"]] = spark.read.parquet(f"{path}/{r['name']}")
        if (n := out[r["name"]].count()) != r["rows"]:
            raise ValueError(f"{r['name']} has {n} rows, its manifest {r['rows']}")
    return out


def copy_tables(spark, tables: dict[str, str], target: str, paths: dict[str, str], root: str, references: dict[str, list[tuple[str, str]]] | None = None) -> dict[str, int]:
    """Copies tables (name: location) into an empty place, ids as they are; of columns named in `paths` absolute paths become keys. Returns rows per table.

    references names, per table, columns and the tables whose `id` they hold: a table is copied after those it refers to, and refused if an id it names is not there. A table may
    refer to itself: it is written first, then looked up in its own copy."""
    refs = references or {}
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(fs_path) and len(fs.listStatus(fs_path)):
        raise ValueError("the target is not empty")
    done: list[str] = []
    while len(done) < len(tables):
        ready = [n for n in tables if n not in done and all(of in done or of == n or of not in tables for _, of in refs.get(n, []))]
        if not ready:
            raise ValueError("tables refer to each other in a circle")
        for name in ready:
            df = spark.read.parquet(tables[name])
            df = df.withColumn(paths[name], store_key(F.col(paths[name]), root)) if name in paths else df
            df.write.parquet(f"{target}/{name}")
            done.append(name)
            for column, of in refs.get(name, []):
                ids = spark.read.parquet(f"{target}/{of}").select(F.col("id").alias(column))
                if not spark.read.parquet(f"{target}/{name}").filter(F.col(column).isNotNull()).join(ids, column, "left_anti").isEmpty():
                    raise ValueError(f"{name}.{column} names rows that {of} lacks")
    return {name: spark.read.parquet(f"{target}/{name}").count() for name in done}
