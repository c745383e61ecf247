"""Stored tables: snapshots published by one atomic commit each, batches that count once, a run log, and a sink for streams.

A table is a folder: data/<id> holds Parquet snapshots, commits/<n> names the snapshot of version n and the batch that made it, batches/<batch>/<n> says that the
batch tried to become version n. A writer reads the last version, looks whether its batch is among the commits up to it, writes the merged snapshot beside the
others, leaves its marker and creates the commit file, which only one writer can. So readers see whole versions only, a writer that dies leaves nothing but an
unread snapshot, one that loses the race merges again with the winner's rows, and a batch is never merged twice: a commit made after the writer's look has
the number that the writer itself wants. Markers are never overwritten, so a slow writer cannot hide a faster one's commit.

Creating a file that must not exist is atomic on HDFS and local disks. On an object store that has no such call, use a file system layer that offers it.
"""

from __future__ import annotations

import json
import traceback
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.operators import relational as R


class Folder:
    """Small files of a folder on any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _at(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def names(self, name: str) -> list[str]:
        fs, path = self._at(name)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def get(self, name: str) -> str | None:
        fs, path = self._at(name)
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """False if the file exists; no file is ever overwritten."""
        fs, path = self._at(name)
        if fs.exists(path):
            return False
        try:
            out = fs.create(path, False)
        except Exception as e:
            if "AlreadyExists" in str(e):
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def delete(self, name: str) -> None:
        fs, path = self._at(name)
        fs.delete(path, True)


class StoredTable:
    """A table of a fixed schema whose versions replace each other whole. keep: how many snapshots stay for readers of older versions."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keep: int = 2):
        self.spark, self.folder, self.path, self.schema, self.keep = spark, Folder(spark, path), path.rstrip("/"), schema, keep

    def version(self) -> int:
        """The last committed version; 0 before the first."""
        return max((int(n) for n in self.folder.names("commits") if n.isdigit()), default=0)

    def committed(self, batch: str) -> bool:
        for tried in self.folder.names(f"batches/{batch}"):
            commit = self.folder.get(f"commits/{tried}") if tried.isdigit() else None
            if commit and json.loads(commit)["batch"] == batch:
                return True
        return False

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version that is still kept, by default the last."""
        commit = self.folder.get(f"commits/{self.version() if version is None else version}")
        if commit is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{json.loads(commit)['table']}")

    def commit(self, batch: str, merge: Callable[[DataFrame], DataFrame]) -> bool:
        """Publishes merge(rows so far) as the next version, once for each batch id; False if the batch was committed before."""
        while True:
            base = self.version()
            if self.committed(batch):
                return False
            table = f"data/{base + 1}-{uuid.uuid4().hex}"
            merge(self.read(base)).write.parquet(f"{self.path}/{table}")
            self.folder.create(f"batches/{batch}/{base + 1}", "")
            if self.folder.create(f"commits/{base + 1}", json.dumps({"batch": batch, "table": table})):
                old = self.folder.get(f"commits/{base + 1 - self.keep}")
                if old:
                    self.folder.delete(json.loads(old)["table"])
                return True
            self.folder.delete(table)

    def upsert(self, batch: str, new: DataFrame, keys: list[str], **rules) -> bool:
        """Field-wise merge of a batch (relational.upsert); columns the batch does not bring keep their values."""
        return self.commit(batch, lambda old: R.upsert(old, completed(new, old), keys, **rules))

    def sink(self, name: str, keys: list[str], **rules) -> Callable[[DataFrame, int], None]:
        """For writeStream.foreachBatch: each micro-batch is a batch of this table, so a restarted query's replay changes nothing."""
        return lambda df, n: self.upsert(f"{name}-{n}", df, keys, **rules) and None


def completed(new: DataFrame, old: DataFrame) -> DataFrame:
    have = set(new.columns)
    return new.select(*[F.col(c) if c in have else F.lit(None).cast(t).alias(c) for c, t in old.dtypes])


VERSIONS = "doc_id long, sha256 string, path string, size long, retrieved_at timestamp, last_verified_at timestamp"


class VersionStore(StoredTable):
    """Content-hash history of documents: bytes seen before only move their time of verification."""

    def __init__(self, spark: SparkSession, path: str, keep: int = 2):
        super().__init__(spark, path, VERSIONS, keep)

    def add(self, batch: str, seen: DataFrame) -> bool:
        """seen: doc_id, sha256, path, size, at. Of equal (doc_id, sha256) in a batch the earliest gives path and size."""

        def merge(old: DataFrame) -> DataFrame:
            now = seen.groupBy("doc_id", "sha256").agg(F.min_by(F.struct("path", "size"), F.struct("at", "path")).alias("_f"), F.min("at").alias("_from"), F.max("at").alias("_to"))
            j = old.join(now, ["doc_id", "sha256"], "full_outer")
            return j.select("doc_id", "sha256", F.coalesce("path", "_f.path").alias("path"), F.coalesce("size", "_f.size").alias("size"), F.coalesce("retrieved_at", "_from").alias("retrieved_at"), F.greatest("last_verified_at", "_to").alias("last_verified_at"))

        return self.commit(batch, merge)


EVENTS = "run_id string, at timestamp, level string, kind string, agency string, program_id string, message string, detail string, n long"


class RunLog:
    """An event log that is only appended to, and runs on it: a run that ends by an exception leaves a `crash` event and is failed."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.folder = spark, path.rstrip("/"), Folder(spark, path)

    def append(self, events: DataFrame) -> None:
        """One file per call, written whole or not at all; columns that are not given are null, n is 1."""
        have = set(events.columns)
        fields = [f.split(" ") for f in EVENTS.split(", ")]
        default = {"at": F.current_timestamp(), "n": F.lit(1), "level": F.lit("info")}
        cols = [(F.col(c) if c in have else default.get(c, F.lit(None))).cast(t).alias(c) for c, t in fields]
        name = uuid.uuid4().hex
        events.select(*cols).write.parquet(f"{self.path}/parts/{name}")
        self.folder.create(f"whole/{name}", "")

    def events(self) -> DataFrame:
        """All events of appends that were finished."""
        whole = [f"{self.path}/parts/{n}" for n in self.folder.names("whole")]
        return self.spark.read.schema(EVENTS).parquet(*whole) if whole else self.spark.createDataFrame([], EVENTS)

    def run(self, run_id: str) -> Run:
        return Run(self, run_id)


class Run:
    def __init__(self, log: RunLog, run_id: str):
        self.log, self.run_id = log, run_id

    def event(self, kind: str, level: str = "info", message: str = "", n: int = 1, agency: str | None = None, program_id: str | None = None, **detail) -> None:
        row = (self.run_id, kind, level, message, n, agency, program_id, json.dumps(detail, sort_keys=True))
        self.log.append(self.log.spark.createDataFrame([row], "run_id string, kind string, level string, message string, n long, agency string, program_id string, detail string"))

    def events(self, rows: DataFrame) -> None:
        """Many events at once: kind and any other column of the log."""
        self.log.append(rows.withColumn("run_id", F.lit(self.run_id)))

    def __enter__(self) -> Run:
        self.event("start")
        return self

    def __exit__(self, kind, error, trace) -> bool:
        if error is None:
            self.event("finish")
        else:
            self.event("crash", "error", "".join(traceback.format_exception_only(kind, error)).strip())
        return False


OBJECTS = "key string, sha256 string, size long, content binary"


class ObjectTable:
    """Content-addressed bytes in Parquet parts that are only added: a key is raw/<agency>/<first two of the hash>/<hash><ext>, so a second put of the same bytes finds its key and writes nothing.

    A part counts once its marker stands; writers that put the same bytes at once leave two equal rows, of which readers see one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.folder = spark, path.rstrip("/"), Folder(spark, path)

    def _rows(self) -> DataFrame:
        whole = [f"{self.path}/parts/{n}" for n in self.folder.names("whole")]
        return self.spark.read.schema(OBJECTS).parquet(*whole) if whole else self.spark.createDataFrame([], OBJECTS)

    def keys(self) -> DataFrame:
        """(key, sha256, size), without reading any content."""
        return self._rows().select("key", "sha256", "size").distinct()

    def put(self, items: DataFrame) -> DataFrame:
        """items (agency, ext, content and more) with key and new (whether these bytes were not there). Pages are known by their fingerprint, other bytes by their hash; of
        pages with one fingerprint the first stored stay."""
        from lodestone.functions import text as X

        page = F.lower("ext").isin(".html", ".htm")
        sha = F.when(page, X.fingerprint(F.decode("content", "UTF-8"))).otherwise(F.sha2("content", 256))
        keyed = items.withColumn("_sha", sha).withColumn("key", F.concat(F.lit("raw/"), F.col("agency"), F.lit("/"), F.substring("_sha", 1, 2), F.lit("/"), F.col("_sha"), F.col("ext")))
        known = self.keys().select("key", F.lit(True).alias("_old"))
        fresh = keyed.join(known, "key", "left_anti").groupBy("key").agg(F.min("_sha").alias("sha256"), F.min("content").alias("content"))
        name = uuid.uuid4().hex
        fresh.select("key", "sha256", F.octet_length("content").cast("long").alias("size"), "content").write.parquet(f"{self.path}/parts/{name}")
        written_now = self.spark.read.schema(OBJECTS).parquet(f"{self.path}/parts/{name}").select("key", F.lit(True).alias("new"))
        self.folder.create(f"whole/{name}", "")
        return keyed.drop("_sha").join(written_now, "key", "left").withColumn("new", F.coalesce("new", F.lit(False)))

    def get(self, keys: DataFrame) -> DataFrame:
        """(key, content) of the keys (key) that are stored."""
        met = self._rows().join(keys.select("key").distinct(), "key", "left_semi")
        return met.groupBy("key").agg(F.min("content").alias("content"))
