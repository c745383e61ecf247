"""Catalog sources: JSON with one list of rows, CSV with several header blocks, and tables in ZIP files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def json_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a JSON catalog: a list, or the first of data, items, results, rows, or the first list of records."""
    raw = spark.read.option("multiLine", True).json(path)
    lists = [f.name for f in raw.schema if f.dataType.simpleString().startswith("array<struct")]
    name = next((n for n in ("data", "items", "results", "rows") if n in lists), lists[0] if lists else None)
    return raw if name is None else raw.select(F.explode(name).alias("_r")).select("_r.*")


def last_csv_block(spark: SparkSession, path: str, marks: tuple[str, ...], schema: str) -> DataFrame:
    """Rows of the last block of a CSV whose header line (one that holds all marks, in any case) may occur again. Each file of a path has its own last block; a file is ordered by itself."""
    lines = spark.read.option("wholetext", True).text(path).select(F.input_file_name().alias("_file"), F.posexplode(F.split("value", "\r?\n")).alias("i", "line")).filter(F.trim("line") != "")
    head = F.lit(True)
    for m in marks:
        head = head & F.contains(F.lower("line"), F.lit(m.lower()))
    order = W.partitionBy("_file").orderBy("i").rowsBetween(W.unboundedPreceding, 0)
    numbered = lines.withColumn("_head", head).withColumn("_block", F.sum(F.when(head, 1).otherwise(0)).over(order))
    last = numbered.withColumn("_last", F.max("_block").over(W.partitionBy("_file"))).filter("_block = _last AND _block > 0 AND NOT _head")
    return last.select(F.from_csv("line", schema).alias("r")).select("r.*")


def zip_tsv(spark: SparkSession, path: str, hint: str) -> DataFrame:
    """Lines of the first member whose name holds the hint, as arrays of fields; UTF-8, else Latin-1."""

    def run(batches):
        import io
        import zipfile

        import pandas as pd

        for pdf in batches:
            rows = []
            for content in pdf["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    name = next((n for n in z.namelist() if hint.lower() in n.lower()), None)
                    raw = z.read(name) if name else b""
                try:
                    body = raw.decode("utf-8")
                except UnicodeDecodeError:
                    body = raw.decode("latin-1")
                rows += [(i, line.split("\t")) for i, line in enumerate(body.splitlines())]
            yield pd.DataFrame(rows, columns=["line", "fields"])

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "line long, fields array<string>")
