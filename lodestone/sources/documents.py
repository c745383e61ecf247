"""Configuration and parsed documents as tables: JSON with explicit schemas, exports by row position, lists of ids."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.sources.stored import Folder

CONFIG = "programs array<struct<id:string,role:string,ingredient:string,developer:string,codes:array<string>,aliases:map<string,array<string>>,holdout:boolean>>, glossary map<string,array<string>>, guidances array<struct<id:string,url:string,title:string,status:string,published_at:string>>"
CELL = "array<struct<r:int,c:int,rs:int,cs:int,text:string,header:boolean,bbox:array<double>>>"
BLOCK = f"struct<type:string,ref:string,parent:string,page:int,bbox:array<double>,layer:string,route:string,source:string,status:string,speaker:string,study_ids:array<string>,section_path:array<string>,label:string,text:string,furniture:boolean,redacted:boolean,level:int,caption:string,n_rows:int,n_cols:int,cells:{CELL}>"
PARSED = f"document_id long, sha256 string, agency string, doc_type string, program_id string, engine string, watermarks_removed int, routes array<struct<page:int,route:string,reason:string>>, blocks array<{BLOCK}>, text_fixes map<string,long>"


def config(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Tables of a JSON configuration: programs (program_id, role, ingredient, developer, holdout), names (program_id, ord, agency, name; ids and codes have no agency), glossary (term, to), guidances.

    Order is the file's: ord numbers the programs as they stand there, which decides between programs that match a name alike."""
    whole = spark.read.schema(CONFIG).json(path, multiLine=True)
    p = whole.select(F.posexplode("programs").alias("ord", "p"))
    own = p.select(F.col("p.id").alias("program_id"), "ord", F.lit(None).cast("string").alias("agency"), F.explode(F.concat(F.array("p.id"), F.coalesce("p.codes", F.array().cast("array<string>")))).alias("name"))
    by_agency = p.select(F.col("p.id").alias("program_id"), "ord", F.explode("p.aliases").alias("agency", "_n")).select("program_id", "ord", "agency", F.explode("_n").alias("name"))
    return {
        "programs": p.select(F.col("p.id").alias("program_id"), "ord", "p.role", "p.ingredient", "p.developer", F.coalesce("p.holdout", F.lit(False)).alias("holdout")),
        "names": own.unionByName(by_agency).distinct(),
        "glossary": whole.select(F.explode("glossary").alias("term", "to")),
        "guidances": whole.select(F.explode("guidances").alias("g")).select("g.*"),
    }


def parsed_documents(spark: SparkSession, path: str) -> DataFrame:
    """Stored parses, one JSON document a file; the schema is given, so no file is read to find it and unknown fields are left out."""
    return spark.read.schema(PARSED).json(path, multiLine=True)


def parsed_blocks(documents: DataFrame) -> DataFrame:
    """Blocks in reading order: document_id, sha256, agency, doc_type, program_id, engine, pos and the block's fields."""
    return documents.select("document_id", "sha256", "agency", "doc_type", "program_id", "engine", F.posexplode("blocks").alias("pos", "b")).select("document_id", "sha256", "agency", "doc_type", "program_id", "engine", "pos", "b.*")


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """(id): whole numbers of a text file, divided by white space, each once."""
    return spark.read.text(path).select(F.explode(F.split(F.trim("value"), r"\s+")).alias("_v")).filter("_v != ''").select(F.col("_v").cast("long").alias("id")).distinct()


def write_positional(df: DataFrame, path: str, sides: dict[str, list[str]], order: list[str], rows: int = 100_000) -> None:
    """Writes groups of columns as files of their own that belong together by row position, and a manifest with the rows of each part.

    Every part is one file per side, in the same order; the order is made once, and parts are ranges of it."""
    from lodestone.operators.shared import removed, written

    n = df.count()
    parts = max(1, -(-n // rows))
    once = written(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id()))
    for side, columns in sides.items():
        # One task per part: its rows go out in order, into one file.
        once.repartition(parts, "part").sortWithinPartitions("part", "_i").select("part", *columns).write.option("maxRecordsPerFile", 0).partitionBy("part").parquet(f"{path}/{side}")
    counts = {str(r["part"]): r["n"] for r in once.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per part
    removed(once)
    Folder(df.sparkSession, path).create("manifest.json", json.dumps({"sides": list(sides), "parts": counts, "rows": n}, sort_keys=True))


def positions(spark: SparkSession, path: str, side: str) -> DataFrame:
    """A side's rows with part and place (its row number in the part's file)."""
    df = spark.read.parquet(f"{path}/{side}")
    return df.select(*df.columns, F.col("_metadata.row_index").alias("place"))


def read_positional(spark: SparkSession, path: str) -> DataFrame:
    """The sides joined by part and row position. Refused if a side's part has other rows than the manifest says, more than one file, or is missing."""
    manifest = json.loads(Folder(spark, path).get("manifest.json") or "{}")
    if not manifest:
        raise ValueError(f"{path} has no manifest")
    out, want = None, {int(k): n for k, n in manifest["parts"].items()}
    for side in manifest["sides"]:
        df = positions(spark, path, side)
        counts = df.withColumn("_f", F.input_file_name()).groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("_f").alias("files")).collect()  # a row per part
        have = {r["part"]: r["n"] for r in counts}
        wrong = sorted(k for k in have.keys() | want.keys() if have.get(k, 0) != want.get(k, 0)) + [r["part"] for r in counts if r["files"] > 1]
        if wrong:
            raise ValueError(f"{side}: rows of part {wrong[0]} do not fit the manifest ({have.get(wrong[0], 0)} for {want.get(wrong[0], 0)})")
        out = df if out is None else out.join(df, ["part", "place"])
    return out


def renumbered(df: DataFrame, by: list[str], name: str) -> DataFrame:
    """Numbers rows from 1 in the given order without one global window: counts per range partition, then numbers inside each."""
    from lodestone.operators.shared import written

    once = written(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id()))
    sizes = once.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"), F.min("_i").alias("_first"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))  # a row per partition
    return once.join(before, "_p").withColumn(name, F.col("_before") + F.col("_i") - F.col("_first") + 1).drop("_p", "_i", "_n", "_first", "_before")
