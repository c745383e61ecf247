"""The corpus pipeline: quality rules, line dedup, MinHash near-dedup, mixing to target weights, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lodestone.llm import line_dedup, mixing, near_dup, packing, quality
from lodestone.llm.common import shared_dir

NEAR_PERCENT = 80  # the stage links at a Jaccard of 0.8; op10's 85 binds that query only


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the outlier verdict reject go.

    Null and empty texts have no words and go; very long texts are judged whole; a null lang or source is a group of its own; repeated rows are judged alike and stay as often as they come."""
    return quality.filtered(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go from the texts; every document stays, if only with the text that is left. n_chars follows the text.

    Null texts stay null; blank lines stay; of tied lines the one of the smallest doc_id, then text hash, then place stays; rows repeated in full are one document, treated alike; a null doc_id comes first."""
    return line_dedup.stripped_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near-duplicates (Jaccard 0.8 and more) stays.

    Texts without words, null or empty, are linked with nothing and stay; whole texts are compared, however long; rows with the doc_id that stays all stay; a null doc_id counts as the smallest."""
    return near_dup.representatives(docs, percent=NEAR_PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the mix takes them.

    Documents without words, null texts too, are not taken; a null source is a source of its own, last in order; rows repeated in full come each as often; ties of seats go by source, then shard."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences with their token ids.

    A null text packs as the final id alone; long texts are cut into full sequences; repeated rows are packed each for itself; ties go by doc_id, then by input order."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources", mix_sources),
    ("packing", pack_sequences),
]

#: Near-duplicate components, tokenizer ids and robust estimates are beyond one SQL statement; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, keep_stages: bool = False) -> DataFrame:
    """The last stage's rows. A stage's table goes once the next is written, unless keep_stages; an empty table gives no rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_dir(spark)}/lodestone/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
        if k and not keep_stages:
            old = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{k - 1}")
            old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
    return docs
