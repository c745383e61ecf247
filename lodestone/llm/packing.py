"""Packing: first-fit decreasing over a tournament tree of bin capacities, in randomised groups of documents.

Each document's ids (and a final id) are cut into full sequences and one rest; the rests of a group are packed
first-fit decreasing. A group is a seeded hash bucket of about `group_docs` documents, so its size does not grow
with the corpus (documents without an id are dealt by their text), and a lost task packs the same group again with the same result.
Keys that more than `group_docs` rows share would fill one group; their rows are stored with a number each and dealt by that too.

Defined cases: null text packs as the final id alone; a repeated row is packed again as a document of its own, however often it comes;
ties go by doc_id, then by input order; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, cut, parts_for, sized_join, table
from .tokens import default_path, worker_cache

SEQUENCE, FINAL_ID, GROUP_DOCS, SEED = 2048, 1, 512, 11


class BinTree:
    """Tournament tree over bins in opening order: each node holds the most free room below it, so the first bin with room is found in log steps."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(0, (bins - 1).bit_length())
        self.most = [room] * (2 * self.leaves)

    def place(self, size: int) -> int:
        most, i = self.most, 1
        while i < self.leaves:
            i *= 2
            if most[i] < size:
                i += 1
        most[i] -= size
        place = i - self.leaves
        while i > 1:
            i //= 2
            most[i] = max(most[2 * i], most[2 * i + 1])
        return place


def plan(lengths: list[int], room: int = SEQUENCE) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece; sequences are numbered from 0."""
    out, rests, full = [], [], 0
    for d, n in enumerate(lengths):
        whole = n // room
        out += [(d, k * room, room, full + k, 0) for k in range(whole)]
        full += whole
        if n % room:
            rests.append((-(n % room), d))
    rests.sort()
    tree, used = BinTree(len(rests), room), {}
    for size, d in rests:
        b = tree.place(-size)
        out.append((d, lengths[d] + size, -size, full + b, used.get(b, 0)))
        used[b] = used.get(b, 0) - size
    return out


def dealt(docs: DataFrame, groups: int, group_docs: int, seed: int) -> DataFrame:
    """(g, doc_id, text): each row with its group; rows of an id that would overfill one group are spread over all. Ids are counted without reading a text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    by_key = F.pmod(F.xxhash64(F.lit(seed), "doc_id", F.when(F.col("doc_id").isNull(), F.col("text"))), F.lit(groups)).alias("g")
    hot = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > group_docs).select(F.struct("doc_id").alias("_id"))
    if groups == 1 or hot.isEmpty():
        return rows.select(by_key, "doc_id", "text")
    hot, keyed = cut(hot), rows.withColumn("_id", F.struct("doc_id"))
    many = cut(sized_join(keyed, hot, ["_id"], "left_semi").withColumn("_i", F.monotonically_increasing_id()))  # numbered once, in a table
    few = sized_join(keyed, hot, ["_id"], "left_anti").select(by_key, "doc_id", "text")
    return few.unionByName(many.select(F.pmod(F.xxhash64(F.lit(seed), "doc_id", "_i"), F.lit(groups)).alias("g"), "doc_id", "text"))


def tokenised(docs: DataFrame, path: str, groups: int, group_docs: int = GROUP_DOCS, seed: int = SEED, final_id: int = FINAL_ID) -> DataFrame:
    """(g, doc_id, ids): ids are little-endian unsigned 16-bit where the vocabulary allows, else 32-bit."""

    def run(batches):
        import pyarrow as pa

        cache = worker_cache(path)
        kind = cache.kind
        for g, ids, texts in chunks(batches, ["g", "doc_id", "text"], 4 << 20):
            flat, n = cache.encode(texts)
            ends = np.cumsum(n)
            own = np.insert(flat, ends, final_id).astype(kind)
            ends = ends + np.arange(1, len(n) + 1)
            raw, w = own.tobytes(), own.itemsize
            blobs = [raw[a * w : b * w] for a, b in zip(ends - n - 1, ends)]
            yield pa.RecordBatch.from_arrays([pa.array(g, pa.int64()), pa.array(ids, pa.int64()), pa.array(blobs, pa.binary()), pa.array([w] * len(g), pa.int32())], ["g", "doc_id", "ids", "width"])

    return dealt(docs, groups, group_docs, seed).mapInArrow(run, "g long, doc_id long, ids binary, width int")


def pack(docs: DataFrame, tokenizer: str | None = None, room: int = SEQUENCE, group_docs: int = GROUP_DOCS, seed: int = SEED, final_id: int = FINAL_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, token_ids (32-bit little-endian), doc_tokens, sequence_id, offset."""
    path = tokenizer or default_path()
    groups = parts_for(docs.select("doc_id").count(), group_docs)
    schema = "doc_id long, start long, length long, token_ids binary, doc_tokens long, sequence_id long, offset long"

    def run(key, pdf):
        import pandas as pd

        pdf = pdf.sort_values("doc_id", kind="stable")
        ids = [np.frombuffer(b, np.uint16 if w == 2 else np.uint32).astype("<u4") for b, w in zip(pdf["ids"], pdf["width"])]
        names = pdf["doc_id"].astype("Int64").tolist()
        base = int(key[0]) << 32
        rows = [(names[d], start, n, ids[d][start : start + n].tobytes(), len(ids[d]), base + s, at) for d, start, n, s, at in plan([len(x) for x in ids], room)]
        out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "token_ids", "doc_tokens", "sequence_id", "offset"])
        return out.astype({"doc_id": "Int64"})

    # A partition holds about a dozen groups, whatever the session's number of shuffle partitions and the size of the corpus.
    return tokenised(docs, path, groups, group_docs, seed, final_id).repartition(parts_for(groups, 12), "g").groupBy("g").applyInPandas(run, schema)


def op2_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "start", "length", F.crc32("token_ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
