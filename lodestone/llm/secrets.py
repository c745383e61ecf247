"""Secret scans with corpus-wide ownership frequency.

Base spans are the three fixed patterns and always stay. Candidates are values that look like keys: the values of base spans (of an assignment
its right side) and further runs of 20 and more characters of [A-Za-z0-9+/_=-] outside them. Each has `least` characters at least, spread
nearly as evenly as in a random string of that length over the least of the usual key alphabets that holds them. Every candidate's hash is counted
over the distinct repositories (texts: copies of one text count once) and owners (sources, a copied text being its least source's) that
hold it in the whole corpus. What more than `repositories` repositories and more than `owners` owners hold is a widely copied example and
keeps its base span alone; any other candidate is a live-looking credential of its owner, and its value gets an added span of kind `owned`.
One owner's value stays live however often that owner repeats it.

Counting goes through (hash, text) and (hash, owner) first, so a value that a third of all documents hold is summed map-side; where verdicts
travel back, hashes with very many places are hot keys of `skew_join` and never meet in one task.

Defined cases: null text is empty; a null source is an owner of its own, the least; rows repeated with doc_id are counted as one
repository and each is returned; ties in start go by kind (assign, access, hex, owned); values of any length are judged by all
their characters and known by the hash of the whole; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from functools import cache
from math import exp, lgamma, log, log2, sqrt

import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, cut, skew_join, table

# Fixed patterns.
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_LONG = re.compile(r"[0-9a-f]{24,}")  # maximal runs, so the same matches as HEX of 24 and more
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
KINDS = ("assign", "access", "hex", "owned")
REPOSITORIES, OWNERS = 9, 2  # an example stands in ten texts of three owners at least
LEAST = 16  # characters of a candidate
ALPHABETS = [(re.compile(p), k) for p, k in (("[0-9]+", 10), ("[0-9a-f]+|[0-9A-F]+", 16), ("[a-z]+|[A-Z]+", 26), ("[0-9a-z]+|[0-9A-Z]+", 36), ("[A-Za-z]+", 52), ("[0-9A-Za-z]+", 62), (".+", 64))]
EVEN = 0.9  # least share of a random string's expected entropy


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind index, end, start of the value) by start, then kind; a value ends where its span does."""
    found = [(m.start(), 0, m.end(), m.start(1)) for m in ASSIGN.finditer(text) if m.end() - m.start(1) >= 6]
    found += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end(), m.start()) for m in HEX_LONG.finditer(text)]
    return sorted(found)


def candidates(text: str, base: list[tuple[int, int, int, int]], least: int = LEAST) -> list[tuple[int, int]]:
    """(start, end) of the values that look like keys, each place once."""
    values = {(v, e) for _, _, e, v in base}
    # Both lists go by their starts: a run lies in a base span if one that starts before it reaches its end.
    at, reach = 0, 0
    for m in RUN.finditer(text):
        while at < len(base) and base[at][0] <= m.start():
            reach = max(reach, base[at][2])
            at += 1
        if reach < m.end():
            values.add(m.span())
    return sorted((a, e) for a, e in values if e - a >= least and credential_like(text[a:e]))


@cache
def random_entropy(n: int, k: int) -> float:
    """Expected entropy, in bits a character, of n random characters of an alphabet of k. Counts left out are as likely as 1 in 10^25 together."""
    mean, most = n / k, 12 * sqrt(n / k * (1 - 1 / k)) + 40
    counts = range(max(1, int(mean - most)), min(n, int(mean + most)) + 1)
    chance = [exp(lgamma(n + 1) - lgamma(c + 1) - lgamma(n - c + 1) + c * log(1 / k) + (n - c) * log(1 - 1 / k)) for c in counts]
    return log2(n) - k / n * sum(p * c * log2(c) for c, p in zip(counts, chance))


def credential_like(value: str) -> bool:
    """Whether the run's characters, all of them, are as even as those of a key; padding aside."""
    key = value.rstrip("=")
    if len(key) < 2:
        return False
    size = next(k for p, k in ALPHABETS if p.fullmatch(key))
    entropy = log2(len(key)) - sum(c * log2(c) for c in Counter(key).values()) / len(key)
    return entropy >= EVEN * random_entropy(len(key), size)


def scanned(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, source, counts, base digest, base spans and candidates."""

    def run(batches):
        import pyarrow as pa

        places = pa.list_(pa.struct([("at", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
        cand = pa.list_(pa.struct([("at", pa.int64()), ("end", pa.int64()), ("hash", pa.int64())]))
        for ids, sources, texts in chunks(batches, ["doc_id", "source", "text"], 8 << 20):
            rows = []
            for i, source, raw in zip(ids, sources, texts):
                text = (raw or b"").decode()
                base = base_spans(text)
                digest = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in base)
                values = [{"at": s, "end": e, "hash": xxhash.xxh3_64_intdigest(text[s:e].encode()) - 2**63} for s, e in candidates(text, base)]
                rows.append((i, source.decode() if source is not None else None, *(sum(k == x for _, k, _, _ in base) for x in range(3)), hashlib.sha256(digest.encode()).hexdigest(), [{"at": s, "kind": k, "end": e} for s, k, e, _ in base], values, xxhash.xxh3_64_intdigest(raw or b"") - 2**63))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), places, cand, pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], ["doc_id", "source", "n_assign", "n_access", "n_hex", "base_sha256", "base", "candidates", "text_hash"])

    schema = "doc_id long, source string, n_assign long, n_access long, n_hex long, base_sha256 string, base array<struct<at:long,kind:int,end:long>>, candidates array<struct<at:long,end:long,hash:long>>, text_hash long"
    return docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string")).mapInArrow(run, schema)


def ownership(found: DataFrame) -> DataFrame:
    """(hash, n_repositories, n_owners) of every candidate value in the corpus."""
    each = found.select("text_hash", F.struct("source").alias("_owner"), F.explode(F.array_distinct(F.transform("candidates", lambda c: c["hash"]))).alias("hash"))
    by_text = each.groupBy("hash", "text_hash").agg(F.min("_owner").alias("_owner"))
    by_owner = by_text.groupBy("hash", "_owner").agg(F.count(F.lit(1)).alias("_n"))
    return by_owner.groupBy("hash").agg(F.sum("_n").alias("n_repositories"), F.count(F.lit(1)).alias("n_owners"))


def find_secrets(docs: DataFrame, repositories: int = REPOSITORIES, owners: int = OWNERS) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example, details (place, ownership and verdict of each candidate)."""
    found = cut(scanned(docs).withColumn("_row", F.monotonically_increasing_id()))
    each = cut(found.select("_row", F.explode("candidates").alias("c")).select("_row", F.col("c.at").alias("at"), F.col("c.end").alias("end"), F.col("c.hash").alias("hash")))
    live = (F.col("n_repositories") <= repositories) | (F.col("n_owners") <= owners)
    known = cut(ownership(found).withColumn("live", live))
    held = skew_join(each, known, ["hash"], "inner").groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("at", "end", "n_repositories", "n_owners", "live"))).alias("details"))
    none = F.array().cast("array<struct<at:long,end:long,n_repositories:long,n_owners:long,live:boolean>>")
    out = found.drop("candidates", "text_hash").join(held, "_row", "left").withColumn("details", F.coalesce("details", none))
    owned = F.transform(F.filter("details", lambda d: d["live"]), lambda d: F.struct(d["at"].alias("at"), F.lit(3).alias("kind"), d["end"].alias("end")))
    shown = F.array_sort(F.concat(F.col("base"), owned))
    spans = F.array_join(F.transform(shown, lambda d: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), d["kind"] + 1), d["at"], d["end"])), ",")
    n_live = F.size(owned).cast("long")
    return out.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", spans.alias("spans"), n_live.alias("n_live"), (F.size("details") - n_live).cast("long").alias("n_example"), "details")


def op6_find_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents")).drop("details")
