"""Seams for models: parsers, embedders and rerankers as column-producing functions, with deterministic stand-ins.

Models are not part of this library. Each seam takes a plain Python object that is made once per worker by `make`, gets batches of
distinct inputs and returns one output each; equal texts are computed once, by hash, before the join back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.operators.shared import written
from lodestone.sources.stored import StoredTable


class HashEmbedder:
    """Stand-in: token hashes folded into a small vector, and a weight per token."""

    def __init__(self, width: int = 16):
        self.width = width

    def encode(self, texts: list[str]) -> list[tuple[list[float], dict[int, float]]]:
        out = []
        for t in texts:
            dense, sparse = [0.0] * self.width, {}
            for w in t.lower().split():
                h = int.from_bytes(hashlib.sha1(w.encode()).digest()[:4], "little")
                dense[h % self.width] += 1.0
                sparse[h % (1 << 20)] = max(sparse.get(h % (1 << 20), 0.0), 1.0)
            norm = sum(x * x for x in dense) ** 0.5 or 1.0
            out.append(([x / norm for x in dense], sparse))
        return out


class OverlapScorer:
    """Stand-in: share of the query's words that a passage holds."""

    def score(self, pairs: list[tuple[str, str]]) -> list[float]:
        found = []
        for q, p in pairs:
            words = set(q.lower().split())
            found.append(len(words & set(p.lower().split())) / len(words) if words else 0.0)
        return found


BATCH_TOKENS, LONGEST, PASSAGES = 8192, 1024, 8  # padded tokens a batch may hold, tokens a model reads of a text at most, passages scored at once


def padded_batches(lengths: list[int], most: int = BATCH_TOKENS) -> list[slice]:
    """Neighbouring texts as batches whose padded size (longest times number) stays within `most`; a text that is larger alone is a batch of its own."""
    out, start, longest = [], 0, 0
    for i, n in enumerate(lengths):
        longest = max(longest, n)
        if i > start and longest * (i - start + 1) > most:
            out.append(slice(start, i))
            start, longest = i, n
    if start < len(lengths):
        out.append(slice(start, len(lengths)))
    return out


def text_tokens(text: str, longest: int = LONGEST) -> int:
    """Estimate of a text's tokens as a model reads it."""
    return min(longest, len(text) // 3 + 8)


def embedded(texts: DataFrame, make: Callable[[], object] = HashEmbedder, most: int = BATCH_TOKENS) -> DataFrame:
    """(embed_hash, dense, sparse) of the distinct values of `text`; the heaviest weight of a token counts, others than positive ones go.

    Texts are ordered by length within their partition, so batches hold texts of like length, and cut by padded cost: no model call exceeds `most`."""
    once = texts.filter("text IS NOT NULL").groupBy(F.sha1("text").alias("embed_hash")).agg(F.min("text").alias("text"))
    by_length = once.withColumn("_n", F.length("text")).sortWithinPartitions("_n", "embed_hash")

    def run(batches: Iterable):
        import pandas as pd

        model = make()
        for pdf in batches:
            own = list(pdf["text"])
            for part in padded_batches([text_tokens(t) for t in own], most):
                got = model.encode(own[part])
                yield pd.DataFrame({"embed_hash": pdf["embed_hash"].iloc[part], "dense": [d for d, _ in got], "sparse": [{k: w for k, w in s.items() if w > 0} for _, s in got]})

    return by_length.select("embed_hash", "text").mapInPandas(run, "embed_hash string, dense array<float>, sparse map<int,double>")


def pair_hash() -> Column:
    return F.sha2(F.to_json(F.struct("query", "passage")), 256)


def scored_pairs(pairs: DataFrame, make: Callable[[], object] = OverlapScorer, passages: int = PASSAGES) -> DataFrame:
    """pairs (search, chunk_id, query, passage) with `score`; each distinct pair of texts is scored once."""
    marked = pairs.withColumn("_h", pair_hash())
    return marked.join(_scored(marked, make, passages), "_h").select("search", "chunk_id", "score")


def _scored(marked: DataFrame, make: Callable[[], object], passages: int) -> DataFrame:
    """(_h, score) of the distinct pairs, those of a query together and in batches of `passages`."""

    def run(batches: Iterable):
        import pandas as pd

        model = make()
        for pdf in batches:
            own = list(zip(pdf["query"], pdf["passage"]))
            scores = [x for k in range(0, len(own), passages) for x in model.score(own[k : k + passages])]
            yield pd.DataFrame({"_h": pdf["_h"], "score": scores})

    once = marked.groupBy("_h").agg(F.min(F.struct("query", "passage")).alias("p")).select("_h", "p.query", "p.passage")
    return once.sortWithinPartitions("query", F.length("passage")).mapInPandas(run, "_h string, score double")


SCORES = "pair string, score double"


def scored_with_cache(pairs: DataFrame, cache: StoredTable, batch: str, make: Callable[[], object] = OverlapScorer, passages: int = PASSAGES) -> DataFrame:
    """As scored_pairs, but pairs that the stored table (schema SCORES) holds are not scored again; new scores enter it as one batch. `batch` names this run's."""
    marked = pairs.withColumn("_h", pair_hash())
    known = cache.read().select(F.col("pair").alias("_h"), "score")
    new = written(_scored(marked.join(known, "_h", "left_anti"), make, passages))
    if not new.isEmpty():
        cache.commit(batch, lambda old: old.unionByName(new.select(F.col("_h").alias("pair"), "score").join(old, "pair", "left_anti")))
    return marked.join(known.unionByName(new), "_h").select("search", "chunk_id", "score")


def parsed(files: DataFrame, make: Callable[[], object]) -> DataFrame:
    """Blocks of binary files (path, content) by a parser with blocks(content) -> list of (label, level, page, text). Pages of a file stay together."""

    def run(batches: Iterable):
        import pandas as pd

        parser = make()
        for pdf in batches:
            rows = [(path, i, *b) for path, content in zip(pdf["path"], pdf["content"]) for i, b in enumerate(parser.blocks(content))]
            yield pd.DataFrame(rows, columns=["path", "pos", "label", "level", "page", "text"]).astype({"level": "Int32", "page": "Int32"})

    return files.select("path", "content").mapInPandas(run, "path string, pos long, label string, level int, page int, text string")


def parsed_runs(files: DataFrame, runs: DataFrame, make: Callable[[], object]) -> DataFrame:
    """Blocks of files page run by page run: (path, run, pos, label, level, page, text), pos counting through the run.

    files: path, content; runs (structure.page_runs with doc as path): path, run, mode, first, last; the parser has pages(content, first, last, mode) -> list of (label, level, page, text).
    A run is one call, so a file's runs are parsed side by side and each in its own mode; blank pages (mode skip) are not parsed."""

    def run(batches: Iterable):
        import pandas as pd

        parser = make()
        for pdf in batches:
            rows = [(r.path, r.run, i, *b) for r in pdf.itertuples(index=False) for i, b in enumerate(parser.pages(r.content, r.first, r.last, r.mode))]
            yield pd.DataFrame(rows, columns=["path", "run", "pos", "label", "level", "page", "text"]).astype({"level": "Int32", "page": "Int32"})

    met = runs.filter("mode != 'skip'").select("path", "run", "mode", "first", "last").join(files.select("path", "content"), "path")
    return met.mapInPandas(run, "path string, run long, pos long, label string, level int, page int, text string")
