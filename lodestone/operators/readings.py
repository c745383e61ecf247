"""Several readings of one block: which are usable, which is best, whether a person must look; and which blocks to read again.

A reading is a row (block, ord, text): ord 0 is the first reader's, 1 the second's, 2 and on are rereads of the block alone. All signals of a reading are columns; only
the language model's mean and the likeness of two texts run in Arrow batches, the latter only where two readings differ.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import text as X
from lodestone.functions.alignment import likeness
from lodestone.operators import trigrams

ALIKE, SHORTEST, LONGEST = 0.95, 0.8, 1.25  # fixed values
SCALES = [4.0, 2.0, 5.0, 2.5]  # fixed values: how large a block is read again, in order


def alike(a: Column, b: Column, share: float = ALIKE) -> Column:
    """Whether two texts have a likeness of `share`; lengths that cannot reach it are settled without Python."""

    @F.pandas_udf("boolean")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None else likeness(p, q) >= share for p, q in zip(x, y)], dtype=object)

    far = 2 * F.least(F.length(a), F.length(b)) < share * (F.length(a) + F.length(b))
    open_ = ~far & (a != b)
    return F.when(a == b, True).when(far, False).otherwise(run(F.when(open_, a), F.when(open_, b)))


def mean_log(text: Column, logs: np.ndarray) -> Column:
    """Mean log probability under a trigram model; 0 without a trigram."""

    @F.pandas_udf("double")
    def run(values: pd.Series) -> pd.Series:
        return pd.Series([float(logs[c].mean()) if len(c := trigrams.codes(v)) else 0.0 for v in values])

    return run(trigrams.letters(text))


def judged(readings: DataFrame, logs: np.ndarray) -> DataFrame:
    """readings with what they are judged by: plain (without space), nums, broken, odd (bad words), lm."""
    words = F.filter(X.judged_words(F.col("text")), X.bad_word)
    t = readings.withColumn("text", F.coalesce("text", F.lit("")))
    return t.select("*", F.regexp_replace("text", r"(?U)\s+", "").alias("plain"), F.regexp_extract_all("text", F.lit(r"(\d+(?:[.,]\d+)?)")).alias("nums"), (X.garbled_window(F.col("text")) | X.ocr_gaps(F.col("text"))).alias("broken"), F.size(words).alias("odd"), mean_log(F.col("text"), logs).alias("lm"))


def doubted(readings: DataFrame, logs: np.ndarray) -> DataFrame:
    """(block, first, second, doubt, again): doubt is whether a block's first reading is open to question, again whether it is broken and so read once more. Structs hold the columns of `judged`."""
    row = F.struct("text", "plain", "nums", "broken", "odd", "lm")
    of = lambda n: F.min_by(F.when(F.col("ord") == n, row), F.when(F.col("ord") == n, F.col("text")))
    both = judged(readings.filter("ord < 2"), logs).groupBy("block").agg(of(0).alias("first"), of(1).alias("second"))
    a, b = F.col("first"), F.col("second")
    some = F.coalesce(b["plain"] != "", F.lit(False))
    comparable = F.length(b["plain"]).between(SHORTEST * F.length(a["plain"]), LONGEST * F.length(a["plain"]))
    same = F.coalesce(a["plain"] == b["plain"], a["plain"] == "")
    # The likeness is taken of pairs that differ only: others bring two empty texts.
    asked = both.withColumn("_x", F.when(some & ~same, a["plain"]).otherwise("")).withColumn("_y", F.when(some & ~same, b["plain"]).otherwise(""))
    open_ = a["broken"] | (some & ~alike(F.col("_x"), F.col("_y"))) | F.coalesce(some & comparable & (a["nums"] != b["nums"]), F.lit(False))
    return asked.select("block", "first", "second", (~same & open_).alias("doubt"), (~same & a["broken"]).alias("again"))


def requests(doubts: DataFrame, scales: list[float] = SCALES) -> DataFrame:
    """(block, ord, scale): what the reader is asked for again: broken blocks, once at each scale."""
    every = F.array(*[F.struct(F.lit(k + 2).alias("ord"), F.lit(s).alias("scale")) for k, s in enumerate(scales)])
    return doubts.filter("again").select("block", F.explode(every).alias("e")).select("block", "e.ord", "e.scale")


def reread(asked: DataFrame, make: Callable[[], object]) -> DataFrame:
    """(block, ord, text) from a reader with read(block, scale) -> text or None, made once per worker."""
    kind = dict(asked.dtypes)["block"]

    def run(batches: Iterable):
        reader = make()
        for pdf in batches:
            yield pdf[["block", "ord"]].assign(text=[reader.read(b, s) for b, s in zip(pdf["block"], pdf["scale"])])

    return asked.select("block", "ord", "scale").mapInPandas(run, f"block {kind}, ord int, text string")


def voted(readings: DataFrame, logs: np.ndarray, make: Callable[[], object] | None = None) -> DataFrame:
    """(block, text, ord, status): the best reading of each block and kept, reread or needs_review.

    A block in no doubt keeps its first reading. Else, of the usable readings (the first, and others of at least SHORTEST of its length), the best is the least by
    (broken, odd words, -lm, ord); a broken best, or numbers that differ among usable readings while the first is kept, need a person."""
    doubts = doubted(readings, logs)
    rows = lambda n, c: F.struct(F.lit(n).alias("ord"), *[F.col(f"{c}.{x}").alias(x) for x in ("text", "plain", "nums", "broken", "odd", "lm")])
    own = doubts.select("block", "doubt", "again", F.explode(F.array_compact(F.array(rows(0, "first"), F.when(F.col("second").isNotNull(), rows(1, "second"))))).alias("r")).select("block", "doubt", "again", "r.*")
    more = readings.filter("ord > 1")
    if make is not None:
        more = more.unionByName(reread(requests(doubts), make))
    extra = judged(more, logs).join(doubts.select("block", "doubt", "again"), "block").filter("again").select(*own.columns)
    every = own.unionByName(extra)
    length = F.length("plain")
    first_length = F.max(F.when(F.col("ord") == 0, F.length("plain")))
    sized = every.join(every.groupBy("block").agg(first_length.alias("_n")), "block")
    usable = sized.filter((F.col("ord") == 0) | (F.col("doubt") & (F.col("plain") != "") & (length >= SHORTEST * F.col("_n"))))
    rank = F.struct("broken", "odd", -F.col("lm"), "ord")
    best = usable.groupBy("block").agg(F.min_by(F.struct("text", "ord", "broken"), rank).alias("b"), F.count_distinct("nums").alias("_k"), F.bool_or("doubt").alias("doubt"))
    kept = F.col("b.ord") == 0
    status = F.when(~F.col("doubt"), "kept").when(F.col("b.broken") | ((F.col("_k") > 1) & kept), "needs_review").when(kept, "kept").otherwise("reread")
    return best.select("block", F.col("b.text").alias("text"), F.col("b.ord").alias("ord"), status.alias("status"))
