"""Letter-trigram language model: counts, mean log probability and worst window of whole texts.

Texts are lower-cased, runs of other letters become one space, and one space stands at each end. There are 27 symbols, so the
model has 27^3 numbers whatever the corpus; only these reach the driver. Texts are scored by table lookup and running sums.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYMBOLS = 27
SIZE = SYMBOLS**3
WINDOW = 20
HELD = 1 << 18  # trigrams that are counted together


def letters(text: Column) -> Column:
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z]+", " ")), F.lit(" "))


def codes(text: str) -> np.ndarray:
    """One number per trigram."""
    x = np.frombuffer(text.encode("ascii"), np.uint8).astype(np.int64)
    x = np.where(x == 32, 0, x - 96)
    return (x[:-2] * SYMBOLS + x[1:-1]) * SYMBOLS + x[2:]


def counts(docs: DataFrame) -> DataFrame:
    """(code, n): counts of all texts, summed inside each task first."""

    def run(batches):
        import pyarrow as pa

        total, some, held = np.zeros(SIZE, np.int64), [], 0
        for b in batches:
            for s in b.column(0):
                some.append(codes(s.as_py()))
                held += len(some[-1])
                if held > HELD:  # short texts are counted together
                    total += np.bincount(np.concatenate(some), minlength=SIZE)
                    some, held = [], 0
        if some:
            total += np.bincount(np.concatenate(some), minlength=SIZE)
        found = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["code", "n"])

    return docs.select(letters(F.col("text")).alias("s")).mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def log_table(model: DataFrame) -> np.ndarray:
    """Log probability by code: (trigrams + 0.1) / (contexts + 2.7)."""
    n = np.zeros(SIZE)
    for r in model.collect():  # at most 27^3 rows
        n[r.code] = r.n
    return np.log((n + 0.1) / (np.repeat(n.reshape(-1, SYMBOLS).sum(1), SYMBOLS) + 2.7))


def scored(docs: DataFrame, logs: np.ndarray, window: int = WINDOW, keep: list[str] | None = None) -> DataFrame:
    """doc_id, lm_score (mean over trigrams; 0 without any), lm_worst (least mean of `window` in a row; the mean of shorter texts) and the columns to keep."""

    def one(text: str) -> tuple[float, float]:
        lp = logs[codes(text)]
        if not len(lp):
            return 0.0, 0.0
        up = np.concatenate([[0.0], np.cumsum(lp)])
        mean = up[-1] / len(lp)
        return mean, mean if len(lp) < window else (up[window:] - up[:-window]).min() / window

    def run(batches):
        import pyarrow as pa

        for b in batches:
            found = [one(s.as_py()) for s in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in found], pa.float64()), pa.array([y for _, y in found], pa.float64()), *b.columns[2:]], ["doc_id", "lm_score", "lm_worst", *more])

    more, kinds = keep or [], dict(docs.dtypes)
    schema = ", ".join(["doc_id long, lm_score double, lm_worst double", *(f"`{c}` {kinds[c]}" for c in more)])
    return docs.select(F.col("doc_id").cast("long"), letters(F.col("text")).alias("s"), *more).mapInArrow(run, schema)
