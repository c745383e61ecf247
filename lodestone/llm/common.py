"""Shared parts of the training-data operators: words, hashes, shared-folder tables, sized joins.

Word definition everywhere: maximal runs of ``[^\\x20\\x09-\\x0D]``. ``bytes.split()`` cuts at exactly
those six bytes, so Python code works on UTF-8 bytes and never needs a regular expression.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
NON_SPACE = r"[^\x20\x09-\x0D]"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
NULL_ID = -(2**63)  # stands for a null doc_id inside numpy code


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only in local mode (tests). A cluster must name one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="lodestone-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: write to the shared folder as Parquet and read it back. Survives lost executors.

    The written table makes the shuffle files of its query useless, so Spark is told to delete them at the query's end;
    by default they stay until the driver's JVM collects what refers to them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lodestone/{uuid.uuid4().hex}"
    if spark.conf.get(CLEANUP, "false") != "true":
        spark.conf.set(CLEANUP, "true")  # once for the session
    df.write.option("compression", "zstd").parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found.cut_path = path
    return found


def discard(*frames: DataFrame) -> None:
    """Deletes tables of `cut` that nothing reads any more: call it only after what depends on them has been cut itself."""
    for df in frames:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.cut_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def sized_join(big: DataFrame, small: DataFrame, on: list[str], how: str, bound: int = 200_000) -> DataFrame:
    """Join with a broadcast only if a count proves the small side within bound rows; otherwise Spark shuffles (AQE splits skew)."""
    n = small.limit(bound + 1).count()
    return big.join(F.broadcast(small) if n <= bound else small, on, how)


def skew_join(big: DataFrame, small: DataFrame, on: list[str], how: str, most: int = 4096, bound: int = 200_000, hot: DataFrame | None = None) -> DataFrame:
    """Join of a big table, read more than once (so a table of `cut`), with one whose keys are unique, where few keys may hold most rows.

    The keys with more than `most` rows are at most |big| / most; their rows of small are broadcast if a count proves them to be within
    `bound`, so a hot key meets its partner where its rows lie. All other keys are shuffled. No row is dropped on either way.
    `hot` may bring these keys where they are known already.
    """
    hot = hot.select(*on, F.lit(True).alias("_hot")) if hot is not None else cut(big.groupBy(*on).agg(F.count(F.lit(1)).alias("_c")).filter(F.col("_c") > most).select(*on, F.lit(True).alias("_hot")))
    n = hot.limit(bound + 1).count()
    if not n or n > bound:
        return big.join(small, on, how)
    marked = big.join(F.broadcast(hot), on, "left")
    few = small.join(F.broadcast(hot), on, "left_semi")
    met = marked.filter("_hot").drop("_hot").join(F.broadcast(few), on, how)
    return met.unionByName(marked.filter("_hot IS NULL").drop("_hot").join(small, on, how))


def parts_for(total: float, each: float) -> int:
    """How many parts of about `each` hold `total`; there is no upper bound, so a part never grows with the input."""
    return int(max(1, -(-int(total) // int(each))))


class WordIds(dict):
    """Word bytes to dense local ids, with a 64-bit hash per id; cleared when it outgrows its bound."""

    def __init__(self, seed: int = 0, bound: int = 600_000):
        self.seed, self.bound, self.hashes = seed, bound, []

    def __missing__(self, word: bytes) -> int:
        self[word] = i = len(self.hashes)
        self.hashes.append(xxhash.xxh3_64_intdigest(word, self.seed))
        return i

    def trim(self) -> None:
        if len(self) > self.bound:
            self.clear()
            self.hashes.clear()

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def table(self) -> np.ndarray:
        return np.array(self.hashes, np.uint64)


LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
BLANK = np.isin(np.arange(256), [32, *range(9, 14)])
FACTOR = 0x9E3779B97F4A7C15
PIECE = 1 << 20


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd factor and of its inverse, modulo 2^64."""
    return tuple(np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size, f, np.uint64)])) for f in (FACTOR, pow(FACTOR, -1, 1 << 64)))


@cache
def _byte_values() -> np.ndarray:
    """A number per byte after lower-casing; 0 for space."""
    return np.where(BLANK, np.uint64(0), mix(LOWER.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03) + np.uint64(1)))


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all lower-cased words in order, and the number of words of each text, without an object per word."""
    sizes = np.fromiter((len(t) if t else 0 for t in texts), np.int64, len(texts)) + 1
    raw = np.frombuffer(b"\n".join([t or b"" for t in texts]) + b"\n", np.uint8)
    blank = BLANK[raw]
    starts = np.nonzero(~blank & np.concatenate([[True], blank[:-1]]))[0]
    del blank
    counts = np.diff(np.searchsorted(starts, np.cumsum(sizes)), prepend=0)
    out, at, values = np.zeros(len(starts), np.uint64), 0, _byte_values()
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(starts, starts[at] + PIECE)))
        a, b = int(starts[at]), int(starts[stop]) if stop < len(starts) else len(raw)
        up, down = _powers(max(PIECE, 1 << (b - a).bit_length())) if b - a > PIECE else _powers(PIECE)
        own = starts[at:stop] - a
        out[at:stop] = np.add.reduceat(values[raw[a:b]] * up[: b - a], own) * down[own]
        at = stop
    return mix(out), counts


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def as_long(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def chunks(batches, names: list[str], most: int):
    """Arrow batches to lists of rows' columns, of about `most` bytes of the last column each; strings come as UTF-8 bytes, null as None."""
    import pyarrow as pa

    for batch in batches:
        cols = []
        for n in names:
            c = batch.column(batch.schema.get_field_index(n))
            cols.append((c.cast(pa.binary()) if pa.types.is_string(c.type) or pa.types.is_large_string(c.type) else c))
        n, start = batch.num_rows, 0
        last = cols[-1]
        sizes = _lengths(last)
        ends = np.cumsum(sizes)
        while start < n:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most, "right")))
            yield [c.slice(start, stop - start).to_pylist() for c in cols]
            start = stop


def _lengths(column) -> np.ndarray:
    import pyarrow.compute as pc

    return np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)


@cache
def _zstd(level: int):
    """One compressor or (level 0) decompressor per worker: making them costs more than a small blob."""
    import zstandard

    return zstandard.ZstdCompressor(level=level) if level else zstandard.ZstdDecompressor()


def pack(array: np.ndarray, level: int = 3) -> bytes:
    """zstd over byte planes: the high bytes of small numbers stand together."""
    raw = np.ascontiguousarray(array)
    planes = raw.view(np.uint8).reshape(-1, raw.itemsize).T if raw.itemsize > 1 else raw
    return _zstd(level).compress(np.ascontiguousarray(planes).tobytes())


def unpack(blob: bytes, kind) -> np.ndarray:
    raw, width = np.frombuffer(_zstd(0).decompress(blob), np.uint8), np.dtype(kind).itemsize
    if not len(raw):
        return np.zeros(0, kind)
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(kind).ravel() if width > 1 else raw.view(kind)


def release() -> None:
    """Gives memory that a worker no longer needs back to the system; workers live on between tasks."""
    import ctypes
    import gc

    gc.collect()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)
