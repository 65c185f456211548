"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word rule ``[^\x20\x09-\x0D]+``, as a character class.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_RULE = r"[^\x20\x09-\x0D]+"

#: Odd multiplier of the rolling sums; its powers invert modulo 2**64.
BASE = np.uint64(0x9E3779B97F4A7C15)


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor sees: ``spark.checkpoint.dir`` of the session.

    Where it is unset, a folder already given to ``setCheckpointDir`` serves, and
    on a local master a temporary one is made; any other master must name one.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    folder = spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strata-llm-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts the lineage durably.

    A lost executor costs a re-read of this table, not a recomputation.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of steps whose result is already written.

    Spark's cleaner frees a shuffle once the driver has collected the objects
    that stand for it; without this they stay until the heap happens to fill.
    The first round lets go of the Python side's handles, which reach the JVM
    with the next call; the second collects what they held.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a lambda variable."""
    return F.element_at(F.transform(F.array(value), body), 1)


def is_word_line(line: Column) -> Column:
    return line.rlike(WORD_RULE)


def slices(batch: pa.RecordBatch, columns: list[int], limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of these text columns each, one row at least."""
    sizes = np.zeros(batch.num_rows, np.int64)
    for c in columns:
        sizes += pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy(zero_copy_only=False)
    reach, start = np.cumsum(sizes), 0
    while start < batch.num_rows:
        base = reach[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(reach, base + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def bytes_of(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow string column as UTF-8 bytes, null as empty."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def word_hashes(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts in one array, and each text's start.

    ``bytes.split`` splits on exactly ``\x20`` and ``\x09-\x0D``, ``bytes.lower``
    lowers exactly A-Z.
    """
    digest = xxhash.xxh3_64_intdigest
    parts, starts = [], [0]
    for text in texts:
        words = (text.lower() if lower else text).split()
        parts.append(np.fromiter(map(digest, words), np.uint64, len(words)))
        starts.append(starts[-1] + len(words))
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), np.array(starts, np.int64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Spans:
    """Hashes of any span of a word-hash array, by prefix sums modulo 2**64.

    ``hash(i, j)`` depends on the words i..j-1 and their order only.  Word hashes
    are 64 random bits, so two different spans collide with probability about
    2**-58 at worst.
    """

    def __init__(self, words: np.ndarray):
        n = len(words)
        with np.errstate(over="ignore"):
            power = np.ones(n + 1, np.uint64)
            power[1:] = BASE
            np.multiply.accumulate(power, out=power)
            inverse = np.ones(n + 1, np.uint64)
            inverse[1:] = np.uint64(pow(int(BASE), -1, 1 << 64))
            np.multiply.accumulate(inverse, out=inverse)
            self.prefix = np.zeros(n + 1, np.uint64)
            np.cumsum(words * power[:n], dtype=np.uint64, out=self.prefix[1:])
            self.inverse = inverse

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            span = (self.prefix[end] - self.prefix[start]) * self.inverse[start]
            return mixed(span + np.uint64(0x632BE59BD9B4E019) * (end - start).astype(np.uint64))


def window_starts(starts: np.ndarray, length: int) -> np.ndarray:
    """Start positions of all windows of ``length`` words that stay in one text."""
    counts = np.maximum(np.diff(starts) - length + 1, 0)
    if not counts.sum():
        return np.empty(0, np.int64)
    first = np.repeat(starts[:-1], counts)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return first + offset


def long_of(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
