"""Uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

Rows fall into blocks by hash, rows that repeat whole by a counter of their own.  How many rows block b sends to
shard s is drawn exactly (each block's row of the matrix is a multivariate
hypergeometric draw from the shards' remaining places), so that every shard gets
exactly its size.  Each block is permuted locally and cut by its row of the
matrix; after the exchange each shard is permuted again, in buckets whose
offsets make the slots gapless.

At scale: only ids, sizes and checksums move, never texts.  There is a block, and a
bucket of each shard, for every ``ROWS`` rows at least, so no window sees many more;
the driver holds ``blocks x shards`` counts.  Draws take masses from differences of
``lgamma``: at 1e11 rows a mass is off by about 5e-4 of itself, sizes stay exact.
Copies of a text spread like any other rows, as the document id is part of the key.

Defined results: a null text has size 8 and checksum 0; rows with a null or
repeated id each get a place of their own (equal rows are interchangeable); an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import written

#: Least numbers of blocks, and of buckets in a shard; rows that one of either takes as a mean at most.
BLOCKS = 512
BUCKETS = 64
ROWS = 1 << 20
SEED = 20240229


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """One exact hypergeometric draw for populations of any size.

    The mass function is log-concave, so a flat top with exponential tails around
    the mode bounds it everywhere: rejection from that envelope (Devroye 1987).
    """
    low, high = max(0, draws - bad), min(draws, good)
    if low == high:
        return low

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    def log_mass(k: int) -> float:
        return log_choose(good, k) + log_choose(bad, draws - k) - log_choose(good + bad, draws)

    mode = min(max((draws + 1) * (good + 1) // (good + bad + 2), low), high)
    top = log_mass(mode)
    p = math.exp(top)
    flat = 1 + p / 2
    while True:
        y = rng.random() * flat / p if rng.random() <= flat / (1 + flat) else (flat + rng.exponential()) / p
        k = mode + (1 if rng.random() < 0.5 else -1) * round(y)
        if low <= k <= high and rng.random() * min(1.0, math.exp(flat - p * y)) <= math.exp(log_mass(k) - top):
            return k


def communication_matrix(block_sizes: list[int], shard_sizes: list[int], seed: int) -> np.ndarray:
    """Counts block x shard with the given margins, uniform over all assignments of rows."""
    rng = np.random.default_rng(seed)
    left = [int(x) for x in shard_sizes]
    matrix = np.zeros((len(block_sizes), len(left)), np.int64)
    for b, rows in enumerate(block_sizes):
        rows, places = int(rows), sum(left)
        for s in range(len(left)):
            places -= left[s]
            matrix[b, s] = n = hypergeometric(rng, left[s], places, rows)
            rows -= n
        for s in range(len(left)):
            left[s] -= int(matrix[b, s])
    return matrix


def shard(docs: DataFrame, shards: int = 24, blocks: int = BLOCKS, buckets: int = BUCKETS,
          seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row of ``docs``."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    rows = rows.withColumn("key", F.xxhash64("doc_id", "size", "text_crc32", F.lit(seed)))
    # Rows that repeat one key spread over the blocks by their place in the table; the table is written once.
    several = rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key", F.lit(True).alias("several"))
    rows = rows.withColumn("row", F.monotonically_increasing_id()).join(written(several, "shard-several"), "key", "left")
    rows = rows.withColumn("key", F.when(F.col("several"), F.xxhash64("key", "row")).otherwise(F.col("key")))
    rows = written(rows.drop("several", "row"), "shard-keys")
    n = rows.count()
    blocks, buckets = max(blocks, -(-n // ROWS)), max(buckets, -(-n // (ROWS * shards)))
    rows = rows.withColumn("block", F.pmod("key", F.lit(blocks)).cast("int"))

    sizes = [0] * blocks  # one count for each block: bounded by the parameter
    for r in rows.groupBy("block").count().collect():
        sizes[r["block"]] = r["count"]
    total = sum(sizes)
    targets = [total // shards + (s < total % shards) for s in range(shards)]
    ends = communication_matrix(sizes, targets, seed).cumsum(axis=1)
    cuts = spark.createDataFrame([(b, [int(x) for x in ends[b]]) for b in range(blocks)],
                                 "block int, ends array<long>")

    local = Window.partitionBy("block").orderBy(F.xxhash64("key", F.lit(1)), "doc_id", "size", "text_crc32")
    placed = (rows.withColumn("rank", F.row_number().over(local) - 1)
              .join(F.broadcast(cuts), "block")  # blocks x shards counts
              .select("doc_id", "size", "text_crc32", F.xxhash64("key", F.lit(2)).alias("order"),
                      F.size(F.filter("ends", lambda e: e <= F.col("rank"))).alias("shard"))
              .withColumn("bucket", F.pmod("order", F.lit(buckets)).cast("int")))
    placed = written(placed, "shard-places")

    starts = []
    offset: dict[int, int] = {}  # shards x buckets counts: bounded by the parameters
    for r in placed.groupBy("shard", "bucket").count().orderBy("shard", "bucket").collect():
        starts.append((r["shard"], r["bucket"], offset.get(r["shard"], 0)))
        offset[r["shard"]] = offset.get(r["shard"], 0) + r["count"]
    first = spark.createDataFrame(starts, "shard int, bucket int, first long")
    again = Window.partitionBy("shard", "bucket").orderBy("order", "doc_id", "size", "text_crc32")
    return (placed.withColumn("rank", F.row_number().over(again) - 1)
            .join(F.broadcast(first), ["shard", "bucket"])  # shards x buckets counts
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                    (F.col("first") + F.col("rank")).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
