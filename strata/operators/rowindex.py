"""Sequential row index 1..n in a given order (WN-01), without a single-partition sort.

``row_number()`` over an unpartitioned window moves every row into one task.
Instead: range-partition on the order key (one shuffle), number rows inside
each partition, materialise that in the shared checkpoint folder so partition
boundaries survive a lost executor, then add each partition's offset --
the running total of the per-partition counts (one number per partition).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir


def row_index(df: DataFrame, order_cols: list[str | Column], column: str = "partition_index",
              num_partitions: int | None = None) -> DataFrame:
    """Add ``column`` = 1..n following ``order_cols``.

    Rows with equal order keys are ordered by a hash of the whole row: the
    numbering is deterministic, and a key value shared by a third of the rows
    is split over several ranges instead of filling one task.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    pid = F.spark_partition_id().cast("long")
    tie = "_tie"
    keyed = df.withColumn(tie, F.xxhash64(*[F.col(c) for c in df.columns]))
    order = [*order_cols, tie]
    ranged = (keyed.repartitionByRange(n, *order)
              .sortWithinPartitions(*order)
              # monotonically_increasing_id = (partition id << 33) + position in partition
              .withColumns({"_pid": pid,
                            "_pos": F.monotonically_increasing_id() - F.shiftleft(pid, 33)})
              .checkpoint(eager=True))
    # one row per partition reaches the driver (like RDD.zipWithIndex): the
    # size is bounded by the partition count, not by the data
    counts = sorted((r["_pid"], r["_n"]) for r in
                    ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).collect())
    running, rows = 0, []
    for part, cnt in counts:
        rows.append((part, running))
        running += cnt
    offsets = spark.createDataFrame(rows, "_pid long, _off long")
    return (ranged.join(F.broadcast(offsets), "_pid")
            .withColumn(column, F.col("_off") + F.col("_pos") + 1)
            .drop("_pid", "_pos", "_off", tie))
