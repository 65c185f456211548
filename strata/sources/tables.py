"""Table readers (IO-01, IO-02).

The reference pages through its sources with LIMIT/OFFSET; here a table is one
lazy DataFrame and the window predicate is a filter that Catalyst pushes into
the Parquet scan (or into the JDBC query).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FIXTURE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Read ``<base>/<name>.parquet`` (a file or a folder of parts)."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy accessor ``tables.orders`` -> DataFrame, read once per instance.

    ``Tables.for_session`` keeps one catalogue per application and folder, so
    queries of one session share the table scans and any derived frames
    memoised with ``memo`` (DataFrames are immutable, sharing is safe).
    """

    _catalogues: dict[tuple[str, str], "Tables"] = {}

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base
        self._cache: dict[str, DataFrame] = {}
        self._memo: dict[str, object] = {}

    @classmethod
    def for_session(cls, spark: SparkSession, base: str) -> "Tables":
        try:
            app = spark.sparkContext.applicationId
        except Exception:  # noqa: BLE001 -- Spark Connect
            app = str(id(spark))
        key = (app, base)
        if key not in cls._catalogues:
            cls._catalogues[key] = cls(spark, base)
        return cls._catalogues[key]

    def memo(self, key: str, build):
        """Build ``build(self)`` once per catalogue."""
        if key not in self._memo:
            self._memo[key] = build(self)
        return self._memo[key]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.base, name)
        return self._cache[name]


def scan_window(df: DataFrame, window: Column | None) -> DataFrame:
    """Apply a window predicate to a scan; ``None`` means no bound (IO-02 full)."""
    return df if window is None else df.filter(window)


def read_jdbc(spark: SparkSession, url: str, table: str, *,
              properties: dict | None = None,
              partition_column: str | None = None,
              lower_bound=None, upper_bound=None,
              num_partitions: int | None = None,
              fetch_size: int = 10000,
              window: Column | None = None) -> DataFrame:
    """Partitioned JDBC scan of a source table (IO-01).

    With ``partition_column`` the read is split into ``num_partitions`` range
    queries that run on the executors in parallel; ``window`` is a Column
    filter, which the JDBC source compiles into the WHERE clause of each
    range query.  No paging loop runs on the driver.
    """
    reader = (spark.read.format("jdbc")
              .option("url", url)
              .option("dbtable", table)
              .option("fetchsize", str(fetch_size)))
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned JDBC reads need lower_bound, upper_bound and num_partitions")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound))
                  .option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions)))
    return scan_window(reader.load(), window)


def lookup_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A fixed lookup list (status names, cabin classes, ...) as a broadcast dimension.

    Its size is the length of a list written in code, so broadcasting it is
    safe at any data size.  Without the hint Spark sees an RDD of unknown size
    and plans a sort-merge join, which hash-partitions the fact table on a key
    with a handful of values: a few tasks would receive all rows.
    """
    return F.broadcast(spark.createDataFrame(rows, schema))
