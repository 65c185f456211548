"""Shared pieces of the layer jobs: run context, result, counting, audit events."""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.operators import control
from strata.sources.store import BUCKET_COLUMN, WHOLE, PartitionedTable, TableStore, bucketed

AUDIT_SCHEMA = ("process_id string, batch_run_id long, data_source string, db_code string, "
                "source_table_name string, destination_table_name string, operation string, "
                "time_from timestamp_ntz, time_to timestamp_ntz, etl_start_time timestamp_ntz, "
                "etl_end_time timestamp_ntz, input_row long, output_row long, operation_result string, "
                "errorcode string, event_time timestamp_ntz")
IN_PROGRESS = "In Progress"


def now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


@dataclass
class RunContext:
    """The running batch (SL-02) plus the run's load stamp."""
    batch_run_id: int
    run_type: str                      # FULL | DELTA
    upper_bound: str                   # batch upper bound time
    run_frequency: str | None = None
    run_ts: str = field(default_factory=lambda: now().strftime("%Y-%m-%d %H:%M:%S"))
    process_id: str = field(default_factory=lambda: uuid.uuid4().hex)


@dataclass
class TableResult:
    table: str
    fetched: int = 0
    processed: int = 0
    status: str = control.FAILED
    error: str | None = None
    version: int | None = None
    time_from: str | None = None
    time_to: str | None = None


class CountedBy:
    """Row counts for each value of a column, taken while one write runs: one observed map of conditional counts."""

    def __init__(self, column: str, values: list):
        self.column, self.values = column, values
        self.obs_in, self.obs_out = Observation(), Observation()

    def _observe(self, df: DataFrame, obs: Observation) -> DataFrame:
        counts = [F.count(F.when(F.col(self.column) == F.lit(v), 1)).alias(f"n{i}") for i, v in enumerate(self.values)]
        return df.observe(obs, *counts)

    def source(self, df: DataFrame) -> DataFrame:
        return self._observe(df, self.obs_in)

    def sink(self, df: DataFrame) -> DataFrame:
        return self._observe(df, self.obs_out)

    def result(self) -> dict:
        """value -> (fetched, written)."""
        read, wrote = observed(self.obs_in), observed(self.obs_out)
        return {v: (int(read.get(f"n{i}", 0)), int(wrote.get(f"n{i}", 0))) for i, v in enumerate(self.values)}


class Counted:
    """Row counts taken while the write runs (AG-12): no second action.

    A branch that adaptive execution found empty and left out reports nothing: no rows.
    """

    def __init__(self):
        self.obs_in, self.obs_out = Observation(), Observation()

    def source(self, df: DataFrame) -> DataFrame:
        return df.observe(self.obs_in, F.count(F.lit(1)).alias("n"))

    def sink(self, df: DataFrame) -> DataFrame:
        return df.observe(self.obs_out, F.count(F.lit(1)).alias("n"))

    def result(self) -> tuple[int, int]:
        return int(observed(self.obs_in).get("n", 0)), int(observed(self.obs_out).get("n", 0))


def observed(obs: Observation) -> dict:
    """The metrics of an observation; none where adaptive execution left its branch out.

    PySpark cannot turn the JVM's empty row, which has no schema, into a dict.
    """
    try:
        return obs.get
    except Py4JJavaError as e:
        if "AssertionError" in str(e) and "PythonSQLUtils.toPyRow" in str(e):
            return {}
        raise


def status_of(fetched: int, processed: int) -> str:
    """Driver-side form of ``control.reconcile`` for one table."""
    if fetched == processed and fetched > 0:
        return control.SUCCESS
    if processed > 0:
        return control.PARTIAL
    if fetched == 0 and processed == 0:
        return control.SUCCESS
    return control.FAILED


def audit_row(ctx: RunContext, *, source: str, db_code: str | None, source_table: str, target_table: str,
              operation: str, result: TableResult | None, started: _dt.datetime,
              ended: _dt.datetime | None) -> tuple:
    """One table-level audit event (PJ-07) of ``AUDIT_SCHEMA``: in-progress when ``result`` is None."""
    def ts(x):
        return None if x is None else (_dt.datetime.fromisoformat(str(x)) if not isinstance(x, _dt.datetime) else x)
    return (ctx.process_id, ctx.batch_run_id, source, db_code, source_table, target_table, operation,
            ts(result.time_from) if result else None, ts(result.time_to) if result else None,
            started, ended, result.fetched if result else None, result.processed if result else None,
            result.status if result else IN_PROGRESS, (result.error or None) if result else None, now())


def audit_event(spark: SparkSession, ctx: RunContext, **what) -> DataFrame:
    """``audit_row`` as a frame of one row."""
    return spark.createDataFrame([audit_row(ctx, **what)], AUDIT_SCHEMA)


PARTITION_COLUMN = "load_day"


def with_load_day(df: DataFrame, date_of: str | None) -> DataFrame:
    """Add the day partition column derived from a timestamp column (opt-in)."""
    return df.withColumn(PARTITION_COLUMN, F.to_date(F.col(date_of))) if date_of else df


def with_layout(df: DataFrame, date_of: str | None, buckets: int | None, keys: list[str]) -> DataFrame:
    """Add the partition column of an opt-in layout: the day of a timestamp, or a bucket of the load key."""
    if date_of:
        return with_load_day(df, date_of)
    return bucketed(df, keys, buckets) if buckets and keys else df


def write_target(store: TableStore, name: str, state_fn, *, date_of: str | None, buckets: int | None,
                 keys: list[str], order_by: list[str], mode: str, incoming: DataFrame, window=None,
                 scope=None) -> int:
    """Write a layer target; ``mode`` is full, window or upsert.

    Without a layout the next state (``state_fn()``) becomes a new version.  By
    day or bucket, a window load replaces only the partitions that the window
    touches, and by bucket an upsert only the buckets of the delivered keys.  A
    table that was committed in another layout (none, days, another number of
    buckets) is rewritten once, whole, by the load that changes it.
    """
    column = PARTITION_COLUMN if date_of else BUCKET_COLUMN if buckets and keys else None
    state = store.snapshot(name)
    if column is None:
        next_state = state_fn()
        return store.write(name, next_state if state is None or state.layout == WHOLE else without_layout(next_state))
    table = PartitionedTable(store.spark, f"{store.root}/{name}", column, None if date_of else buckets)
    if state is not None and state.layout != table.layout:
        return table.replace_all(with_layout(without_layout(state_fn()), date_of, buckets, keys))
    if mode == "window":
        return table.replace_window(incoming, window, scope)
    if mode == "upsert" and not date_of:
        return table.upsert(incoming, keys, order_by)
    return table.replace_all(state_fn())


def without_layout(df: DataFrame) -> DataFrame:
    return df.drop(PARTITION_COLUMN, BUCKET_COLUMN)
