"""Batch control, configuration and audit frames (FP-05, JN-10, JN-11,
SL-02..SL-04, AG-09, AG-11..AG-13, PJ-07).

Control tables are small (tens to thousands of rows) but every function here
is still a DataFrame plan: the watermark and the run summary are grouped
aggregates over the audit log, which grows with every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import dates

# Fixed values of the reference.
SUCCESS_WORDS = ("Success", "SUCCESS", "success")
SUCCESS, PARTIAL, FAILED = "Success", "Partial Success", "Failed"


def running_batch(batches: DataFrame) -> DataFrame:
    """The RUNNING batch row: highest id, latest start, first row (SL-02)."""
    return (batches.filter(F.col("run_status") == "RUNNING")
            .orderBy(F.col("batch_run_id").desc(), F.col("run_start_datetime").desc())
            .limit(1))


def select_config(config: DataFrame, *, active_col: str = "is_active",
                  source_col: str | None = None, sources=None,
                  type_col: str | None = None, table_type=None,
                  db_col: str | None = None, db_codes=None,
                  table_col: str | None = None, tables=None,
                  frequency_col: str | None = None, frequency=None,
                  run_type: str = "FULL") -> DataFrame:
    """Config row filter (FP-05): active, source IN, type =, optional db/table IN,
    frequency = only for DELTA runs."""
    cond = F.col(active_col) == F.lit(1) if active_col else F.lit(True)
    if source_col and sources:
        cond = cond & F.col(source_col).isin(*sources)
    if type_col and table_type is not None:
        cond = cond & (F.col(type_col) == table_type)
    if db_col and db_codes:
        cond = cond & F.col(db_col).isin(*db_codes)
    if table_col and tables:
        cond = cond & F.col(table_col).isin(*tables)
    if frequency_col and frequency is not None and run_type.upper() == "DELTA":
        cond = cond & (F.col(frequency_col) == frequency)
    return config.filter(cond)


def expand_config(systems: DataFrame, databases: DataFrame, tables: DataFrame) -> DataFrame:
    """System x database x table config on ``source_system_id`` (JN-11):
    one row per table and database of its system."""
    return (tables.join(systems, "source_system_id")
            .join(databases, "source_system_id"))


def processing_order(config: DataFrame, layer: str) -> list[Column]:
    """Sort keys of the table loop (SL-04)."""
    keys = {"bronze": ["load_sequence", "hierarchy_number"],
            "silver": ["hierarchy_number", "load_sequence"],
            "gold": ["execution_order"]}[layer]
    return [F.col(k).asc_nulls_last() for k in keys]


# Fixed value: audit name of an update after the cleaning.
POST_CLEAN_UPDATE = "Post-Clean_Update"


def high_water_marks(audit: DataFrame, batches: DataFrame,
                     by: list[str] = ("source_table_name",),
                     overlap: str = "5 minutes") -> DataFrame:
    """Per table: ``MAX(time_to) - overlap`` over successful DELTA runs (AG-09, JN-10).

    One grouped aggregate for all tables at once, instead of one query per
    table.  A table with no such run has no row (its first run is unbounded
    below, or uses the layer default).  Updates that follow the cleaning are
    not loads and move no mark.
    """
    ok = (audit.filter(F.col("etl_start_time").isNotNull() & (F.col("operation") != POST_CLEAN_UPDATE)
                       & F.col("operation_result").isin(*SUCCESS_WORDS))
          .join(batches.filter(F.col("load_type") == "DELTA").select("batch_run_id"),
                "batch_run_id"))
    return (ok.groupBy(*by)
            .agg(dates.minus_interval(F.max("time_to"), overlap).alias("last_processed_date")))


def reconcile(fetched: Column, processed: Column) -> Column:
    """Fetched-versus-written status (AG-12)."""
    return (F.when((fetched == processed) & (fetched > 0), F.lit(SUCCESS))
            .when(processed > 0, F.lit(PARTIAL))
            .when((fetched == 0) & (processed == 0), F.lit(SUCCESS))
            .otherwise(F.lit(FAILED)))


def latest_audit_state(events: DataFrame, keys=("process_id", "batch_run_id", "source_table_name"),
                       order_col: str = "event_time") -> DataFrame:
    """Audit trail state: latest event per (process, batch, table) (PJ-07).

    The audit log is append-only (in-progress row, then the final row); the
    state is a partial-aggregated ``max_by``, safe for hot keys.
    """
    payload = [c for c in events.columns if c not in keys]
    value = F.struct(*[F.col(c) for c in payload])
    return (events.groupBy(*keys)
            .agg(F.max_by(value, F.struct(F.col(order_col), value)).alias("_s"))
            .select(*keys, *[F.col("_s")[c].alias(c) for c in payload]))


def run_summary(table_audit: DataFrame, by: str = "batch_run_id") -> DataFrame:
    """Run summary (AG-13): tables total / ok / failed, success rate,
    rows fetched / processed, names of failed tables.

    The list of failed names is bounded by the number of configured tables
    of a run, not by the data.
    """
    failed = F.col("operation_result") == FAILED
    ok = F.col("operation_result").isin(*SUCCESS_WORDS)
    total = F.count(F.lit(1))
    n_ok = F.sum(F.when(ok, 1).otherwise(0))
    return table_audit.groupBy(by).agg(
        total.alias("tables_total"),
        n_ok.alias("tables_successful"),
        F.sum(F.when(failed, 1).otherwise(0)).alias("tables_failed"),
        F.round(n_ok * F.lit(100.0) / total, 2).alias("success_rate"),
        F.sum("input_row").alias("rows_fetched"),
        F.sum("output_row").alias("rows_processed"),
        F.min("etl_start_time").alias("run_start"),
        F.max("etl_end_time").alias("run_end"),
        F.timestamp_diff("SECOND", F.min("etl_start_time"), F.max("etl_end_time")).alias("duration_seconds"),
        F.array_join(F.array_sort(F.collect_set(F.when(failed, F.col("destination_table_name")))),
                     ", ").alias("failed_tables"),
    )


def latest_successful_run(audit: DataFrame, batches: DataFrame, table: str,
                          table_col: str = "destination_table_name") -> DataFrame:
    """Top-1 latest successful audit row of a table in a DELTA batch (SL-03)."""
    delta = batches.filter(F.col("load_type") == "DELTA").select("batch_run_id").distinct()
    return (audit.filter((F.col(table_col) == table) & F.col("operation_result").isin(*SUCCESS_WORDS))
            .join(delta, "batch_run_id", "left_semi")
            .orderBy(F.col("time_to").desc_nulls_last(), F.col("process_id").desc())
            .limit(1))


def distinct_sources(config: DataFrame, cols=("source_system_name",)) -> DataFrame:
    """Distinct source systems (or databases) of a config (AG-11)."""
    return config.select(*cols).distinct()
