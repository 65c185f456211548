"""Config-driven run over many tables (PJ-06, PJ-07, AG-09, AG-13).

The driver loops over the collected config rows (tens to hundreds); every
table's work is Spark jobs.  One table's failure is recorded and the loop goes
on.  Watermarks for all tables come from one aggregate over the audit log at
the start of the run.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.layers.common import AUDIT_SCHEMA, RunContext, TableResult, audit_row, now
from strata.operators import control
from strata.sources.store import TableStore

BATCH_SCHEMA = ("batch_run_id long, run_status string, run_start_datetime timestamp_ntz, "
                "run_end_datetime timestamp_ntz, load_type string, run_frequency string")


def open_batch(store: TableStore, name: str, ctx: RunContext) -> None:
    """Record the batch as RUNNING (the reference reads it from a control table)."""
    import datetime as _dt
    upper = _dt.datetime.fromisoformat(ctx.upper_bound)
    row = (ctx.batch_run_id, "RUNNING", now(), upper, ctx.run_type.upper(), ctx.run_frequency)
    store.append_rows(name, store.spark.createDataFrame([row], BATCH_SCHEMA))


def watermarks(store: TableStore, audit_name: str, batch_name: str) -> dict:
    """``{(table, db_code): MAX(time_to) - 5 minutes}`` over successful DELTA
    runs (AG-09); ``db_code`` is None for single-database sources.  Also keyed
    by the table name alone."""
    audit, batches = store.read_rows(audit_name), store.read_rows(batch_name)
    if audit is None or batches is None:
        return {}
    final = audit.filter(F.col("operation_result") != F.lit("In Progress"))
    marks = control.high_water_marks(final, batches, by=["destination_table_name", "db_code"])
    out: dict = {}
    for r in marks.collect():
        out[(r["destination_table_name"], r["db_code"])] = r["last_processed_date"]
        if r["db_code"] is None:
            out[r["destination_table_name"]] = r["last_processed_date"]
    return out


@dataclass
class Job:
    """One table load: ``loader(last_processed) -> TableResult``.

    A job over several databases names them in ``db_codes``; its loader takes and
    returns a value for each: ``loader({code: last}) -> {code: TableResult}``.
    """
    source_table: str
    target_table: str
    load_type: str
    loader: Callable
    level: int = 0            # hierarchy level: levels run in order
    db_code: str | None = None
    db_codes: tuple = ()


def run_tables(store: TableStore, ctx: RunContext, jobs: list, *, audit_name: str, batch_name: str,
               source: str = "", db_code: str | None = None, operation: str | None = None,
               max_parallel: int = 1) -> DataFrame:
    """Run table loads and return the run summary of this batch (AG-13).

    ``jobs`` are ``Job``s (or ``(source_table, target_table, load_type,
    loader)`` tuples).  Levels run one after the other; with ``max_parallel``
    > 1 the tables of one level load concurrently -- each is its own Spark
    job, so a cluster is not left idle by a long sequential table loop.
    """
    run_started = now()
    spark = store.spark
    jobs = [j if isinstance(j, Job) else Job(*j) for j in jobs]
    marks = watermarks(store, audit_name, batch_name) if ctx.run_type.upper() == "DELTA" else {}
    audit_lock = threading.Lock()

    def append_audit(job: Job, results: dict, started, ended):
        rows = [audit_row(ctx, source=source, db_code=code, source_table=job.source_table,
                          target_table=job.target_table, operation=operation or job.load_type, result=result,
                          started=started, ended=ended) for code, result in results.items()]
        with audit_lock:   # appends to one dataset must not overlap
            store.append_rows(audit_name, spark.createDataFrame(rows, AUDIT_SCHEMA).coalesce(1))

    def run_one(job: Job) -> None:
        started = now()
        codes = job.db_codes or (job.db_code or db_code,)
        append_audit(job, dict.fromkeys(codes), started, None)
        bounded = job.load_type.lower() in ("incremental", "append")
        last = {code: marks.get((job.target_table, code)) if bounded else None for code in codes}
        try:
            results = job.loader(last) if job.db_codes else {codes[0]: job.loader(last[codes[0]])}
        except Exception as e:  # noqa: BLE001 -- one table's failure must not stop the run
            results = {code: TableResult(job.target_table, status=control.FAILED, error=str(e),
                                         time_to=ctx.upper_bound) for code in codes}
        append_audit(job, results, started, now())

    def run_target(target_jobs: list) -> None:
        for job in target_jobs:     # loads of one target (e.g. its databases) run in order
            run_one(job)

    for _, level_jobs in groupby(sorted(jobs, key=lambda j: j.level), key=lambda j: j.level):
        by_target: dict[str, list] = {}
        for job in level_jobs:
            by_target.setdefault(job.target_table, []).append(job)
        if max_parallel > 1 and len(by_target) > 1:
            with ThreadPoolExecutor(max_workers=max_parallel) as pool:
                list(pool.map(run_target, by_target.values()))
        else:
            for target_jobs in by_target.values():
                run_target(target_jobs)
    result = summary(store, audit_name, ctx.batch_run_id)
    store.append_rows(f"{audit_name}_runs", run_audit(result, ctx, source, run_started))
    return result


def run_audit(result: DataFrame, ctx: RunContext, source: str, started) -> DataFrame:
    """One run-level audit row (PJ-07): counts of tables and the status of the run."""
    ok, failed = F.col("tables_successful"), F.col("tables_failed")
    status = (F.when(failed == 0, control.SUCCESS).when(ok > 0, control.PARTIAL).otherwise(control.FAILED))
    return result.select(
        F.lit(ctx.process_id).alias("process_id"), "batch_run_id", F.lit(source).alias("data_source"),
        F.lit(started).alias("run_start"), F.lit(now()).alias("run_end"),
        F.col("tables_total").alias("tables_processed"), ok.alias("tables_succeeded"), failed.alias("tables_failed"),
        "rows_fetched", "rows_processed", status.alias("run_status"))


def audit_state(store: TableStore, audit_name: str) -> DataFrame:
    """Latest event per (process, batch, table, database) (PJ-07)."""
    return control.latest_audit_state(store.read_rows(audit_name),
                                      keys=("process_id", "batch_run_id", "destination_table_name", "db_code"))


def summary(store: TableStore, audit_name: str, batch_run_id: int) -> DataFrame:
    state = audit_state(store, audit_name).filter(F.col("batch_run_id") == batch_run_id)
    return control.run_summary(state)


def _layout(r: dict) -> dict:
    """The target layout that a config row names: the day of a timestamp column, or buckets of the load key."""
    buckets = r.get("load_buckets")
    return {"partition_date_of": r.get("partition_date_of") or None, "load_buckets": int(buckets) if buckets else None}


def bronze_jobs(store: TableStore, ctx: RunContext, config_rows: list, read_source: Callable) -> list:
    """Jobs for the collected bronze config (PJ-06): one for each target table.

    ``config_rows`` come from ``control.select_config`` / ``expand_config``,
    ordered by ``control.processing_order`` and collected (tens to hundreds of
    rows).  ``read_source(row)`` returns the source table as a DataFrame (a
    JDBC or Parquet scan); its rows never pass through the driver.  All databases
    of a multi-database table load as one write.
    """
    from strata.layers.bronze import BronzeTable, load_bronze_table

    jobs, several = [], {}
    for row in config_rows:
        r = row.asDict() if hasattr(row, "asDict") else dict(row)
        cfg = BronzeTable(r["source_table_name"], r["target_table_name"], r.get("extract_key"),
                          r.get("load_key"), r.get("load_type", "full"), r.get("load_sequence", 0),
                          r.get("hierarchy_number", 0), r.get("run_frequency"), **_layout(r))
        level = cfg.hierarchy_number or 0
        if _flag(r.get("is_multi_db")):
            key = (cfg.source_table_name, cfg.target_table_name)
            if key not in several:
                several[key] = (cfg, [])
                jobs.append(Job(*key, cfg.load_type, None, level=level))
                several[key] += (jobs[-1],)
            several[key][1].append(r)
            continue

        def loader(last, r=r, cfg=cfg):
            return load_bronze_table(store, read_source(r), cfg, ctx, last)

        jobs.append(Job(cfg.source_table_name, cfg.target_table_name, cfg.load_type, loader, level=level))
    for cfg, rows, job in several.values():
        job.db_codes = tuple(r.get("source_db_code") or str(r["source_db_id"]) for r in rows)
        job.loader = _databases_loader(store, ctx, cfg, dict(zip(job.db_codes, rows)), read_source)
    return jobs


def _databases_loader(store: TableStore, ctx: RunContext, cfg, rows: dict, read_source: Callable) -> Callable:
    """Loader of all databases of one table; a database whose source cannot be opened fails alone.

    Where the joint write fails, the databases are loaded one at a time, so that
    one that breaks while it is read does not hold up the others.
    """
    from strata.layers.bronze import SourceDatabase, load_bronze_databases

    def failed(e: Exception) -> TableResult:
        return TableResult(cfg.target_table_name, status=control.FAILED, error=str(e), time_to=ctx.upper_bound)

    def load(found: dict) -> dict:
        results = load_bronze_databases(store, list(found.values()), cfg, ctx)
        return {code: results[db.source_db_id] for code, db in found.items()}

    def loader(last: dict) -> dict:
        out, found = {}, {}
        for code, r in rows.items():
            try:
                found[code] = SourceDatabase(read_source(r), r["source_db_id"], r.get("market_profile_id"), last[code])
            except Exception as e:  # noqa: BLE001 -- this database's failure
                out[code] = failed(e)
        try:
            if found:
                out.update(load(found))
        except Exception:  # noqa: BLE001 -- find the databases that break
            for code, db in found.items():
                try:
                    out.update(load({code: db}))
                except Exception as e:  # noqa: BLE001
                    out[code] = failed(e)
        return out

    return loader


def _flag(value) -> bool:
    """Config flags arrive as 1, '1', True or 'true' (survey quirk 13: booleans here)."""
    return str(value).strip().lower() in ("1", "true", "yes") if value is not None else False


def silver_jobs(store: TableStore, ctx: RunContext, config_rows: list) -> list:
    """Jobs for the collected silver config: each row's step columns become
    ``SilverSteps`` (JSON configs parsed, flags as booleans)."""
    from strata.layers.silver import SilverTable, load_silver_table
    from strata.operators.clean import SilverSteps

    jobs = []
    for row in config_rows:
        r = row.asDict() if hasattr(row, "asDict") else dict(row)
        steps = SilverSteps(
            case_unification=r.get("case_unification"),
            is_datetime_formatting=r.get("is_datetime_formatting"),
            is_post_2015_filter=_flag(r.get("is_post_2015_filter")),
            extract_key=r.get("extract_key"),
            is_json_xml_flatten=r.get("is_json_xml_flatten"),
            is_add_indicator=r.get("is_add_indicator"),
            is_join_enrichment=r.get("is_join_enrichment"),
            is_country_code_unification=r.get("is_country_code_unification"),
            is_null_handling=_flag(r.get("is_null_handling")),
            is_index_partition=_flag(r.get("is_index_partition")),
            index_order=[c.strip() for c in str(r.get("load_key") or "").split(",") if c.strip()],
            is_string_trimming=_flag(r.get("is_string_trimming")),
            is_currency_standardization=r.get("is_currency_standardization"),
            geographic_enrichment=_flag(r.get("geographic_enrichment")),
            base_currency=_flag(r.get("base_currency")),
            column_name=r.get("column_name"),
            value_mapping_unification=r.get("value_mapping_unification"),
            is_duplicate_check=_flag(r.get("is_duplicate_check")),
        )
        cfg = SilverTable(r["raw_table_name"], r["clean_table_name"], r["column_name"], r.get("extract_key"),
                          r.get("load_key"), r.get("load_type", "full"), r.get("hierarchy_number", 0),
                          r.get("load_sequence", 0), steps, **_layout(r))

        def loader(last, cfg=cfg):
            return load_silver_table(store, cfg, ctx, last)

        jobs.append(Job(cfg.raw_table_name, cfg.clean_table_name, cfg.load_type, loader,
                        level=cfg.hierarchy_number or 0))
    return jobs


def gold_jobs(store: TableStore, ctx: RunContext, config_rows: list, views: Callable) -> list:
    """Jobs for the collected gold config; ``views()`` returns the silver
    tables the templates name, read when each job starts."""
    from strata.layers.gold import GoldTable, load_gold_table

    jobs = []
    for row in config_rows:
        r = row.asDict() if hasattr(row, "asDict") else dict(row)
        cfg = GoldTable(r["target_table_name"], r["data_load_sql_template"],
                        r.get("ingestion_strategy", "TRUNCATE_INSERT"), r.get("load_key"),
                        r.get("incremental_extract_key"), r.get("execution_order", 0), **_layout(r))
        load_type = {"APPEND": "append", "MERGE": "incremental"}.get(cfg.ingestion_strategy.upper(), "full")

        def loader(last, cfg=cfg):
            return load_gold_table(store, cfg, ctx, views(), last)

        jobs.append(Job("silver", cfg.target_table_name, load_type, loader, level=cfg.execution_order or 0))
    return jobs
