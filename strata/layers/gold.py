"""Gold load from a SQL template (PJ-04 DELTA, PJ-05 FULL)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from strata.functions import codes
from strata.layers.common import Counted, RunContext, TableResult, status_of, with_layout, write_target
from strata.operators import loads, schema, windows
from strata.sources import templates
from strata.sources.store import TableStore


@dataclass
class GoldTable:
    target_table_name: str
    data_load_sql_template: str
    ingestion_strategy: str = "TRUNCATE_INSERT"   # TRUNCATE_INSERT | APPEND | MERGE
    load_key: str | None = None
    incremental_extract_key: str | None = None
    execution_order: int = 0
    bound_append_delete: bool = True              # survey quirk 16
    partition_date_of: str | None = None          # opt-in day partitioning, as for bronze
    load_buckets: int | None = None               # opt-in buckets of the load key, as for bronze


def load_gold_table(store: TableStore, cfg: GoldTable, ctx: RunContext, views: dict[str, DataFrame],
                    last_processed=None) -> TableResult:
    spark = store.spark
    lower = last_processed if ctx.run_type.upper() == "DELTA" else None
    if ctx.run_type.upper() == "DELTA" and lower is None:
        lower = windows.FIRST_RUN_LOWER["gold"]
    res = TableResult(cfg.target_table_name, time_from=None if lower is None else str(lower), time_to=ctx.upper_bound)
    counts = Counted()
    df = counts.source(templates.run_template(spark, cfg.data_load_sql_template, ctx.run_type, lower,
                                              ctx.upper_bound, views))
    existing = store.read(cfg.target_table_name)
    shaped = codes.nan_to_null_all(df)
    # The target's types decide; only the load that makes the target looks at the data for them,
    # at the rows of its template as staged, so that the sources are scanned once.
    shaped = (codes.cast_integral_floats(store.stage(cfg.target_table_name, shaped)) if existing is None
              else schema.cast_like(shaped, existing.schema))
    load_key = windows.split_keys(cfg.load_key)
    incoming = counts.sink(with_layout(shaped, cfg.partition_date_of, cfg.load_buckets, load_key))
    strategy = cfg.ingestion_strategy.upper()
    if strategy not in ("TRUNCATE_INSERT", "APPEND", "MERGE"):
        raise ValueError(f"Unknown ingestion_strategy: {strategy}")
    keys = windows.split_keys(cfg.incremental_extract_key)
    if cfg.bound_append_delete:
        delete = windows.incremental_window(keys, lower, ctx.upper_bound)
    else:
        delete = windows.lower_bound_window(keys, lower)
    if strategy == "MERGE" and not cfg.load_key:
        raise ValueError("MERGE needs a load_key")
    full = ctx.run_type.upper() == "FULL" or strategy == "TRUNCATE_INSERT" or existing is None

    def state():
        if full:
            return loads.full_replace(existing, incoming)
        if strategy == "APPEND":
            return loads.window_append(existing, incoming, delete) if delete is not None else \
                loads.append(existing, incoming)
        return loads.upsert(existing, incoming, load_key, order_by=[])

    mode = "full"
    if not full:
        mode = "upsert" if strategy == "MERGE" else "window" if delete is not None else "full"
    res.version = write_target(store, cfg.target_table_name, state, date_of=cfg.partition_date_of,
                               buckets=cfg.load_buckets, keys=load_key, order_by=[], mode=mode,
                               incoming=incoming, window=delete)
    res.fetched, res.processed = counts.result()
    res.status = status_of(res.fetched, res.processed)
    return res
