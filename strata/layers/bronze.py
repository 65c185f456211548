"""Bronze load of one source table (PJ-01).

window (FP-17) -> source scan with pushed predicate (IO-01) -> sentinel clamp
(IO-05) -> multi-database tag (IO-04) -> stamp (IO-11) -> write cleaning
(F-01..F-03) -> load strategy (IO-06..IO-10) -> new table version.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.layers.common import Counted, CountedBy, RunContext, TableResult, status_of, with_layout, write_target
from strata.operators import clean, loads, schema, windows
from strata.sources.store import TableStore


@dataclass
class BronzeTable:
    """Bronze config row (names as in the reference)."""
    source_table_name: str
    target_table_name: str
    extract_key: str | None = None
    load_key: str | None = None
    load_type: str = "full"           # full | append | incremental
    load_sequence: int = 0
    hierarchy_number: int = 0
    run_frequency: str | None = None
    # opt-in: store the target partitioned by the date of this timestamp
    # column; a window append then rewrites only the days it touches
    partition_date_of: str | None = None
    # opt-in: store the target in so many buckets of the load key; an upsert
    # then rewrites only the buckets of the delivered keys
    load_buckets: int | None = None


def load_bronze_table(store: TableStore, source: DataFrame, cfg: BronzeTable, ctx: RunContext,
                      last_processed=None, source_db: tuple | None = None) -> TableResult:
    """Load one table; ``source_db`` = (source_db_id, market_profile_id) for a
    multi-database source, whose rows are scoped by ``source_db_id``."""
    res = TableResult(cfg.target_table_name, time_from=None if last_processed is None else str(last_processed),
                      time_to=ctx.upper_bound)
    window = windows.choose_window("bronze", ctx.run_type, cfg.load_type, cfg.extract_key,
                                   last_processed, ctx.upper_bound)
    src = source if window is None else source.filter(window)
    if cfg.source_table_name in loads.SENTINEL_TABLES and "EndDate" in src.columns:
        src = loads.clamp_sentinel(src, "EndDate")
    counts = Counted()
    src = counts.source(src)
    if source_db is not None:
        src = loads.tag_source(src, *source_db)
    existing = store.read(cfg.target_table_name)
    staged = clean.bronze_clean(loads.stamp(src, ctx.run_ts))
    if existing is not None:
        staged = schema.cast_like(staged, existing.schema)
    keys = load_keys(cfg, source_db)
    incoming = counts.sink(with_layout(staged, cfg.partition_date_of, cfg.load_buckets, keys))
    mode = "full"
    if ctx.run_type.upper() == "DELTA" and existing is not None:
        if cfg.load_type.lower() == "append" and last_processed is not None:
            mode = "window"
        elif cfg.load_type.lower() == "incremental":
            mode = "upsert"
    scope = None if source_db is None else (F.col("source_db_id") == F.lit(source_db[0]))
    res.version = write_target(
        store, cfg.target_table_name,
        lambda: new_state(existing, incoming, cfg, ctx, window, last_processed, source_db),
        date_of=cfg.partition_date_of, buckets=cfg.load_buckets, keys=keys,
        order_by=windows.split_keys(cfg.extract_key), mode=mode, incoming=incoming, window=window, scope=scope)
    res.fetched, res.processed = counts.result()
    res.status = status_of(res.fetched, res.processed)
    return res


@dataclass
class SourceDatabase:
    """One database of a multi-database source: its rows, tags and watermark."""
    source: DataFrame
    source_db_id: int
    market_profile_id: int | None = None
    last_processed: object = None


def load_bronze_databases(store: TableStore, databases: list[SourceDatabase], cfg: BronzeTable,
                          ctx: RunContext) -> dict[int, TableResult]:
    """Load one table from all databases of a multi-database source as one write (IO-04, SO-03).

    Every database keeps its own window, pushed into its own scan; the rows are
    tagged and united, and the target gets one new version.  Of each database the
    rows that its load type replaces give way, rows of other databases stay.
    Fetched and written rows are counted by database within the write.
    """
    delta = ctx.run_type.upper() == "DELTA"
    kind = cfg.load_type.lower()
    scans, lost = [], F.lit(False)
    for db in databases:
        window = windows.choose_window("bronze", ctx.run_type, cfg.load_type, cfg.extract_key, db.last_processed,
                                       ctx.upper_bound)
        src = db.source if window is None else db.source.filter(window)
        if cfg.source_table_name in loads.SENTINEL_TABLES and "EndDate" in src.columns:
            src = loads.clamp_sentinel(src, "EndDate")
        scans.append(loads.tag_source(src, db.source_db_id, db.market_profile_id))
        mine = F.coalesce(F.col("source_db_id") == F.lit(db.source_db_id), F.lit(False))
        bounded = delta and kind == "append" and db.last_processed is not None and window is not None
        lost = lost | (mine & F.coalesce(window, F.lit(False)) if bounded else mine)
    counts = CountedBy("source_db_id", [db.source_db_id for db in databases])
    staged = clean.bronze_clean(loads.stamp(counts.source(loads.union_sources(scans)), ctx.run_ts))
    existing = store.read(cfg.target_table_name)
    if existing is not None:
        staged = schema.cast_like(staged, existing.schema)
    keys, order = load_keys(cfg, (None, None)), windows.split_keys(cfg.extract_key)
    incoming = counts.sink(with_layout(staged, cfg.partition_date_of, cfg.load_buckets, keys))
    upsert = delta and kind == "incremental"

    def state():
        if upsert:
            return loads.upsert(existing, incoming, keys, order_by=order)
        return loads.window_append(existing, incoming, lost)

    mode = "full" if existing is None else "upsert" if upsert else "window"
    version = write_target(store, cfg.target_table_name, state, date_of=cfg.partition_date_of,
                           buckets=cfg.load_buckets, keys=keys, order_by=order, mode=mode, incoming=incoming, window=lost)
    out = {}
    for db in databases:
        fetched, processed = counts.result()[db.source_db_id]
        last = db.last_processed
        out[db.source_db_id] = TableResult(
            cfg.target_table_name, fetched, processed, status_of(fetched, processed), version=version,
            time_from=None if last is None else str(last), time_to=ctx.upper_bound)
    return out


def new_state(existing, incoming, cfg: BronzeTable, ctx: RunContext, window, last_processed, source_db):
    """The target's next state under the table's load type."""
    scope = None if source_db is None else (F.col("source_db_id") == F.lit(source_db[0]))
    lt = cfg.load_type.lower()
    full = ctx.run_type.upper() == "FULL" or lt == "full"
    if full or (lt == "append" and last_processed is None):
        # truncate + insert; for one database of a multi-database source only
        # that database's rows are replaced (survey quirk 2)
        if existing is not None and scope is not None:
            return existing.filter(~F.coalesce(scope, F.lit(False))).unionByName(incoming, allowMissingColumns=True)
        return loads.full_replace(existing, incoming)
    if lt == "append":
        return loads.window_append(existing, incoming, window, scope)
    return loads.upsert(existing, incoming, load_keys(cfg, source_db),
                        order_by=windows.split_keys(cfg.extract_key))


def load_keys(cfg: BronzeTable, source_db: tuple | None) -> list[str]:
    """The load key; rows of a multi-database source are keyed by their database too."""
    keys = windows.split_keys(cfg.load_key)
    return keys + ["source_db_id"] if keys and source_db is not None and "source_db_id" not in keys else keys
