"""Load semantics as DataFrame -> DataFrame functions (IO-05..IO-11, WN-02).

Each function returns the *new state* of a target table; ``strata.sources.store``
writes that state.  No function deletes rows in place: a window append keeps
the existing rows outside the window and adds the re-extracted window, an
upsert keeps the existing rows whose key is not re-delivered.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the reference (IO-05): sentinel end date and its clamp.
SENTINEL_END = "9999-12-31 23:59:59"
SENTINEL_CLAMP = "9999-12-31 22:59:59"
SENTINEL_TABLES = ("Organization", "PrivateFare", "TravelerProfile")


def stamp(df: DataFrame, run_ts, column: str = "insertion_date") -> DataFrame:
    """Load stamp: one value per run, so reruns are comparable (IO-11).

    Wall-clock time without zone, like the source keys, so the stamp reads
    the same whatever the session time zone is.
    """
    return df.withColumn(column, F.lit(str(run_ts)).cast("timestamp_ntz"))


def clamp_sentinel(df: DataFrame, column: str = "EndDate") -> DataFrame:
    """``EndDate >= 9999-12-31 23:59:59`` -> ``9999-12-31 22:59:59``; column moves last (IO-05)."""
    c = F.col(column)
    clamped = F.when(c >= F.lit(SENTINEL_END).cast(df.schema[column].dataType),
                     F.lit(SENTINEL_CLAMP).cast(df.schema[column].dataType)).otherwise(c)
    return df.select(*[x for x in df.columns if x != column], clamped.alias(column))


def full_replace(existing: DataFrame | None, incoming: DataFrame) -> DataFrame:
    """Truncate + insert (IO-06, IO-09): the new state is the incoming rows."""
    return incoming


def append(existing: DataFrame | None, incoming: DataFrame) -> DataFrame:
    """Plain append (IO-07)."""
    return incoming if existing is None else existing.unionByName(incoming, allowMissingColumns=True)


def window_append(existing: DataFrame | None, incoming: DataFrame, window: Column | None,
                  scope: Column | None = None) -> DataFrame:
    """Idempotent window append (IO-08).

    Existing rows inside ``window`` (and inside ``scope``, e.g. one source
    database) are replaced by the re-extracted window.  ``coalesce(.., False)``
    keeps rows whose key is NULL, which a plain NOT would drop.  With no
    window (first run) this is a full replace (IO-09).
    """
    if existing is None or window is None:
        return incoming
    inside = F.coalesce(window, F.lit(False))
    if scope is not None:
        inside = inside & F.coalesce(scope, F.lit(False))
    return existing.filter(~inside).unionByName(incoming, allowMissingColumns=True)


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order_by`` (WN-02).

    Written as a ``max_by`` aggregate, not a window: the aggregate is computed
    partially on the map side, so a key that holds a third of all rows is
    reduced before the shuffle instead of landing whole in one task.  The
    whole row is the last tie-breaker, so the pick is deterministic.
    """
    payload = [c for c in df.columns if c not in keys]
    if not payload:
        return df.select(*keys).distinct()
    value = F.struct(*[F.col(c) for c in payload])
    ordering = F.struct(*[F.col(c) for c in order_by], value)
    picked = df.groupBy(*keys).agg(F.max_by(value, ordering).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in payload]).select(*df.columns)


def upsert(existing: DataFrame | None, incoming: DataFrame, keys: list[str],
           order_by: list[str] | None = None) -> DataFrame:
    """Upsert on ``keys``: re-delivered keys take the incoming row (IO-10).

    Duplicate keys inside one delivery keep the last by ``order_by`` (quirk
    14); with no ``order_by`` the greatest whole row.  With only key columns it
    is insert-if-absent (quirk 15).
    """
    if not keys:
        raise ValueError("an upsert needs a load key")
    incoming = latest_per_key(incoming, keys, order_by or [])
    if existing is None:
        return incoming
    kept = existing.join(incoming.select(*keys), on=keys, how="left_anti")
    return kept.unionByName(incoming, allowMissingColumns=True)


def tag_source(df: DataFrame, source_db_id, market_profile_id) -> DataFrame:
    """Tag rows of one source database (IO-04)."""
    return df.withColumns({"source_db_id": F.lit(source_db_id),
                           "market_profile_id": F.lit(market_profile_id)})


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """Multi-database union: one write instead of truncate-per-database (IO-04, SO-03)."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
