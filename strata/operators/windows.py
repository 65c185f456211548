"""Batch windows over extract keys (FP-01..FP-04, FP-16, FP-17).

A window is a Column predicate.  Bound literals are plain strings, so Spark
casts them to the key's own type (date, timestamp or timestamp_ntz) and the
comparison is constant-folded and pushed into the Parquet / JDBC scan.
"""

from __future__ import annotations

import functools
import operator
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

# Fixed values of the reference.
BUSINESS_CUTOFF = "2015-01-01"
WATERMARK_OVERLAP = "5 minutes"
FIRST_RUN_LOWER = {"bronze": None, "silver": "2015-01-01 00:00:00", "gold": "2000-01-01 00:00:00"}


def bound_literal(value) -> Column:
    """A bound as a string literal, cast by Spark to the compared column's type."""
    if isinstance(value, datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f" if value.microsecond else "%Y-%m-%d %H:%M:%S")
    elif isinstance(value, date):
        value = value.isoformat()
    return F.lit(str(value))


def split_keys(keys) -> list[str]:
    if keys is None:
        return []
    if isinstance(keys, str):
        keys = keys.split(",")
    return [k.strip() for k in keys if k and k.strip()]


def _any(preds: list[Column]) -> Column:
    return functools.reduce(operator.or_, preds)


def incremental_window(keys, lower, upper=None) -> Column | None:
    """OR over keys of ``key > lower AND key < upper`` (strict both sides, FP-01).

    With no upper bound only ``key > lower`` is kept.  A NULL key never
    matches (quirk 6 of the survey, kept).
    """
    ks = split_keys(keys)
    if not ks:
        return None
    lo = bound_literal(lower)
    if upper is None:
        return _any([F.col(k) > lo for k in ks])
    hi = bound_literal(upper)
    return _any([(F.col(k) > lo) & (F.col(k) < hi) for k in ks])


def upper_bound_window(keys, upper) -> Column | None:
    """OR over keys of ``key < upper`` (FP-02)."""
    ks = split_keys(keys)
    if not ks or upper is None:
        return None
    hi = bound_literal(upper)
    return _any([F.col(k) < hi for k in ks])


def lower_bound_window(keys, lower) -> Column | None:
    """OR over keys of ``key > lower`` (FP-03, gold delete predicate)."""
    ks = split_keys(keys)
    if not ks or lower is None:
        return None
    lo = bound_literal(lower)
    return _any([F.col(k) > lo for k in ks])


def check_bounds(lower, upper) -> None:
    """Window sanity guard (FP-16): a lower bound after the upper one is an error."""
    if lower is not None and upper is not None:
        lo = datetime.fromisoformat(str(lower)) if not isinstance(lower, datetime) else lower
        hi = datetime.fromisoformat(str(upper)) if not isinstance(upper, datetime) else upper
        if lo > hi:
            raise ValueError("Invalid time frame: lower bound is after upper bound")


def choose_window(layer: str, run_type: str, load_type: str, keys, lower, upper) -> Column | None:
    """Pick the extraction window for a run (FP-17).

    * FULL run: upper bound only (silver: no bound at all for ``full`` tables).
    * DELTA + incremental/append: both bounds; on a first run the layer's
      default lower bound (bronze has none: upper only).
    * DELTA + full: upper bound only in bronze and gold, no bound in silver.
    """
    run_type, load_type = run_type.upper(), load_type.lower()
    if run_type not in ("FULL", "DELTA"):
        raise ValueError(f"Unknown run_type: {run_type}")
    if load_type not in ("full", "append", "incremental"):
        raise ValueError(f"Unknown load_type: {load_type}")
    check_bounds(lower, upper)
    if layer == "silver" and load_type == "full":
        return None
    if lower is None and run_type == "DELTA":
        lower = FIRST_RUN_LOWER[layer]
    if run_type == "FULL" or load_type == "full" or lower is None:
        return upper_bound_window(keys, upper)
    return incremental_window(keys, lower, upper)


def on_or_after(c: Column, dtype, cutoff: str) -> Column:
    """``c >= cutoff`` for date/timestamp columns; strings are parsed, bad text is false."""
    lit = F.lit(cutoff)
    if isinstance(dtype, (DateType, TimestampType, TimestampNTZType)):
        cond = c >= lit
    elif isinstance(dtype, StringType):
        cond = F.try_to_timestamp(c) >= F.to_timestamp(lit)
    else:
        cond = F.try_to_timestamp(c.cast("string")) >= F.to_timestamp(lit)
    return F.coalesce(cond, F.lit(False))


def business_cutoff_filter(df: DataFrame, columns, cutoff: str = BUSINESS_CUTOFF) -> DataFrame:
    """Keep rows where ANY listed date column is on/after ``cutoff`` (FP-04).

    Listed columns missing from ``df`` are ignored; if none is present no row
    is kept, as in the reference.
    """
    cols = split_keys(columns) if isinstance(columns, str) else list(columns or [])
    if not cols:
        return df
    types = {f.name: f.dataType for f in df.schema.fields}
    preds = [on_or_after(F.col(c), types[c], cutoff) for c in cols if c in types]
    return df.filter(_any(preds) if preds else F.lit(False))
