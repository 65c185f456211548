"""Gold SQL templates with time-bound placeholders (IO-03).

The reference pastes quoted bound strings into the SQL text.  Here the
placeholders become named parameter markers and the bounds are passed as
arguments to ``spark.sql`` -- no SQL text is built from values.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# Fixed values of the reference.
UPPER_PLACEHOLDERS = ("{upper_bound_date}", "{upper_bound_time}")
LOWER_PLACEHOLDERS = ("{lower_bound_date}", "{lower_bound_time}")
FULL_RUN_LOWER_BOUND = "2000-01-01"


def bind_time_bounds(sql: str, run_type: str, lower=None, upper=None) -> tuple[str, dict]:
    """Replace placeholders by ``:lower_bound`` / ``:upper_bound`` markers.

    FULL runs bind the lower bound to 2000-01-01; a DELTA run whose template
    needs a lower bound but has none is an error.
    """
    args: dict[str, str] = {}
    text = sql
    if any(p in text for p in UPPER_PLACEHOLDERS):
        if upper is None:
            raise ValueError("template needs an upper bound")
        for p in UPPER_PLACEHOLDERS:
            text = text.replace(p, ":upper_bound")
        args["upper_bound"] = str(upper)
    if any(p in text for p in LOWER_PLACEHOLDERS):
        if run_type.upper() == "FULL":
            lower = FULL_RUN_LOWER_BOUND
        elif lower is None:
            raise ValueError("DELTA template needs a lower bound")
        for p in LOWER_PLACEHOLDERS:
            text = text.replace(p, ":lower_bound")
        args["lower_bound"] = str(lower)
    return re.sub(r";\s*$", "", text.strip()), args


def run_template(spark: SparkSession, sql: str, run_type: str, lower=None, upper=None,
                 views: dict[str, DataFrame] | None = None) -> DataFrame:
    """Register ``views`` as temp views and run the bound template."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    text, args = bind_time_bounds(sql, run_type, lower, upper)
    return spark.sql(text, args=args)
