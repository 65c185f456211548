"""Join rewrites the planner cannot do for us (JN-04) and ordered string
aggregation (S-15)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_join_any_key(base: DataFrame, dim: DataFrame, dim_key: str, base_keys: list[str],
                      prefix: str) -> DataFrame:
    """``base LEFT JOIN dim ON dim.key = base.k1 OR dim.key = base.k2 ...`` (JN-04).

    An OR condition plans as a nested-loop join (cost ~ |base| x |dim|).
    Here each key is its own equi left join (hash or broadcast), the matched
    dimension rows are gathered in an array without NULLs and duplicates, and
    ``explode_outer`` yields one row per distinct match -- or one row with
    NULLs when nothing matched, as the OR join does.  Requires ``dim_key`` to
    be unique in ``dim`` (a dimension key).
    """
    cols = dim.columns
    out = base
    structs = []
    row = F.xxhash64(*[F.col(c) for c in base.columns])
    for i, k in enumerate(base_keys):
        alias = f"_m{i}"
        side = dim.select(F.col(dim_key).alias(f"_k{i}"), F.struct(*[F.col(c) for c in cols]).alias(alias))
        out = left_join_spread(out, side, k, f"_k{i}", row).drop(f"_k{i}")
        structs.append(F.col(alias))
    matches = F.array_distinct(F.array_compact(F.array(*structs)))
    out = out.withColumn("_match", F.explode_outer(matches)).drop(*[f"_m{i}" for i in range(len(base_keys))])
    return out.select(*[c for c in out.columns if c != "_match"],
                      *[F.col("_match")[c].alias(f"{prefix}{c}") for c in cols])


def left_join_spread(base: DataFrame, dim: DataFrame, key: str, dim_key: str, row: Column) -> DataFrame:
    """``base LEFT JOIN dim ON base.key = dim.dim_key`` for a key that is often NULL.

    All rows of a NULL key hash to one task.  A second key, a hash of the row
    where the key is NULL, spreads them; it cannot match, as the key does not.
    """
    left = base.withColumn("_spread", F.when(F.col(key).isNull(), row).otherwise(F.lit(0)))
    right = dim.withColumn("_zero", F.col(dim_key).isNull().cast("long"))
    return left.join(right, (left[key] == right[dim_key]) & (left["_spread"] == right["_zero"]), "left").drop(
        "_spread", "_zero")


def ordered_string_agg(value: Column, order: list[Column], sep: str) -> Column:
    """``STRING_AGG(value, sep)`` with an explicit order (S-15).

    The reference's T-SQL leaves the order open; a fixed order makes the
    result repeatable.  Built on ``collect_list`` (partially aggregated on the
    map side); the list holds one group's values, whose size is that of the
    output string itself.
    """
    items = F.collect_list(F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], value.alias("_v")))
    return F.array_join(F.transform(F.array_sort(items), lambda x: x["_v"]), sep)
