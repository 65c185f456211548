"""Target schema handling (IO-14, IO-15, IO-16, F-05 on write)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, MapType, NullType, StringType, StructField, StructType, TimestampNTZType,
                               TimestampType)

from strata.functions import semistructured

KEEP_ALWAYS = ("insertion_date",)


def special_columns(schema: StructType) -> tuple[list[str], list[str]]:
    """JSON-like (struct/map) and array columns of a target (IO-14)."""
    js = [f.name for f in schema.fields if isinstance(f.dataType, (StructType, MapType))]
    arr = [f.name for f in schema.fields if isinstance(f.dataType, ArrayType)]
    return js, arr


def align_to_target(df: DataFrame, target_columns: list[str], keep=KEEP_ALWAYS) -> DataFrame:
    """Missing target columns become NULL text, extra columns are dropped,
    ``insertion_date`` is kept (IO-15, full load)."""
    cols = list(target_columns) + [k for k in keep if k in df.columns and k not in target_columns]
    return df.select([F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in cols])


def common_columns(df: DataFrame, target_columns: list[str]) -> DataFrame:
    """Keep the batch columns the target also has, in batch order (IO-15, delta load)."""
    wanted = set(target_columns)
    return df.select([c for c in df.columns if c in wanted])


def target_schema(source: StructType, wanted: list[str]) -> StructType:
    """Target schema from the source schema and the wanted columns (IO-16).

    A wanted column absent from the source becomes nullable text.
    """
    by_name = {f.name: f for f in source.fields}
    return StructType([by_name[c] if c in by_name else StructField(c, StringType(), True) for c in wanted])


def synchronised(existing: StructType | None, batch: StructType, wanted: list[str],
                 stamp: str = "insertion_date") -> StructType:
    """Schema of a target made or synchronised for the wanted columns (IO-15, IO-16, full load).

    A new target takes the batch's types; nested columns are stored as text, and
    so is a column without a type.  In an existing target a kept column keeps its
    type, a column gained is text, columns no longer wanted go, and the load stamp
    is kept, or made again where it is no timestamp.
    """
    known = {f.name: f.dataType for f in (batch if existing is None else existing).fields}
    fields = []
    for c in wanted:
        kind = known.get(c, StringType())
        nested = isinstance(kind, (StructType, MapType, ArrayType, NullType))
        fields.append(StructField(c, StringType() if nested else kind, True))
    held = None if existing is None else known.get(stamp)
    if stamp not in wanted:
        kept = isinstance(held, (TimestampNTZType, TimestampType))
        fields.append(StructField(stamp, held if kept else TimestampNTZType(), True))
    return StructType(fields)


def conform(df: DataFrame, target: StructType) -> DataFrame:
    """The target's columns in its order and types; a missing one is NULL."""
    have = set(df.columns)
    return df.select([(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                      for f in target.fields])


def serialise_for_target(df: DataFrame, json_cols=(), array_cols=(), xml_cols=()) -> DataFrame:
    """Cell serialisation on write: JSON text, ``{a,b}`` arrays, repaired XML (IO-12, IO-13, IO-17)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    exprs = {}
    for c in json_cols:
        if c in types:
            exprs[c] = semistructured.json_cell(F.col(c), types[c])
    for c in array_cols:
        if c in types:
            exprs[c] = semistructured.pg_array_text(F.col(c), types[c])
    for c in xml_cols:
        if c in types:
            exprs[c] = semistructured.repair_xml(F.col(c))
    return df.withColumns(exprs) if exprs else df


def cast_like(df: DataFrame, target: StructType) -> DataFrame:
    """Cast columns that the target also has to the target's types: a loaded
    batch never changes the type of an existing table column."""
    types = {f.name: f.dataType for f in target.fields}
    return df.select([F.col(f.name).cast(types[f.name]).alias(f.name)
                      if f.name in types and types[f.name] != f.dataType else F.col(f.name)
                      for f in df.schema.fields])
