"""Code and value unification (F-10..F-14, F-03, F-05)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the reference.
COUNTRY_CODES = {"US": "USA", "IN": "IND", "GB": "UK"}
CURRENCY_RATES = {"USD": 1, "INR": 0.012, "EUR": 1.1}
BASE_CURRENCY_FACTOR = 1.2
DEFAULT_LATITUDE = 40.7128
DEFAULT_LONGITUDE = -74.0060


def literal_map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def map_or_keep(c: Column, mapping: dict) -> Column:
    """Replace values found in ``mapping``; keep the others (and NULL)."""
    return F.coalesce(F.try_element_at(literal_map(mapping), c), c)


def unify_country(c: Column, mapping: dict = COUNTRY_CODES) -> Column:
    """US -> USA, IN -> IND, GB -> UK, else unchanged (F-10)."""
    return map_or_keep(c, mapping)


def to_base_currency(value: Column, currency: Column, rates: dict = CURRENCY_RATES) -> Column:
    """``value * rate(currency)``; unknown or NULL currency counts as 1 (F-11)."""
    rate = F.coalesce(F.try_element_at(literal_map({k: float(v) for k, v in rates.items()}), currency),
                      F.lit(1.0))
    return value * rate


def uplift(value: Column, factor: float = BASE_CURRENCY_FACTOR) -> Column:
    """Base currency uplift ``* 1.2`` (F-12)."""
    return value * F.lit(factor)


def reverse_value_map(config: dict) -> dict:
    """``{target: [sources]}`` -> ``{source: target}`` (F-14)."""
    return {src: target for target, sources in config.items() for src in sources}


def unify_values(c: Column, config: dict) -> Column:
    """Value mapping unification (F-14)."""
    return map_or_keep(c, reverse_value_map(config))


def nan_to_null(c: Column) -> Column:
    """NaN -> NULL on a float column (F-03)."""
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def integral_float_columns(df: DataFrame) -> list[str]:
    """Float columns whose non-null values are all integral (F-05).

    One aggregate pass; the driver receives one boolean per column.
    """
    floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    if not floats:
        return []
    aggs = [F.coalesce(F.bool_and(F.col(c) == F.floor(F.col(c))) & (F.count(F.col(c)) > 0),
                       F.lit(False)).alias(c) for c in floats]
    row = df.agg(*aggs).first()
    return [c for c in floats if row[c]]


def cast_integral_floats(df: DataFrame) -> DataFrame:
    """Integral float columns become bigint (F-05)."""
    ints = set(integral_float_columns(df))
    return df.select([F.col(c).cast("bigint").alias(c) if c in ints else F.col(c) for c in df.columns])


def nan_to_null_all(df: DataFrame) -> DataFrame:
    """NaN -> NULL in every float column, as every layer's writer does (F-03)."""
    cols = {f.name: nan_to_null(F.col(f.name)) for f in df.schema.fields
            if f.dataType.typeName() in ("double", "float")}
    return df.withColumns(cols) if cols else df
