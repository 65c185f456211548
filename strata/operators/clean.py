"""Silver cleaning steps as DataFrame -> DataFrame functions (F-01..F-16,
FP-04, FP-14, AG-10) and their composition in the reference's order.

Each step leaves columns it does not name untouched; a step whose config is
empty is the identity.  Composition is ``df.transform(step)``, so the whole
silver load is one lazy plan.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

from strata.functions import codes, dates, semistructured, text
from strata.operators import windows
from strata.session import ensure_checkpoint_dir


def _load(cfg):
    if isinstance(cfg, str):
        cfg = cfg.strip()
        if not cfg:
            return None
        try:
            return json.loads(cfg)
        except json.JSONDecodeError:
            return [c.strip() for c in cfg.split(",") if c.strip()]
    return cfg


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def _replace(df: DataFrame, exprs: dict) -> DataFrame:
    return df.withColumns(exprs) if exprs else df


def case_unification(df: DataFrame, config) -> DataFrame:
    """``{column: rule}`` with UPPER/LOWER/TITLE/CAPITALIZE/STRIP/SENTENCE (F-06)."""
    cfg = _load(config) or {}
    exprs = {}
    for col, rule in cfg.items():
        if col in df.columns:
            e = text.case_rule(F.col(col), str(rule))
            if e is not None:
                exprs[col] = e
    return _replace(df, exprs)


def datetime_formatting(df: DataFrame, config) -> DataFrame:
    """``{column: format name}`` re-format, bad values -> NULL (F-09)."""
    cfg = _load(config) or {}
    types = {f.name: f.dataType for f in df.schema.fields}
    return _replace(df, {c: dates.reformat_datetime(F.col(c), fmt, types[c])
                         for c, fmt in cfg.items() if c in types})


def post_cutoff_filter(df: DataFrame, columns, cutoff: str = windows.BUSINESS_CUTOFF) -> DataFrame:
    """Business cut-off on any listed date column (FP-04)."""
    cols = _load(columns)
    if not cols:
        return df
    return windows.business_cutoff_filter(df, cols, cutoff)


def flatten_semistructured(df: DataFrame, config) -> DataFrame:
    """JSON / XML flatten (F-15, F-15b)."""
    return semistructured.flatten(df, _load(config) or {})


def placeholder_columns(config) -> list[str]:
    """Columns named by indicator / join-enrichment configs (FP-14)."""
    cfg = _load(config)
    names = []
    if isinstance(cfg, dict):
        for value in cfg.values():
            if isinstance(value, dict) and value.get("new_column_name"):
                names.append(value["new_column_name"])
        for join in cfg.get("joins", []) or []:
            for sel in join.get("selected_columns", []) or []:
                name = sel.get("alias") or sel.get("column")
                if name:
                    names.append(name)
    return names


def add_placeholders(df: DataFrame, *configs) -> DataFrame:
    """Add NULL columns for configured new columns that are absent (FP-14).

    The reference never fills them; neither does this step.
    """
    names = []
    for cfg in configs:
        for n in placeholder_columns(cfg):
            if n not in names and n not in df.columns:
                names.append(n)
    return df.withColumns({n: F.lit(None).cast("string") for n in names}) if names else df


def country_code_unification(df: DataFrame, columns) -> DataFrame:
    cols = _load(columns) or []
    return _replace(df, {c: codes.unify_country(F.col(c)) for c in cols if c in df.columns})


def null_handling(df: DataFrame) -> DataFrame:
    """Empty string -> NULL in every string column (F-04)."""
    return _replace(df, {c: text.empty_to_null(F.col(c)) for c in string_columns(df)})


def string_trimming(df: DataFrame, columns=None) -> DataFrame:
    """Trim, collapse spaces, title-case: every string column by default (F-07)."""
    cols = string_columns(df) if columns is None else [c for c in columns if c in string_columns(df)]
    return _replace(df, {c: text.trim_title(F.col(c)) for c in cols})


def currency_standardization(df: DataFrame, columns, rates=codes.CURRENCY_RATES) -> DataFrame:
    """``col * rate(col_currency)`` (F-11)."""
    cols = _load(columns) or []
    return _replace(df, {c: codes.to_base_currency(F.col(c), F.col(f"{c}_currency"), rates)
                         for c in cols if c in df.columns and f"{c}_currency" in df.columns})


def geographic_enrichment(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """NULL coordinates -> the reference's default point (F-13)."""
    exprs = {}
    if lat in df.columns:
        exprs[lat] = F.coalesce(F.col(lat), F.lit(codes.DEFAULT_LATITUDE))
    if lon in df.columns:
        exprs[lon] = F.coalesce(F.col(lon), F.lit(codes.DEFAULT_LONGITUDE))
    return _replace(df, exprs)


def base_currency(df: DataFrame, columns) -> DataFrame:
    """Uplift listed numeric columns by the base factor (F-12)."""
    cols = _load(columns) or []
    types = {f.name: f.dataType for f in df.schema.fields}
    return _replace(df, {c: codes.uplift(F.col(c)) for c in cols
                         if c in types and types[c].typeName() in
                         ("double", "float", "integer", "long", "short", "decimal")})


def value_mapping(df: DataFrame, config) -> DataFrame:
    """``{column: {target: [sources]}}`` (F-14)."""
    cfg = _load(config) or {}
    return _replace(df, {c: codes.unify_values(F.col(c), m) for c, m in cfg.items() if c in df.columns})


def remove_duplicates(df: DataFrame) -> DataFrame:
    """Whole-row de-duplication over the whole load (AG-10).

    A first pass counts 128-bit digests of the rows, 16 bytes a row with partial
    sums.  Only rows whose digest comes more than once are shuffled and compared
    as a whole, after partial grouping, so a row that repeats without end is
    reduced before the shuffle; all others stay where they are.
    """
    names = [F.col(f"`{c}`") for c in df.columns]
    # NULLs leave a hash as it is, so which columns are NULL is hashed as well.
    first = F.xxhash64(*names, *[c.isNull() for c in names])
    second = F.xxhash64(F.lit("second"), *[c.isNull() for c in names], *names)
    digests = df.select(first.alias("_d1"), second.alias("_d2")).groupBy("_d1", "_d2").agg(F.count("*").alias("n"))
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/dedup-{uuid.uuid4().hex}"
    digests.filter("n > 1").select("_d1", "_d2").write.parquet(path)
    repeated = df.sparkSession.read.schema("_d1 long, _d2 long").parquet(path)
    if repeated.isEmpty():
        return df
    marked = df.withColumns({"_d1": first, "_d2": second})
    once = marked.join(repeated, ["_d1", "_d2"], "left_anti").select(*names)
    return once.unionByName(marked.join(repeated, ["_d1", "_d2"], "left_semi").select(*names).dropDuplicates())


def bronze_clean(df: DataFrame) -> DataFrame:
    """Bronze write cleaning: blank/NUL strings -> NULL, then UUID upper-casing
    of every string (F-02, F-01); NaN floats -> NULL (F-03)."""
    exprs = {c: text.uuid_upper(text.null_if_blank_or_nul(F.col(c))) for c in string_columns(df)}
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            exprs[f.name] = codes.nan_to_null(F.col(f.name))
    return _replace(df, exprs)


@dataclass
class SilverSteps:
    """The silver config row's step columns (names as in the reference)."""
    case_unification: object = None
    is_datetime_formatting: object = None
    is_post_2015_filter: bool = False
    extract_key: str | None = None
    is_json_xml_flatten: object = None
    is_add_indicator: object = None
    is_join_enrichment: object = None
    is_country_code_unification: object = None
    is_null_handling: bool = False
    is_index_partition: bool = False
    index_order: list = field(default_factory=list)
    is_string_trimming: bool = False
    is_currency_standardization: object = None
    geographic_enrichment: bool = False
    base_currency: bool = False
    column_name: str | None = None
    value_mapping_unification: object = None
    is_duplicate_check: bool = False


def silver_transform(df: DataFrame, s: SilverSteps, run_type: str = "DELTA",
                     lookups: dict | None = None) -> DataFrame:
    """All configured steps in the reference's order.

    DELTA applies the business cut-off third; FULL applies it last, after
    de-duplication (section 3.2 of the survey).  ``lookups`` (name ->
    DataFrame) turns on the optional join-enrichment fill (JN-12).
    """
    from strata.operators.rowindex import row_index

    delta = run_type.upper() == "DELTA"
    if s.case_unification:
        df = case_unification(df, s.case_unification)
    if s.is_datetime_formatting:
        df = datetime_formatting(df, s.is_datetime_formatting)
    if delta and s.is_post_2015_filter:
        df = post_cutoff_filter(df, s.extract_key)
    if s.is_json_xml_flatten:
        df = flatten_semistructured(df, s.is_json_xml_flatten)
    df = add_placeholders(df, s.is_add_indicator, s.is_join_enrichment)
    if lookups and s.is_join_enrichment:
        df = join_enrichment(df, s.is_join_enrichment, lookups)
    if s.is_country_code_unification:
        df = country_code_unification(df, s.is_country_code_unification)
    if s.is_null_handling:
        df = null_handling(df)
    if s.is_index_partition and s.index_order:
        df = row_index(df, s.index_order)
    if s.is_string_trimming:
        df = string_trimming(df)
    if s.is_currency_standardization:
        df = currency_standardization(df, s.is_currency_standardization)
    if s.geographic_enrichment:
        df = geographic_enrichment(df)
    if s.base_currency and s.column_name:
        df = base_currency(df, s.column_name)
    if s.value_mapping_unification:
        df = value_mapping(df, s.value_mapping_unification)
    if s.is_duplicate_check:
        df = remove_duplicates(df)
    if not delta and s.is_post_2015_filter:
        df = post_cutoff_filter(df, s.extract_key)
    return df


def join_enrichment(df: DataFrame, config, lookups: dict[str, DataFrame]) -> DataFrame:
    """Optional fill of the join-enrichment columns (JN-12, an extension).

    The reference only adds these columns as NULL placeholders (FP-14, the
    default).  With ``lookups`` given, each config entry ``{"table": name,
    "on": [[left, right], ...], "selected_columns": [{"column", "alias"}]}``
    becomes a left join; adaptive execution broadcasts the lookup when its
    measured size is small and shuffles both sides otherwise.
    """
    cfg = _load(config) or {}
    for j in cfg.get("joins", []) or []:
        table = lookups.get(j.get("table"))
        if table is None:
            continue
        pairs = j.get("on") or []
        sel = j.get("selected_columns") or []
        right = table.select(*[F.col(r).alias(f"__k{i}") for i, (_, r) in enumerate(pairs)],
                             *[F.col(s["column"]).alias(s.get("alias") or s["column"]) for s in sel])
        cond = None
        for i, (left, _) in enumerate(pairs):
            c = df[left] == right[f"__k{i}"]
            cond = c if cond is None else cond & c
        df = df.drop(*[s.get("alias") or s["column"] for s in sel if (s.get("alias") or s["column"]) in df.columns])
        df = df.join(right, cond, "left").drop(*[f"__k{i}" for i in range(len(pairs))])
    return df
