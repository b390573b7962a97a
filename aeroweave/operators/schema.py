"""Choosing, renaming and typing columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroweave.functions.numeric import nan_to_null
from aeroweave.plans.quantiles import exact_quantiles, quantile_name
from aeroweave.plans.small import attach_scalars, broadcast_if_small

SEQ = "_seq"


def select_available(df: DataFrame, cols) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select(*[c for c in cols if c in df.columns])


def drop_columns(df: DataFrame, cols) -> DataFrame:
    return df.drop(*cols)


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def filter_city(df: DataFrame, city_key: str) -> DataFrame:
    return df.filter(F.col("city_key") == city_key)


def filter_in_set(df: DataFrame, members: DataFrame, on: str = "city_key") -> DataFrame:
    """Rows whose ``on`` value occurs in ``members``."""
    return df.join(broadcast_if_small(members.select(on).distinct()), on, "left_semi")


def complete_cases(df: DataFrame, cols) -> DataFrame:
    return df.dropna(subset=list(cols))


def constant_columns(df: DataFrame, values: dict) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def drop_sparse_columns(df: DataFrame, cols, max_null_share: float = 0.3) -> DataFrame:
    """Drop listed columns with too many nulls; fill the others with their median.

    Which columns remain depends on the data, so one aggregate row is read first.
    """
    present = [c for c in cols if c in df.columns]
    if not present:
        return df
    counts = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in present]
    ).first()
    rows = counts["_rows"]
    sparse = [c for c in present if rows and counts[c] / rows > max_null_share]
    gaps = [c for c in present if c not in sparse and counts[c]]
    kept = df.drop(*sparse)
    if not gaps:
        return kept
    medians = exact_quantiles(kept, gaps, [0.5])
    filled = attach_scalars(kept, medians).withColumns(
        {c: F.coalesce(F.col(c), F.col(quantile_name(c, 0.5))) for c in gaps}
    )
    return filled.select(*kept.columns)


def fill_zero(df: DataFrame, cols=None) -> DataFrame:
    """Nulls of numeric columns become 0; text is left alone."""
    return df.fillna(0, subset=list(cols) if cols is not None else None)


def median_fill(df: DataFrame, cols) -> DataFrame:
    return drop_sparse_columns(df, cols, max_null_share=1.0)


def with_seq(df: DataFrame) -> DataFrame:
    """Make sure there is a ``_seq`` order column: which row came first can't be told without one."""
    if SEQ not in df.columns:
        raise ValueError(f"the feed has no {SEQ} column; read it with source_order=True or bring one along")
    return df


def ensure_datetime(df: DataFrame) -> DataFrame:
    """``datetime`` as a naive timestamp, taken from ``date`` when it is missing."""
    source = next((c for c in ("datetime", "date") if c in df.columns), None)
    if source is None:
        raise ValueError("no datetime or date column found")
    return df.withColumn("datetime", F.col(source).cast("timestamp_ntz"))


def cast_feed(df: DataFrame, feed: str) -> DataFrame:
    """Types of a feed: naive ``datetime``, ``date``, ``hour``, doubles without NaN, flags.

    ``date`` and ``hour`` are derived when a feed lacks them. A missing traffic flag counts
    as true, the way a missing value casts to a boolean in the array world.
    """
    df = ensure_datetime(df)
    casts = {
        "date": F.to_date(F.col("date") if "date" in df.columns else F.col("datetime")),
        "hour": (F.col("hour") if "hour" in df.columns else F.hour("datetime")).cast("int"),
    }
    if feed == "traffic":
        known = "day_of_week" in df.columns
        casts["day_of_week"] = (F.col("day_of_week") if known else F.weekday("datetime")).cast("int")
        for flag in ("is_rush_hour", "is_weekend", "is_holiday"):
            if flag in df.columns:
                casts[flag] = F.coalesce(F.col(flag).cast("boolean"), F.lit(True))
    for name, kind in df.dtypes:
        if kind in ("double", "float") and name not in casts:
            casts[name] = nan_to_null(F.col(name).cast("double"))
    return df.withColumns(casts)


def coerce_types(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Cast columns; values that do not parse become null instead of failing."""
    return df.withColumns({
        name: F.col(name).cast("string").try_cast(kind) for name, kind in spec.items() if name in df.columns
    })


def float_downcast(df: DataFrame) -> DataFrame:
    """Doubles to floats. Opt-in: it moves values such as 0.3 across bin edges."""
    return df.withColumns({c: F.col(c).cast("float") for c, kind in df.dtypes if kind == "double"})


def objects_to_string(df: DataFrame) -> DataFrame:
    """Nested columns to JSON text, dates to ISO text, for sinks that know neither."""
    texts = {}
    for name, kind in df.dtypes:
        if kind.startswith(("array", "map", "struct")):
            texts[name] = F.to_json(name)
        elif kind == "date":
            texts[name] = F.col(name).cast("string")
    return df.withColumns(texts) if texts else df
