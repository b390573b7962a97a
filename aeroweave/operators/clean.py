"""Bronze to silver: typing, gap filling, duplicates, ranges and derived columns per feed."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroweave.functions import calendar
from aeroweave.functions.air import aqi_avg
from aeroweave.functions.numeric import clip_range, outside
from aeroweave.operators.cities import align_cities, common_cities
from aeroweave.operators.fills import fill_and_keep_first
from aeroweave.operators.schema import SEQ, cast_feed, drop_sparse_columns, fill_zero, with_seq
from aeroweave.plans.chunks import TARGET_ROWS

INF = None


class Range(NamedTuple):
    lo: float | None
    hi: float | None
    counted_hi: float | None  # upper bound the outlier counter looks at


class Feed(NamedTuple):
    ranges: dict[str, Range]
    dropped: tuple[str, ...]
    zero_first: tuple[str, ...]
    sparse: tuple[str, ...]
    pollutants: tuple[str, ...]


# Valid ranges, columns to leave out, and columns treated specially.
# Wind and speeds are clipped at the top too, but only values below zero count as outliers.
FEEDS = {
    "weather": Feed(
        ranges={
            "temperature": Range(-40, 50, 50),
            "humidity": Range(0, 100, 100),
            "wind_speed": Range(0, 50, INF),
            "precipitation": Range(0, INF, INF),
        },
        dropped=(), zero_first=("snow",), sparse=("wpgt", "tsun", "dwpt"), pollutants=(),
    ),
    "air_quality": Feed(
        ranges={c: Range(0, 500, 500) for c in ("no2", "pm10", "o3")},
        dropped=("station_name", "station_id"), zero_first=(), sparse=(), pollutants=("no2", "pm10", "o3"),
    ),
    "traffic": Feed(
        ranges={
            "traffic_index": Range(0, 100, 100),
            "congestion_level": Range(0, 1, 1),
            "current_speed": Range(0, 200, INF),
            "free_flow_speed": Range(0, 200, INF),
        },
        dropped=("data_source", "confidence"), zero_first=(), sparse=(), pollutants=(),
    ),
}

# holiday names mark single days and are never carried to other hours
NOT_CARRIED = ("holiday_name",)
NOT_DATA = ("city_key", "datetime", SEQ)


def _typed(df: DataFrame, feed: str) -> DataFrame:
    return cast_feed(with_seq(df), feed)


def _prepared(df: DataFrame, feed: str) -> DataFrame:
    """Casts, fixed replacements and the sparse-column rule."""
    return _repaired(_typed(df, feed), feed)


def _repaired(df: DataFrame, feed: str) -> DataFrame:
    rules = FEEDS[feed]
    fixed = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in rules.zero_first if c in df.columns}
    fixed |= {c: F.coalesce(F.col(c), F.lit("")) for c in NOT_CARRIED if c in df.columns}
    return drop_sparse_columns(df.withColumns(fixed) if fixed else df, rules.sparse)


def _carried(df: DataFrame, feed: str) -> list[str]:
    if feed == "air_quality":
        return [c for c in FEEDS[feed].pollutants if c in df.columns]
    derived = ("date", "hour")
    return [c for c in df.columns if c not in (*NOT_DATA, *NOT_CARRIED, *derived)]


def _filled(prepared: DataFrame, feed: str, target_rows: int, counted: dict[str, str] | None = None) -> DataFrame:
    """Gaps filled per city and one row per city and instant."""
    carried = _carried(prepared.drop(*(counted or {})), feed)
    first = fill_and_keep_first(prepared, carried, target_rows=target_rows, counted=counted)
    return first if feed == "weather" else _zeros(first)


def _zeros(df: DataFrame) -> DataFrame:
    kinds = dict(df.dtypes)
    measures = [c for c in df.columns if c not in NOT_DATA and kinds[c] in ("double", "float", "int", "bigint")]
    return fill_zero(df, measures)


def _ranged(filled: DataFrame, feed: str) -> DataFrame:
    """Clip to valid ranges, leave out columns, derive the silver columns."""
    rules = FEEDS[feed]
    clipped = filled.withColumns(
        {c: clip_range(F.col(c), r.lo, r.hi) for c, r in rules.ranges.items() if c in filled.columns}
    ).drop(*rules.dropped)
    weekday = F.col("day_of_week") if "day_of_week" in filled.columns else calendar.day_of_week(F.col("datetime"))
    derived = {
        "month": F.month("datetime"),
        "is_night": calendar.is_night(F.col("hour")),
        "day_of_week": weekday,
        "is_weekday": calendar.is_weekday(weekday),
    }
    present = [c for c in rules.pollutants if c in clipped.columns]
    if present:
        derived["aqi_avg"] = aqi_avg([F.col(c) for c in present])
    return clipped.withColumns(derived).drop(SEQ)


def _clean(df: DataFrame, feed: str, target_rows: int) -> DataFrame:
    return _ranged(_filled(_prepared(df, feed), feed, target_rows), feed)


def clean_weather(df: DataFrame, target_rows: int = TARGET_ROWS) -> DataFrame:
    """Silver weather: one typed, gap-filled, range-checked row per city and instant."""
    return _clean(df, "weather", target_rows)


def clean_air_quality(df: DataFrame, target_rows: int = TARGET_ROWS) -> DataFrame:
    """Silver air quality; pollutants a city never measured are 0."""
    return _clean(df, "air_quality", target_rows)


def clean_traffic(df: DataFrame, target_rows: int = TARGET_ROWS) -> DataFrame:
    """Silver traffic; numbers a city never reported are 0."""
    return _clean(df, "traffic", target_rows)


CLEANERS = {"weather": clean_weather, "air_quality": clean_air_quality, "traffic": clean_traffic}


def clean_all(weather: DataFrame, air: DataFrame, traffic: DataFrame) -> tuple[DataFrame, ...]:
    """Clean the three feeds and keep the cities they share.

    Cleaning never loses a city, so the shared ones are looked up in the raw feeds.
    """
    cleaned = clean_weather(weather), clean_air_quality(air), clean_traffic(traffic)
    return align_cities(*cleaned, shared=common_cities(weather, air, traffic))


def _sum(parts: list[Column]) -> Column:
    total = F.lit(0)
    for part in parts:
        total = total + F.coalesce(part, F.lit(0))
    return total.cast("bigint")


def clean_metrics(df: DataFrame, feed: str, target_rows: int = TARGET_ROWS) -> DataFrame:
    """One row of counts about cleaning a feed.

    ``outliers_clipped`` counts as the range rules say; ``values_clipped`` counts every
    value that was moved. Nulls of columns dropped as sparse are ``nulls_dropped``.
    """
    rules = FEEDS[feed]
    typed = _typed(df, feed)
    data = [c for c in typed.columns if c not in NOT_DATA]
    # what was known is flagged before anything is repaired, and counted where copies are reduced anyway
    flags = {f"_f_{c}": F.col(c).isNotNull() for c in data} | {"_f_row": F.lit(True)}
    prepared = _repaired(typed.withColumns(flags), feed)
    lost = [c for c in typed.columns if c not in prepared.columns]
    carried = _carried(prepared.drop(*flags), feed)
    reduced = _filled(prepared, feed, target_rows, {f: f"_n{f}" for f in flags})
    checked = {c: r for c, r in rules.ranges.items() if c in reduced.columns}
    per_city = reduced.groupBy("city_key").agg(
        F.sum("_n_f_row").alias("rows"), *[F.sum(f"_n_f_{c}").alias(f"_k_{c}") for c in data],
        F.count("*").alias("_after"),
        *[F.count_if(outside(F.col(c), r.lo, hi)).alias(f"_{kind}_{c}")
          for c, r in checked.items() for kind, hi in (("o", r.counted_hi), ("v", r.hi))])

    # a carried column keeps its nulls only in cities that never knew a value
    nulls = {c: F.col("rows") - F.col(f"_k_{c}") for c in data}
    numeric = {c for c, kind in typed.dtypes if kind in ("double", "int", "bigint")}

    def filled(c: str) -> Column:
        zeroed = feed != "weather" and c in numeric
        always = zeroed or c in rules.zero_first or c in NOT_CARRIED or c in rules.sparse
        if always:
            return nulls[c]
        return F.when(F.col(f"_k_{c}") > 0, nulls[c]) if c in carried else F.lit(0)

    counts = per_city.agg(
        F.sum("rows").alias("rows_before"), F.sum("_after").alias("rows_after"),
        _sum([F.sum(filled(c)) for c in data if c not in lost]).alias("nulls_filled"),
        _sum([F.sum(nulls[c]) for c in lost]).alias("nulls_dropped"),
        _sum([F.sum(f"_o_{c}") for c in checked]).alias("outliers_clipped"),
        _sum([F.sum(f"_v_{c}") for c in checked]).alias("values_clipped"),
    )
    return counts.select(
        F.lit(feed).alias("feed"), F.coalesce("rows_before", F.lit(0)).alias("rows_before"),
        F.coalesce("rows_after", F.lit(0)).alias("rows_after"),
        F.coalesce(F.col("rows_before") - F.col("rows_after"), F.lit(0)).alias("duplicates_removed"),
        "nulls_filled", "nulls_dropped", "outliers_clipped", "values_clipped",
    )
