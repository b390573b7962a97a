"""Labelled intervals."""

from __future__ import annotations

from math import inf
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Bins(NamedTuple):
    edges: tuple[float, ...]
    labels: tuple[str, ...]


# Interval edges and their labels
WEATHER_CONDITION = Bins((-inf, 5, 20, inf), ("cold", "mild", "warm"))
TRAFFIC_LEVEL_INDEX = Bins((0, 30, 70, 100), ("low", "medium", "high"))
TEMP_CATEGORY = Bins((-50, 0, 10, 20, 50), ("freezing", "cold", "mild", "warm"))
AIR_QUALITY_LEVEL = Bins((0, 25, 50, 100, 500), ("good", "moderate", "unhealthy", "hazardous"))
TRAFFIC_LEVEL_CONGESTION = Bins((0, 0.3, 0.6, 1.0), ("free_flow", "moderate", "congested"))
TRAFFIC_BAND = Bins((0, 20, 40, 60, 80, 100), ("free_flow", "light", "moderate", "heavy", "severe"))


def cut(value: Column, edges, labels, include_lowest: bool = False) -> Column:
    """Right-closed bins: ``edges[i] < value <= edges[i + 1]`` gets ``labels[i]``.

    The lowest edge itself belongs to no bin unless ``include_lowest``; values beyond
    the outer edges, and nulls, have no label.
    """
    if len(edges) != len(labels) + 1:
        raise ValueError("one more edge than labels is needed")
    inside = F.lit(True)
    if edges[0] != -inf:
        lowest = F.lit(float(edges[0]))
        inside = (value >= lowest) if include_lowest else (value > lowest)
    label = F.lit(None).cast("string")
    for upper, name in reversed(list(zip(edges[1:], labels))):
        below = value.isNotNull() if upper == inf else value <= F.lit(float(upper))
        label = F.when(below, F.lit(name)).otherwise(label)
    return F.when(inside, label)


def weather_condition(temperature: Column) -> Column:
    return cut(temperature, *WEATHER_CONDITION)


def traffic_level_index(index: Column, include_lowest: bool = False) -> Column:
    return cut(index, *TRAFFIC_LEVEL_INDEX, include_lowest)


def temp_category(temperature: Column, include_lowest: bool = False) -> Column:
    return cut(temperature, *TEMP_CATEGORY, include_lowest)


def air_quality_level(aqi: Column, include_lowest: bool = False) -> Column:
    return cut(aqi, *AIR_QUALITY_LEVEL, include_lowest)


def traffic_level_congestion(congestion: Column, include_lowest: bool = False) -> Column:
    return cut(congestion, *TRAFFIC_LEVEL_CONGESTION, include_lowest)


def traffic_band(index: Column) -> Column:
    """Documented index bands; zero counts as free flow."""
    return cut(index, *TRAFFIC_BAND, include_lowest=True)
