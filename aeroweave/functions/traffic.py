"""Congestion from speeds, and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Share of free-flow speed lost at full congestion, and the slowest speed
SPEED_LOSS_AT_FULL = 0.7
SLOWEST_KMH = 10.0


def congestion_level(current: Column, free_flow: Column) -> Column:
    """0 = free, 1 = standstill; unknown when either speed is missing or zero."""
    known = (current != 0) & (free_flow != 0)
    return F.when(known, F.lit(1.0) - F.try_divide(current.cast("double"), free_flow.cast("double")))


def traffic_index(current: Column, free_flow: Column) -> Column:
    return congestion_level(current, free_flow) * 100.0


def speed_at(free_flow: Column, congestion: Column) -> Column:
    """Speed expected at a congestion level, never below 10 km/h."""
    speed = free_flow * (F.lit(1.0) - congestion * SPEED_LOSS_AT_FULL)
    return F.when(speed < SLOWEST_KMH, F.lit(SLOWEST_KMH)).otherwise(speed)
