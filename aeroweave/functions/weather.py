"""Felt temperature and other weather-derived measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Heat index coefficients by powers of temperature and humidity
HEAT_INDEX = {
    (0, 0): -8.78469475556,
    (1, 0): 1.61139411,
    (0, 1): 2.33854883889,
    (1, 1): -0.14611605,
    (2, 0): -0.012308094,
    (0, 2): -0.0164248277778,
    (2, 1): 0.002211732,
    (1, 2): 0.00072546,
    (2, 2): -0.000003582,
}

# Wind chill coefficients and where the formula applies
CHILL_CONSTANT, CHILL_TEMPERATURE, CHILL_WIND, CHILL_BOTH, CHILL_EXPONENT = 13.12, 0.6215, -11.37, 0.3965, 0.16
CHILL_BELOW_CELSIUS, CHILL_ABOVE_MS = 10, 1.33

RAIN_THRESHOLD_MM = 0.5

# Directions of the wind, clockwise from north
OCTANTS = ("N", "NE", "E", "SE", "S", "SW", "W", "NW")
KMH_PER_MS = 3.6


def heat_index(temperature: Column, humidity: Column) -> Column:
    total = F.lit(0.0)
    for (t_power, h_power), weight in HEAT_INDEX.items():
        term = F.lit(weight)
        for factor in [temperature] * t_power + [humidity] * h_power:
            term = term * factor
        total = total + term
    return total


def wind_chill(temperature: Column, wind_speed: Column, wind_unit: str = "ms") -> Column:
    """Felt cold below 10 °C in wind above 1.33 m/s, otherwise the temperature.

    ``wind_unit`` names the unit the formula is fed with: ``ms`` passes the speed as it
    is, ``kmh`` converts it as the published formula expects.
    """
    if wind_unit not in ("ms", "kmh"):
        raise ValueError(f"unknown wind unit: {wind_unit}")
    speed = wind_speed * KMH_PER_MS if wind_unit == "kmh" else wind_speed
    powered = F.pow(speed, F.lit(CHILL_EXPONENT))
    felt = (
        F.lit(CHILL_CONSTANT) + CHILL_TEMPERATURE * temperature
        + CHILL_WIND * powered + CHILL_BOTH * temperature * powered
    )
    applies = (temperature < CHILL_BELOW_CELSIUS) & (wind_speed > CHILL_ABOVE_MS)
    return F.when(applies, felt).otherwise(temperature)


def temp_range(highest: Column, lowest: Column) -> Column:
    return highest - lowest


def is_rainy(precipitation: Column) -> Column:
    return precipitation > RAIN_THRESHOLD_MM


def kmh_to_ms(speed: Column) -> Column:
    return speed / F.lit(KMH_PER_MS)


def wind_octant(direction: Column) -> Column:
    """Which of eight directions the wind comes from, N for 337.5 up to 22.5 degrees; any turn counts, null stays null."""
    at = F.pmod(F.floor((direction + F.lit(22.5)) / F.lit(45.0)), F.lit(8)).cast("int")
    return F.get(F.array(*[F.lit(name) for name in OCTANTS]), at)
