"""Small fixed dimensions: cities, holidays, column descriptions, unit ranges."""

from aeroweave.dims.cities import CITIES, City, city_aliases, dim_city
from aeroweave.dims.descriptions import DESCRIPTIONS, dim_description
from aeroweave.dims.holidays import (
    dim_holiday,
    dim_traffic_holiday,
    national_holidays,
)
from aeroweave.dims.units import UNIT_RANGES, dim_units

__all__ = [
    "CITIES", "City", "city_aliases", "dim_city",
    "DESCRIPTIONS", "dim_description",
    "dim_holiday", "dim_traffic_holiday", "national_holidays",
    "UNIT_RANGES", "dim_units",
]
