"""Planar distance used by the geographic signal."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskstream.constants import KM_PER_DEGREE


def equirectangular_km(lat2: Column, lon2: Column, lat1: Column, lon1: Column) -> Column:
    """Equirectangular approximation, ``KM_PER_DEGREE`` km per degree.

    No antimeridian wrap: this is the formula the signal is defined with,
    not a great-circle distance.
    """
    dy = (lat2 - lat1) * KM_PER_DEGREE
    dx = (lon2 - lon1) * KM_PER_DEGREE * F.abs(F.cos(F.radians((lat2 + lat1) / 2)))
    return F.sqrt(F.pow(dy, 2) + F.pow(dx, 2))
