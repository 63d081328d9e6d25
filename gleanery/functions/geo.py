"""Distances on the map, column to column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Kilometres in a degree of latitude. Fixed value.
KM_PER_DEGREE = 111.32


def km_per_degree_lon(lat: Column) -> Column:
    return F.lit(KM_PER_DEGREE) * F.cos(F.radians(lat))


def distance_to_bounds(lat: Column, lon: Column, south: Column, west: Column, north: Column, east: Column) -> Column:
    """Kilometres from a point to a box; 0 inside."""
    dy = F.greatest(F.lit(0.0), south - lat, lat - north) * F.lit(KM_PER_DEGREE)
    dx = F.greatest(F.lit(0.0), west - lon, lon - east) * km_per_degree_lon(lat)
    return F.sqrt(dx * dx + dy * dy)
