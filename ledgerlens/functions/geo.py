"""Location columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.functions.numeric import flag

# Fixed values.
EARTH_RADIUS_KM = 6371.0
NAIROBI = (-1.2921, 36.8219)
KENYA_LAT = (-5.0, 5.0)
KENYA_LON = (34.0, 42.0)


def distance_km(lat: Column, lon: Column, to_lat: float = NAIROBI[0], to_lon: float = NAIROBI[1]) -> Column:
    """Great-circle distance by the haversine formula."""
    half_lat = F.radians(lat - F.lit(to_lat)) / F.lit(2.0)
    half_lon = F.radians(lon - F.lit(to_lon)) / F.lit(2.0)
    chord = F.pow(F.sin(half_lat), F.lit(2.0)) + F.cos(F.radians(F.lit(to_lat))) * F.cos(F.radians(lat)) * F.pow(
        F.sin(half_lon), F.lit(2.0)
    )
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.asin(F.sqrt(chord))


def outside_kenya(lat: Column, lon: Column) -> Column:
    return (lat < KENYA_LAT[0]) | (lat > KENYA_LAT[1]) | (lon < KENYA_LON[0]) | (lon > KENYA_LON[1])


def geographic_features() -> dict[str, Column]:
    lat, lon = F.col("location_lat"), F.col("location_lon")
    return {"dist_from_nairobi": distance_km(lat, lon), "is_outside_kenya": flag(outside_kenya(lat, lon))}


def grid_cell() -> dict[str, Column]:
    """Whole-degree cell, halves to even; adding 0.0 folds the two zeros into one key."""
    return {
        "grid_lat": F.bround("location_lat", 0) + F.lit(0.0),
        "grid_lon": F.bround("location_lon", 0) + F.lit(0.0),
    }
