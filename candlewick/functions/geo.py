"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Earth radius in miles and kilometres per mile.
EARTH_RADIUS_MILES = 3961
KM_PER_MILE = 1.60934


def haversine_distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column, unit: str = "mi") -> Column:
    if unit not in ("mi", "km"):
        raise ValueError(f"unit must be 'mi' or 'km', not {unit!r}")
    half_chord = F.pow(F.sin(F.radians((lat2 - lat1) / 2)), 2) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(F.radians((lon2 - lon1) / 2)), 2)
    # Rounding can push the root of near-antipodal points just above 1, where asin is undefined.
    miles = 2 * EARTH_RADIUS_MILES * F.asin(F.least(F.lit(1.0), F.sqrt(half_chord)))
    return miles if unit == "mi" else miles * KM_PER_MILE
