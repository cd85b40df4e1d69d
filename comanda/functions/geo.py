"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlon = F.radians(lon2 - lon1) / 2
    chord = F.pow(F.sin(half_dlat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_dlon), 2)
    return F.atan2(F.sqrt(chord), F.sqrt(1 - chord)) * (2 * EARTH_RADIUS_KM)


def curve(lat: Column, lon: Column, bits: int = 16) -> Column:
    """Place on a curve that fills the map (Z order): cells of 180 / 2^bits degrees by twice that, bits of both interleaved.

    Places that are near on the curve are near on the map; the upper bits of two places tell their common cell.
    """
    def spread(degrees: Column, span: int) -> Column:
        cell = F.least(F.floor((degrees + span / 2) / span * (1 << bits)), F.lit((1 << bits) - 1)).cast("bigint")
        x = F.greatest(cell, F.lit(0).cast("bigint"))
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            x = (x.bitwiseOR(F.shiftleft(x, shift))).bitwiseAND(F.lit(mask))
        return x

    return F.shiftleft(spread(lat, 180), 1).bitwiseOR(spread(lon, 360))
