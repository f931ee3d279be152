"""Distances on the globe, and grid cells in the space around it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: earth radius in km.
EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km."""
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    half_dphi = (phi2 - phi1) / 2
    half_dlambda = (F.radians(lon2) - F.radians(lon1)) / 2
    chord = F.pow(F.sin(half_dphi), F.lit(2)) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(half_dlambda), F.lit(2))
    # Rounding can push the sum just over one at opposite points, where asin has no value.
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), chord)))


def unit_vector(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """The point on the unit sphere; straight-line distance there orders as great-circle distance."""
    phi, lam = F.radians(lat), F.radians(lon)
    return F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi)


def cube_cell(depth: int) -> Column:
    """Id of the grid cube of side ``2**-depth`` that holds the point ``x, y, z`` of the unit sphere."""
    step = {axis: f"CAST(floor(({axis} + 1) * {2 ** depth}D) AS BIGINT)" for axis in "xyz"}
    return F.expr(f"shiftleft(shiftleft({step['x']}, 20) + {step['y']}, 20) + {step['z']}")
