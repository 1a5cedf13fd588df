"""Geographic expressions on WGS84 degrees."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from regionlake import config as C
from regionlake.functions.cleaning import col

# WGS84 semi-major axis and squared eccentricity.
WGS84_A = 6378137.0
WGS84_E2 = 0.0066943799901413165


def ellipsoid_distance_m(lat, lon, lat0: float, lon0: float) -> Column:
    """Metres to a fixed centre along the ellipsoid.

    Uses the two radii of curvature at the middle latitude, which is exact to
    well under a millimetre per kilometre over the few kilometres a radius query
    spans.
    """
    phi = F.radians((col(lat) + F.lit(lat0)) / F.lit(2.0))
    d_lat = F.radians(col(lat) - F.lit(lat0))
    d_lon = F.radians(col(lon) - F.lit(lon0))
    w = F.lit(1.0) - F.lit(WGS84_E2) * F.sin(phi) * F.sin(phi)
    meridian = F.lit(WGS84_A * (1.0 - WGS84_E2)) / (w * F.sqrt(w))
    normal = F.lit(WGS84_A) / F.sqrt(w)
    north = meridian * d_lat
    east = normal * F.cos(phi) * d_lon
    return F.sqrt(north * north + east * east)


def radius_box(lat0: float, lon0: float, radius_m: float) -> C.Box:
    """Degrees box that contains every point within the radius, with a margin."""
    margin = radius_m * 1.01
    d_lat = margin / 110_500.0
    steepest = min(abs(lat0) + d_lat, 89.9)
    d_lon = margin / (111_300.0 * math.cos(math.radians(steepest)))
    return C.Box(lat0 - d_lat, lat0 + d_lat, lon0 - d_lon, lon0 + d_lon)


def grid_region(lat, lon, box: C.Box = C.GRID_BOX, columns=C.GRID_COLUMNS) -> Column:
    """Region of a point from a coarse grid of longitude columns and latitude steps."""
    lat, lon = col(lat), col(lon)

    def column_choice(steps, default):
        return F.coalesce(*[F.when(lat > low, F.lit(region)) for low, region in steps], F.lit(default))

    choices = [
        F.when(F.lit(True) if upper is None else lon < upper, column_choice(steps, default))
        for upper, steps, default in columns
    ]
    inside = (lat > box.lat_min) & (lat < box.lat_max) & (lon > box.lon_min) & (lon < box.lon_max)
    return F.when(inside, F.coalesce(*choices))


def on_segment(x: Column, y: Column, e: Column) -> Column:
    """Is the point on the edge, ends included?"""
    cross = (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])
    return (
        (cross == 0.0)
        & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
        & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
    )


def crosses_ray(x: Column, y: Column, e: Column) -> Column:
    """Does the ray from the point towards growing x cross the edge?"""
    at = F.try_divide((e["x2"] - e["x1"]) * (y - e["y1"]), e["y2"] - e["y1"]) + e["x1"]
    return ((e["y1"] > y) != (e["y2"] > y)) & (x < at)


def strictly_inside(x: Column, y: Column, edges: Column) -> Column:
    """Odd number of crossings and not on the boundary.

    Holes and several parts need no special case: the edges of all rings count.
    """
    crossings = F.size(F.filter(edges, lambda e: crosses_ray(x, y, e)))
    touching = F.exists(edges, lambda e: on_segment(x, y, e))
    return (crossings % 2 == 1) & ~touching
