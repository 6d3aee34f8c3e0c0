"""Column expressions on a sphere and in a local plane. Angles in degrees, lengths in metres."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Earth radius, and the determinant below which points count as collinear.
EARTH_RADIUS_M = 6371000.0
COLLINEAR_DET = 1e-6


def haversine(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Great-circle distance."""
    phi_a, phi_b = F.radians(lat_a), F.radians(lat_b)
    half_lat = F.sin((phi_b - phi_a) / 2)
    half_lon = F.sin(F.radians(lon_b - lon_a) / 2)
    chord = half_lat * half_lat + F.cos(phi_a) * F.cos(phi_b) * half_lon * half_lon
    return F.lit(2 * EARTH_RADIUS_M) * F.atan2(F.sqrt(chord), F.sqrt(F.lit(1.0) - chord))


def plane_x(lon: Column, lat_origin: Column, lon_origin: Column) -> Column:
    """Metres east of the origin."""
    return F.radians(lon - lon_origin) * F.cos(F.radians(lat_origin)) * F.lit(EARTH_RADIUS_M)


def plane_y(lat: Column, lat_origin: Column) -> Column:
    """Metres north of the origin."""
    return F.radians(lat - lat_origin) * F.lit(EARTH_RADIUS_M)


def circumradius(ax, ay, bx, by, cx, cy) -> Column:
    """Radius of the circle through three points; null when they lie on a line.

    Product of the sides over twice the parallelogram area.
    """
    double_area = (bx - ax) * (cy - ay) - (cx - ax) * (by - ay)
    sides = F.hypot(bx - ax, by - ay) * F.hypot(cx - bx, cy - by) * F.hypot(ax - cx, ay - cy)
    return F.when(F.abs(double_area) >= COLLINEAR_DET, sides / (2 * F.abs(double_area)))


def along(start: Column, end: Column, share: Column) -> Column:
    """The value a share of the way from start to end."""
    return start + (end - start) * share
