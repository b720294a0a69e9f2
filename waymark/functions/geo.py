"""Geodesy as column expressions: WGS84 geodetic, ECEF and local east-north-up metres."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: WGS84 semi-major axis (m) and flattening.
A = 6378137.0
FLATTENING = 1 / 298.257223563
E2 = FLATTENING * (2 - FLATTENING)
B = A * (1 - FLATTENING)
EP2 = (A * A - B * B) / (B * B)


def ecef(lat: Column, lon: Column, alt: Column) -> tuple[Column, Column, Column]:
    """Geodetic degrees and metres to earth-centred metres; a null altitude is 0."""
    phi, lam, h = F.radians(lat), F.radians(lon), F.coalesce(alt, F.lit(0.0))
    n = F.lit(A) / F.sqrt(1 - F.lit(E2) * F.sin(phi) * F.sin(phi))
    return (n + h) * F.cos(phi) * F.cos(lam), (n + h) * F.cos(phi) * F.sin(lam), (n * (1 - E2) + h) * F.sin(phi)


def _origin(lat: float, lon: float, alt: float) -> tuple[float, float, float]:
    phi, lam = math.radians(lat), math.radians(lon)
    n = A / math.sqrt(1 - E2 * math.sin(phi) ** 2)
    return (n + alt) * math.cos(phi) * math.cos(lam), (n + alt) * math.cos(phi) * math.sin(lam), (n * (1 - E2) + alt) * math.sin(phi)


def enu(lat: Column, lon: Column, alt: Column, origin: tuple[float, float, float]) -> tuple[Column, Column, Column]:
    """East, north, up of a geodetic point about an origin (lat, lon, alt), whose part folds to literals."""
    x0, y0, z0 = _origin(*origin)
    phi, lam = math.radians(origin[0]), math.radians(origin[1])
    x, y, z = ecef(lat, lon, alt)
    dx, dy, dz = x - x0, y - y0, z - z0
    sp, cp, sl, cl = math.sin(phi), math.cos(phi), math.sin(lam), math.cos(lam)
    return (
        F.lit(-sl) * dx + F.lit(cl) * dy,
        F.lit(-sp * cl) * dx - F.lit(sp * sl) * dy + F.lit(cp) * dz,
        F.lit(cp * cl) * dx + F.lit(cp * sl) * dy + F.lit(sp) * dz,
    )


def geodetic(x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    """Earth-centred metres to lat, lon (degrees) and alt, in closed form; on the axis lon is 0."""
    r = F.sqrt(x * x + y * y)
    theta = F.atan2(z * A, r * B)
    s, c = F.sin(theta), F.cos(theta)
    phi = F.atan2(z + F.lit(EP2 * B) * s * s * s, r - F.lit(E2 * A) * c * c * c)
    n = F.lit(A) / F.sqrt(F.greatest(1 - F.lit(E2) * F.sin(phi) * F.sin(phi), F.lit(1e-12)))
    polar = r < 1e-9
    lat = F.when(polar, F.when(z < 0, -90.0).otherwise(90.0)).otherwise(F.degrees(phi))
    lon = F.when(polar, F.lit(0.0)).otherwise(F.degrees(F.atan2(y, x)))
    alt = F.when(polar, F.abs(z) - B).otherwise(r / F.cos(phi) - n)
    return lat, lon, alt


def enu_to_geodetic(e: Column, n: Column, u: Column, origin: tuple[float, float, float]) -> tuple[Column, Column, Column]:
    x0, y0, z0 = _origin(*origin)
    phi, lam = math.radians(origin[0]), math.radians(origin[1])
    sp, cp, sl, cl = math.sin(phi), math.cos(phi), math.sin(lam), math.cos(lam)
    x = F.lit(x0) - F.lit(sl) * e - F.lit(sp * cl) * n + F.lit(cp * cl) * u
    y = F.lit(y0) + F.lit(cl) * e - F.lit(sp * sl) * n + F.lit(cp * sl) * u
    z = F.lit(z0) + F.lit(cp) * n + F.lit(sp) * u
    return geodetic(x, y, z)


def local_xy(lat: Column, lon: Column, lat0: float, lon0: float) -> tuple[Column, Column]:
    """Equirectangular metres about a point: a sphere of the semi-major axis."""
    return F.radians(lon - lon0) * F.lit(A * math.cos(math.radians(lat0))), F.radians(lat - lat0) * F.lit(A)


def y_up(e: Column, n: Column, u: Column) -> tuple[Column, Column, Column]:
    """East-north-up to the axes of a y-up scene: (e, u, -n)."""
    return e, u, -n


def hypot3(dx: Column, dy: Column, dz: Column) -> Column:
    return F.sqrt(dx * dx + dy * dy + dz * dz)
