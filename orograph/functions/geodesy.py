"""WGS84 geodesy as Column expressions: they stay in whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the WGS84 ellipsoid, as terrain tiles use them.
EQUATORIAL_RADIUS = 6378137.0
POLAR_RADIUS = 6356752.3142
ECCENTRICITY_SQUARED = 6.69437999014e-3
DEGREE = 0.017453292519943296

Vector = tuple[Column, Column, Column]


def prime_vertical_radius(lat: Column) -> Column:
    """Radius of curvature in the prime vertical, at a latitude in degrees."""
    s = F.sin(lat * DEGREE)
    return EQUATORIAL_RADIUS / F.sqrt(1.0 - ECCENTRICITY_SQUARED * s * s)


def ecef(lon: Column, lat: Column, h: Column) -> Vector:
    """Earth-centred coordinates of degrees and metres."""
    v = prime_vertical_radius(lat)
    ring = (v + h) * F.cos(lat * DEGREE)
    return ring * F.cos(lon * DEGREE), ring * F.sin(lon * DEGREE), (v * (1.0 - ECCENTRICITY_SQUARED) + h) * F.sin(lat * DEGREE)


def geodetic(x: Column, y: Column, z: Column, rounds: int = 3) -> Vector:
    """Degrees and height of earth-centred coordinates: Bowring's parametric latitude, iterated."""
    p = F.sqrt(x * x + y * y)
    b_a = (1.0 - ECCENTRICITY_SQUARED) ** 0.5
    second = ECCENTRICITY_SQUARED / (1.0 - ECCENTRICITY_SQUARED)
    beta = F.atan2(z, p * b_a)
    lat = beta
    for _ in range(rounds):
        s, c = F.sin(beta), F.cos(beta)
        lat = F.atan2(z + second * EQUATORIAL_RADIUS * b_a * s * s * s, p - ECCENTRICITY_SQUARED * EQUATORIAL_RADIUS * c * c * c)
        beta = F.atan2(b_a * F.sin(lat), F.cos(lat))
    s, c = F.sin(lat), F.cos(lat)
    h = p * c + z * s - EQUATORIAL_RADIUS * F.sqrt(1.0 - ECCENTRICITY_SQUARED * s * s)
    return F.degrees(F.atan2(y, x)), F.degrees(lat), h


def surface_normal(lon: Column, lat: Column) -> Vector:
    """Unit normal of the ellipsoid."""
    return F.cos(lat * DEGREE) * F.cos(lon * DEGREE), F.cos(lat * DEGREE) * F.sin(lon * DEGREE), F.sin(lat * DEGREE)


def enu_frame(lon: Column, lat: Column, h: Column) -> Column:
    """Column-major 4 x 4 matrix of the east, north, up axes at a point and the point itself."""
    up, at = surface_normal(lon, lat), ecef(lon, lat, h)
    east = (-F.sin(lon * DEGREE), F.cos(lon * DEGREE), F.lit(0.0))
    north = cross(up, east)
    zero, one = F.lit(0.0), F.lit(1.0)
    return F.array(*east, zero, *north, zero, *up, zero, *at, one)


def latitude_distance(low: Column, high: Column) -> Column:
    """Metres between two latitudes in degrees, by the mean of their radii."""
    return (prime_vertical_radius(low) + prime_vertical_radius(high)) / 2.0 * ((high - low) * DEGREE)


def longitude_distance(lat: Column, low: Column, high: Column) -> Column:
    """Metres between two longitudes along a parallel."""
    return prime_vertical_radius(lat) * F.cos(lat * DEGREE) * ((high - low) * DEGREE)


def latitude_angle(low: Column, metres: Column) -> Column:
    """Degrees of latitude that so many metres go north from a latitude."""
    return F.degrees(metres / prime_vertical_radius(low))


def longitude_angle(lat: Column, metres: Column) -> Column:
    """Degrees of longitude that so many metres go east along a parallel."""
    return F.degrees(metres / (prime_vertical_radius(lat) * F.cos(lat * DEGREE)))


def mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    """EPSG:3857 metres of degrees."""
    return lon * DEGREE * EQUATORIAL_RADIUS, F.log(F.tan(F.lit(0.7853981633974483) + lat * (DEGREE / 2))) * EQUATORIAL_RADIUS


def from_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    return F.degrees(x / EQUATORIAL_RADIUS), F.degrees(F.atan(F.sinh(y / EQUATORIAL_RADIUS)))


def cross(a: Vector, b: Vector) -> Vector:
    return a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]


def dot(a: Vector, b: Vector) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def minus(a: Vector, b: Vector) -> Vector:
    return a[0] - b[0], a[1] - b[1], a[2] - b[2]


def length(a: Vector) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Vector) -> Vector:
    """a at length 1; null for the zero vector."""
    n = F.nullif(length(a), F.lit(0.0))
    return a[0] / n, a[1] / n, a[2] / n
