"""Distance on the WGS-84 ellipsoid by Lambert's formula for long lines, as a Column expression."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# WGS-84 equatorial radius in km and flattening, and the mean radius of the sphere.
EQUATOR_KM = 6378.137
FLATTENING = 1 / 298.257223563
SPHERE_KM = 6371.0088


def _half_chord_squared(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine of the central angle; all arguments in radians."""
    return F.pow(F.sin((lat2 - lat1) / 2), 2) + F.cos(lat1) * F.cos(lat2) * F.pow(F.sin((lon2 - lon1) / 2), 2)


def _reduced(lat: Column) -> Column:
    return F.atan(F.lit(1 - FLATTENING) * F.tan(F.radians(lat)))


def _lambert(h: Column, z1: Column, z2: Column) -> Column:
    """Distance from the haversine ``h`` of the reduced points and the sines of their latitudes.

    In terms of these the formula's trigonometric factors become sums and square roots:
    sin P cos Q = (z1 + z2) / 2, cos P sin Q = (z2 - z1) / 2, and sin and cos of the half angle are
    the roots of h and 1 - h.
    """
    angle = F.lit(2.0) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))
    sine = F.lit(2.0) * F.sqrt(h * F.greatest(F.lit(0.0), F.lit(1.0) - h))
    x = (angle - sine) * F.pow((z1 + z2) / 2, 2) / (F.lit(1.0) - h)
    y = (angle + sine) * F.pow((z2 - z1) / 2, 2) / h
    near_antipode = math.sin(math.radians(175) / 2) ** 2
    return (
        F.when(h <= 0, F.lit(0.0))
        .when(h < near_antipode, F.lit(EQUATOR_KM) * (angle - F.lit(FLATTENING / 2) * (x + y)))
        .when(h.isNotNull(), F.lit(EQUATOR_KM) * angle)  # ``least`` skips NULL, so it is ruled out here
    )


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Ellipsoidal distance in km; NULL in, NULL out; identical points give 0.

    Differs from the geodesic by centimetres within a city.  The correction terms are singular at the
    antipode, so beyond 175 degrees the uncorrected angle is used.
    """
    b1, b2 = _reduced(lat1), _reduced(lat2)
    h = _half_chord_squared(b1, F.radians(lon1), b2, F.radians(lon2))
    return _lambert(h, F.sin(b1), F.sin(b2))


def unit_vector(lat: str, lon: str, prefix: str, reduced: bool = True) -> dict[str, Column]:
    """Columns x, y, z of a point on the unit sphere; ``lat`` and ``lon`` are SQL expressions.

    Computed once per row ahead of a join, they leave one asin per pair.
    """
    b = f"atan({1 - FLATTENING!r}D * tan(radians({lat})))" if reduced else f"radians({lat})"
    values = {"x": f"cos({b}) * cos(radians({lon}))", "y": f"cos({b}) * sin(radians({lon}))", "z": f"sin({b})"}
    return {prefix + axis: F.expr(text) for axis, text in values.items()}


def _quarter_gap(left: str, right: str) -> Column:
    return F.expr("(" + " + ".join(f"({left}{a} - {right}{a}) * ({left}{a} - {right}{a})" for a in "xyz") + ") / 4")


def vector_distance_km(left: str, right: str) -> Column:
    """Ellipsoidal distance of two points given by the prefixes of their (reduced) unit vectors."""
    return _lambert(_quarter_gap(left, right), F.col(f"{left}z"), F.col(f"{right}z"))


def vector_sphere_km(left: str, right: str) -> Column:
    """Distance on the mean sphere of two points given by the prefixes of their plain unit vectors."""
    return F.lit(2 * SPHERE_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), _quarter_gap(left, right))))
