"""Distances and grid cells."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS-84 ellipsoid: equatorial radius in metres, squared eccentricity.
EQUATOR_RADIUS, ECCENTRICITY_SQ = 6378137.0, 0.0066943799901413165

# A degree of latitude is between these many metres; a degree of longitude is at most
# LONGEST_DEGREE * cos(latitude) and at least SHORTEST_EQUATOR_DEGREE * cos(latitude).
SHORTEST_DEGREE, LONGEST_DEGREE, SHORTEST_EQUATOR_DEGREE = 110574.0, 111695.0, 111319.0


def distance_sq(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Squared planar distance in degrees."""
    return (lat1 - lat2) * (lat1 - lat2) + (lon1 - lon2) * (lon1 - lon2)


def distance_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres between near points on the ellipsoid.

    Uses the radii of curvature at the middle latitude: below 1 km it differs from the
    geodesic by far less than a millimetre.
    """
    middle = F.radians((lat1 + lat2) / 2)
    bend = 1 - ECCENTRICITY_SQ * F.sin(middle) * F.sin(middle)
    north = F.lit(EQUATOR_RADIUS * (1 - ECCENTRICITY_SQ)) / (bend * F.sqrt(bend)) * F.radians(lat1 - lat2)
    turn = F.pmod(lon1 - lon2 + 540, F.lit(360.0)) - 180
    east = F.lit(EQUATOR_RADIUS) / F.sqrt(bend) * F.cos(middle) * F.radians(turn)
    return F.sqrt(north * north + east * east)


def geodesic_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column, rounds: int = 12) -> Column:
    """Metres along the ellipsoid between points any distance apart.

    Vincenty's inverse solution with a fixed number of iterations, which is exact to well below
    a metre. Nearly antipodal points, where it does not settle, get the distance on the mean
    sphere, which is within 0.6 % of the geodesic. Null where a coordinate is null.
    """
    flat = 1 - math.sqrt(1 - ECCENTRICITY_SQ)
    short = EQUATOR_RADIUS * (1 - flat)
    u1, u2 = (F.atan((1 - flat) * F.tan(F.radians(lat))) for lat in (lat1, lat2))
    turn = F.radians(F.pmod(lon2 - lon1 + 540, F.lit(360.0)) - 180)
    fixed = F.struct(
        F.sin(u1).alias("s1"), F.cos(u1).alias("c1"), F.sin(u2).alias("s2"), F.cos(u2).alias("c2"), turn.alias("turn")
    )

    def arc(p: Column, lam: Column) -> Column:
        """The spherical arc for a difference of longitude on the auxiliary sphere."""
        along = p["c1"] * p["s2"] - p["s1"] * p["c2"] * F.cos(lam)
        sin_s = F.hypot(p["c2"] * F.sin(lam), along)
        return F.struct(
            sin_s.alias("sin"),
            (p["s1"] * p["s2"] + p["c1"] * p["c2"] * F.cos(lam)).alias("cos"),
            (p["c1"] * p["c2"] * F.sin(lam) / F.greatest(sin_s, F.lit(1e-300))).alias("sin_a"),
        )

    def bent(p: Column, a: Column) -> Column:
        cos2 = F.greatest(1 - a["sin_a"] * a["sin_a"], F.lit(0.0))
        middle = F.when(cos2 > 1e-15, a["cos"] - 2 * p["s1"] * p["s2"] / F.greatest(cos2, F.lit(1e-300))).otherwise(0.0)
        turned = F.atan2(a["sin"], a["cos"])
        return F.struct(
            *[a[c].alias(c) for c in ("sin", "cos", "sin_a")], cos2.alias("cos2"), middle.alias("m"), turned.alias("s")
        )

    def state(p: Column, lam: Column, use) -> Column:
        return _let(arc(p, lam), lambda a: _let(bent(p, a), use))

    def step(p: Column, lam: Column) -> Column:
        def further(b: Column) -> Column:
            c = flat / 16 * b["cos2"] * (4 + flat * (4 - 3 * b["cos2"]))
            bow = b["s"] + c * b["sin"] * (b["m"] + c * b["cos"] * (2 * b["m"] * b["m"] - 1))
            return p["turn"] + (1 - c) * flat * b["sin_a"] * bow

        return state(p, lam, further)

    def length(b: Column) -> Column:
        k = b["cos2"] * (EQUATOR_RADIUS**2 - short**2) / short**2
        big_a = 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k)))
        big_b = k / 1024 * (256 + k * (-128 + k * (74 - 47 * k)))
        m, sin_s = b["m"], b["sin"]
        inner = b["cos"] * (2 * m * m - 1) - big_b / 6 * m * (4 * sin_s * sin_s - 3) * (4 * m * m - 3)
        return F.lit(short) * big_a * (b["s"] - big_b * sin_s * (m + big_b / 4 * inner))

    def solved(p: Column) -> Column:
        lam = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), p["turn"], lambda at, _: step(p, at))

        def answer(at: Column) -> Column:
            settled = (F.abs(step(p, at) - at) < 1e-11) & (F.abs(at) <= math.pi)
            return F.when(settled, state(p, at, length)).otherwise(haversine_m(lat1, lon1, lat2, lon2))

        return _let(lam, answer)

    return _let(fixed, solved)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres on the mean sphere, for points that are far apart."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((p1 - p2) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians(lon1 - lon2) / 2), 2)
    return F.lit(2 * 6371008.8) * F.asin(F.sqrt(F.when(h > 1, F.lit(1.0)).otherwise(h)))


def _cosine_at(degrees: Column) -> Column:
    return F.greatest(F.cos(F.radians(F.least(degrees, F.lit(90.0)))), F.lit(1e-9))


def _cell_id(row: Column, column: Column) -> Column:
    return row.cast("long") * F.lit(1 << 32) + column.cast("long")


def _columns_wide(row: Column, height: float, meters: float) -> Column:
    """How many cells of at least ``meters`` fit round the globe for points next to ``row``."""
    edge = (F.abs(row) + 2) * F.lit(height)
    return F.greatest(
        F.floor(F.lit(360.0 * SHORTEST_EQUATOR_DEGREE / meters) * _cosine_at(edge)), F.lit(1).cast("long")
    )


def reach_cell(lat: Column, lon: Column, meters: float) -> Column:
    """Cell such that any point within ``meters`` lies in one of ``reach_cells`` of the other."""
    height = meters / SHORTEST_DEGREE
    row = F.floor(lat / height)
    count = _columns_wide(row, height, meters)
    return _cell_id(row, F.floor(F.pmod(lon, F.lit(360.0)) / 360 * count) % count)


def reach_cells(lat: Column, lon: Column, meters: float) -> Column:
    """The (at most nine) cells that hold every point within ``meters``."""
    height = meters / SHORTEST_DEGREE
    turn = F.pmod(lon, F.lit(360.0)) / 360
    cells = []
    for up in (-1, 0, 1):
        row = F.floor(lat / height) + up
        count = _columns_wide(row, height, meters)
        column = F.floor(turn * count) % count
        cells += [_cell_id(row, F.pmod(column + side, count)) for side in (-1, 0, 1)]
    return F.array_distinct(F.array(*cells))


def touched_cells(lat: Column, lon: Column, meters: float, side: float) -> Column:
    """The (at most nine) cells ``reach_cell(.., side)`` of all points within ``meters``, of which ``side`` is twice or more."""
    up = F.lit(meters / SHORTEST_DEGREE)
    along = F.lit(meters / SHORTEST_EQUATOR_DEGREE) / _cosine_at(F.abs(lat) + up)
    cells = [reach_cell(lat + up * i, lon + along * j, side) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    return F.array_distinct(F.array(*cells))


def tight_cell(lat: Column, lon: Column, meters: float) -> Column:
    """Cell so small that any two points inside it are less than ``meters`` apart."""
    side = 0.99 * meters / math.sqrt(2)
    height = side / LONGEST_DEGREE
    row = F.floor(lat / height)
    # The edge nearest the equator has the longest degrees of longitude.
    edge = F.least(F.abs(row), F.abs(row + 1)) * F.lit(height)
    width = F.lit(side / LONGEST_DEGREE) / _cosine_at(edge)
    return _cell_id(row, F.floor(lon / width))
