"""Column expressions over coordinates in degrees. The named variants of a formula differ on purpose."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Earth radii, metres a degree, and the constants of the GCJ-02 and BD-09 datums.
MEAN_RADIUS = 6371000.0
AUTHALIC_RADIUS = 6371008.8
METRES_A_DEGREE = 111320.0
GCJ_AXIS, GCJ_ECCENTRICITY = 6378245.0, 0.00669342162296594323
CHINA = (72.004, 137.8347, 0.8293, 55.8271)
WGS84_AXIS, WGS84_FLATTENING = 6378137.0, 1 / 298.257223563
BD_PI = math.pi * 3000.0 / 180.0
POINTS = ("N", "NE", "E", "SE", "S", "SW", "W", "NW")


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = MEAN_RADIUS) -> Column:
    """Great-circle metres; the chord is clamped so that antipodes do not fail."""
    half_lat, half_lon = F.sin(F.radians(lat2 - lat1) / 2), F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2 * radius) * F.asin(F.least(F.lit(1.0), F.sqrt(chord)))


def bearing(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Initial great-circle bearing, 0 to 360."""
    d = F.radians(lon2 - lon1)
    y = F.sin(d) * F.cos(F.radians(lat2))
    x = F.cos(F.radians(lat1)) * F.sin(F.radians(lat2)) - F.sin(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.cos(d)
    return F.pmod(F.degrees(F.atan2(y, x)) + 360.0, F.lit(360.0))


def compass8(angle: Column) -> Column:
    index = F.pmod(F.floor((angle + 22.5) / 45.0), F.lit(8)).cast("int")
    return F.element_at(F.array(*[F.lit(p) for p in POINTS]), index + 1)


def angle_diff(a: Column, b: Column) -> Column:
    """Unsigned, at most 180."""
    d = F.pmod(F.abs(a - b), F.lit(360.0))
    return F.least(d, F.lit(360.0) - d)


def along_axis(angle: Column, axis: Column, tolerance: float = 20.0) -> Column:
    """Whether two undirected lines agree."""
    d = F.pmod(F.abs(angle - axis), F.lit(180.0))
    return F.least(d, F.lit(180.0) - d) <= tolerance


def offset(lat: Column, lon: Column, angle: Column, metres: Column) -> tuple[Column, Column]:
    """A point so many metres away on a local plane."""
    north, east = metres * F.cos(F.radians(angle)), metres * F.sin(F.radians(angle))
    return lat + north / METRES_A_DEGREE, lon + east / (METRES_A_DEGREE * F.cos(F.radians(lat)))


def bbox(lat: Column, lon: Column, radius: Column) -> list[Column]:
    """west, south, east, north."""
    dlat, dlon = radius / METRES_A_DEGREE, radius / (METRES_A_DEGREE * F.greatest(F.cos(F.radians(lat)), F.lit(0.01)))
    return [lon - dlon, lat - dlat, lon + dlon, lat + dlat]


def in_china(lon: Column, lat: Column) -> Column:
    west, east, south, north = CHINA
    return (lon >= west) & (lon <= east) & (lat >= south) & (lat <= north)


def _waves(*terms: tuple[float, Column]) -> Column:
    total = F.lit(0.0)
    for size, angle in terms:
        total = total + F.lit(size) * F.sin(angle)
    return total * (2.0 / 3.0)


def gcj02(lon: Column, lat: Column) -> tuple[Column, Column]:
    """WGS84 to GCJ-02 (lon, lat); points outside the datum's box stay."""
    # The datum's published polynomial and wave coefficients.
    x, y, pi = lon - 105.0, lat - 35.0, F.lit(math.pi)
    ripple = _waves((20.0, x * 6.0 * pi), (20.0, x * 2.0 * pi))
    north = (
        F.lit(-100.0) + x * 2.0 + y * 3.0 + y * y * 0.2 + x * y * 0.1 + F.sqrt(F.abs(x)) * 0.2 + ripple
        + _waves((20.0, y * pi), (40.0, y / 3.0 * pi)) + _waves((160.0, y / 12.0 * pi), (320.0, y * pi / 30.0))
    )
    east = (
        F.lit(300.0) + x + y * 2.0 + x * x * 0.1 + x * y * 0.1 + F.sqrt(F.abs(x)) * 0.1 + ripple
        + _waves((20.0, x * pi), (40.0, x / 3.0 * pi)) + _waves((150.0, x / 12.0 * pi), (300.0, x / 30.0 * pi))
    )
    sine = F.sin(F.radians(lat))
    flat = F.lit(1.0) - sine * sine * GCJ_ECCENTRICITY
    dlat = north * 180.0 / (F.lit(GCJ_AXIS * (1 - GCJ_ECCENTRICITY)) / (flat * F.sqrt(flat)) * pi)
    dlon = east * 180.0 / (F.lit(GCJ_AXIS) / F.sqrt(flat) * F.cos(F.radians(lat)) * pi)
    inside = in_china(lon, lat)
    return F.when(inside, lon + dlon).otherwise(lon), F.when(inside, lat + dlat).otherwise(lat)


def bd09(lon: Column, lat: Column) -> tuple[Column, Column]:
    """GCJ-02 to BD-09 (lon, lat)."""
    z = F.hypot(lon, lat) + F.sin(lat * BD_PI) * 0.00002
    turn = F.atan2(lat, lon) + F.cos(lon * BD_PI) * 0.000003
    return z * F.cos(turn) + 0.0065, z * F.sin(turn) + 0.006


def bd09_inverse(lon: Column, lat: Column) -> tuple[Column, Column]:
    """BD-09 to GCJ-02 (lon, lat)."""
    x, y = lon - 0.0065, lat - 0.006
    z = F.hypot(x, y) - F.sin(y * BD_PI) * 0.00002
    turn = F.atan2(y, x) - F.cos(x * BD_PI) * 0.000003
    return z * F.cos(turn), z * F.sin(turn)


def gcj02_inverse(lon: Column, lat: Column, rounds: int = 12) -> tuple[Column, Column]:
    """WGS84 of a shifted place, by taking the shift of the last guess off again; unchanged outside the box."""

    def closer(at: Column, _: Column) -> Column:
        x, y = gcj02(at[0], at[1])
        return F.array(at[0] - (x - lon), at[1] - (y - lat))

    found = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), F.array(lon, lat), closer)
    inside = in_china(lon, lat)
    return F.when(inside, found[0]).otherwise(lon), F.when(inside, found[1]).otherwise(lat)


def planar_bearing(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Degrees from north on the plane at the mean latitude, from -180 to 180."""
    east = (lon2 - lon1) * F.cos(F.radians((lat1 + lat2) / 2.0))
    return F.degrees(F.atan2(east, lat2 - lat1))


METRES_A_MILE = 1609.344


def in_unit(metres: Column, unit: str) -> Column:
    return metres / {"m": 1.0, "km": 1000.0, "mile": METRES_A_MILE}[unit]


def point_of_wkt(text: Column) -> tuple[Column, Column]:
    """Longitude and latitude of the first POINT of a text; null where there is none or it is off the globe."""
    number = r"(-?[0-9]+(?:\.[0-9]+)?)"
    pattern = rf"(?i)POINT\s*\(\s*{number}\s+{number}\s*\)"
    lon, lat = (F.nullif(F.regexp_extract(text, pattern, i), F.lit("")).cast("double") for i in (1, 2))
    on_globe = lon.between(-180, 180) & lat.between(-90, 90)
    return F.when(on_globe, lon), F.when(on_globe, lat)


def wkt_of_box(west: Column, south: Column, east: Column, north: Column) -> Column:
    corners = [(west, south), (east, south), (east, north), (west, north), (west, south)]
    pairs = [F.concat_ws(" ", x.cast("string"), y.cast("string")) for x, y in corners]
    return F.concat(F.lit("POLYGON(("), F.concat_ws(",", *pairs), F.lit("))"))


def point_in_ring(lon: Column, lat: Column, ring: Column) -> Column:
    """Parity of crossings of a closed ring (array of struct lon, lat); the boundary is undefined."""
    edges = F.arrays_zip(
        F.slice(ring, F.lit(1), F.size(ring) - 1).alias("p"), F.slice(ring, F.lit(2), F.size(ring) - 1).alias("q")
    )

    def crossing(e: Column) -> Column:
        p, q = e["p"], e["q"]
        straddles = (p["lat"] > lat) != (q["lat"] > lat)
        at = (q["lon"] - p["lon"]) * (lat - p["lat"]) / F.nullif(q["lat"] - p["lat"], F.lit(0.0)) + p["lon"]
        return F.when(straddles & (lon < at), 1).otherwise(0)

    return F.aggregate(F.transform(edges, crossing), F.lit(0), lambda a, b: a + b) % 2 == 1


def segment_crossing(ax, ay, bx, by, cx, cy, dx, dy) -> Column:
    """Point (x, y) where segments a-b and c-d cross; null if parallel or apart."""
    det = (bx - ax) * (dy - cy) - (by - ay) * (dx - cx)
    safe = F.when(F.abs(det) >= 1e-9, det)
    t = ((cx - ax) * (dy - cy) - (cy - ay) * (dx - cx)) / safe
    u = ((cx - ax) * (by - ay) - (cy - ay) * (bx - ax)) / safe
    hit = t.between(0, 1) & u.between(0, 1)
    return F.when(hit, F.struct((ax + t * (bx - ax)).alias("x"), (ay + t * (by - ay)).alias("y")))


def segment_distance(px, py, ax, ay, bx, by) -> Column:
    """Planar distance of a point from a segment."""
    size = (bx - ax) * (bx - ax) + (by - ay) * (by - ay)
    t = F.when(size > 0, ((px - ax) * (bx - ax) + (py - ay) * (by - ay)) / size).otherwise(0.0)
    t = F.least(F.lit(1.0), F.greatest(F.lit(0.0), t))
    return F.hypot(px - (ax + t * (bx - ax)), py - (ay + t * (by - ay)))


def cell(lat: Column, lon: Column, degrees: float) -> tuple[Column, Column]:
    """Row and column of a grid of square cells."""
    return F.floor(lat / degrees).cast("long"), F.floor(lon / degrees).cast("long")


def far_geodesic(sin_u, cos_u, sin_v, cos_v, apart, flattening: float):
    """Direction at either end and the arc's terms (arc, middle, squared sine of its slope) between places almost opposite.

    The first direction is halved in on until the line's end is ``apart`` (radians of longitude): seen from the place
    farther from the equator, moved to the south, that longitude grows with the direction. Exact opposites meet over a pole.
    """
    swapped = np.abs(sin_u) < np.abs(sin_v)
    (s1, s2), (c1, c2) = (np.where(swapped, y, x) for x, y in ((sin_u, sin_v), (sin_v, sin_u))), (np.where(swapped, y, x) for x, y in ((cos_u, cos_v), (cos_v, cos_u)))
    south = np.where(s1 > 0, -1.0, 1.0)
    s1, s2, east = np.minimum(s1 * south, -1e-300), s2 * south, np.where(apart < 0, -1.0, 1.0)

    def line(a):
        slope, cos_a = c1 * np.sin(a), np.cos(a)
        cos_b = np.sqrt(np.maximum(cos_a**2 * c1**2 + (c2 - c1) * (c2 + c1), 0.0)) / c2
        first, last = np.arctan2(s1, cos_a * c1), np.arctan2(s2, cos_b * c2)
        turned = np.arctan2(slope * np.sin(last), np.cos(last)) - np.arctan2(slope * np.sin(first), np.cos(first))
        arc, middle, squared = last - first, np.cos(first + last), 1 - slope**2
        c = flattening / 16 * squared * (4 + flattening * (4 - 3 * squared))
        less = (1 - c) * flattening * slope * (arc + c * np.sin(arc) * (middle + c * np.cos(arc) * (2 * middle**2 - 1)))
        return turned - less, arc, middle, squared, np.arctan2(slope / c2, cos_b)

    low, high = np.zeros(len(s1)), np.full(len(s1), np.pi)
    for _ in range(60):
        half = (low + high) / 2
        short = line(half)[0] < np.abs(apart)
        low, high = np.where(short, half, low), np.where(short, high, half)
    _, arc, middle, squared, end = line(high)
    ways = [np.where(swapped, end, high), np.where(swapped, high, end)]
    north = np.where(swapped, -south, south)
    forward, last = (np.degrees(np.arctan2(east * np.sin(x), north * np.cos(x))) % 360.0 for x in ways)
    return forward, last, arc, middle, squared


def geodesic(axis: float = WGS84_AXIS, flattening: float = WGS84_FLATTENING, rounds: int = 200):
    """A function of (lat1, lon1, lat2, lon2) giving metres, forward and back azimuth (0 to 360) on an ellipsoid.

    Vincenty's inverse solution, iterated over whole Arrow batches. Equal places are 0 metres apart without azimuths;
    near antipodes, where the iteration does not settle, the direction is halved in on (``far_geodesic``). All three are
    null for nulls.
    """

    @F.pandas_udf("metres double, forward double, back double")
    def solve(lat1: pd.Series, lon1: pd.Series, lat2: pd.Series, lon2: pd.Series) -> pd.DataFrame:
        sides = [np.arctan((1 - flattening) * np.tan(np.radians(x.to_numpy(float)))) for x in (lat1, lat2)]
        (sin_u, sin_v), (cos_u, cos_v) = [np.sin(x) for x in sides], [np.cos(x) for x in sides]
        apart = np.radians((lon2.to_numpy(float) - lon1.to_numpy(float) + 540.0) % 360.0 - 180.0)
        turn, settled = apart.copy(), np.zeros(len(apart), bool)
        with np.errstate(all="ignore"):
            for _ in range(rounds):
                sin_t, cos_t = np.sin(turn), np.cos(turn)
                across, along = cos_v * sin_t, cos_u * sin_v - sin_u * cos_v * cos_t
                sin_s, cos_s = np.hypot(across, along), sin_u * sin_v + cos_u * cos_v * cos_t
                arc = np.arctan2(sin_s, cos_s)
                sin_a = np.where(sin_s == 0, 0.0, cos_u * across / sin_s)
                squared = 1 - sin_a**2
                middle = np.where(squared == 0, 0.0, cos_s - 2 * sin_u * sin_v / squared)
                c = flattening / 16 * squared * (4 + flattening * (4 - 3 * squared))
                new = apart + (1 - c) * flattening * sin_a * (arc + c * sin_s * (middle + c * cos_s * (2 * middle**2 - 1)))
                settled, turn = np.abs(new - turn) < 1e-12, new
                if (settled | np.isnan(new)).all():
                    break
            forward = np.degrees(np.arctan2(across, along)) % 360.0
            back = np.degrees(np.arctan2(cos_u * np.sin(turn), cos_u * sin_v * np.cos(turn) - sin_u * cos_v)) % 360.0
            far = ~(settled & (np.abs(turn) <= np.pi)) & ~np.isnan(sin_u + sin_v + apart)
            if far.any():
                forward[far], back[far], arc[far], middle[far], squared[far] = far_geodesic(*[x[far] for x in (sin_u, cos_u, sin_v, cos_v, apart)], flattening)
                sin_s, cos_s = np.where(far, np.sin(arc), sin_s), np.where(far, np.cos(arc), cos_s)
            k = squared * (axis**2 / (axis * (1 - flattening)) ** 2 - 1)
            big_a = 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k)))
            big_b = k / 1024 * (256 + k * (-128 + k * (74 - 47 * k)))
            cubic = big_b / 6 * middle * (4 * sin_s**2 - 3) * (4 * middle**2 - 3)
            arc = arc - big_b * sin_s * (middle + big_b / 4 * (cos_s * (2 * middle**2 - 1) - cubic))
            metres = axis * (1 - flattening) * big_a * arc
        known, moved = far | settled, far | (sin_s > 0)
        columns = {"metres": (metres, known), "forward": (forward, known & moved), "back": ((back + 180.0) % 360.0, known & moved)}
        return pd.DataFrame({name: pd.Series(x).where(keep, None).astype(object) for name, (x, keep) in columns.items()})

    return solve
