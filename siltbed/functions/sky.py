"""Where the sun stands, and the shadow that a height casts on a plane, as Column expressions.

The sun's place follows the low-precision almanac formulas (good to about 0.01 degrees from 1950 to 2050), without
refraction.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PARALLEL = 1e-12
#: Degrees of the sun's centre at sunset and the ends of civil, nautical and astronomical twilight.
HORIZONS = {"sunset": -0.833, "civil": -6.0, "nautical": -12.0, "astronomical": -18.0}


def sun_position(unix_seconds: Column, lat: Column, lon: Column) -> tuple[Column, Column]:
    """Elevation and azimuth (clockwise from north) in degrees."""
    days = unix_seconds / 86400.0 - 10957.5  # since noon of 1 January 2000
    anomaly = F.radians(F.lit(357.528) + F.lit(0.9856003) * days)
    mean = F.lit(280.460) + F.lit(0.9856474) * days
    ecliptic = F.radians(mean + F.lit(1.915) * F.sin(anomaly) + F.lit(0.020) * F.sin(anomaly * 2.0))
    tilt = F.radians(F.lit(23.439) - F.lit(0.0000004) * days)
    ascension = F.atan2(F.cos(tilt) * F.sin(ecliptic), F.cos(ecliptic))
    declination = F.asin(F.sin(tilt) * F.sin(ecliptic))
    sidereal = F.lit(18.697374558 * 15) + F.lit(24.06570982441908 * 15) * days
    hour = F.radians(sidereal + lon) - ascension
    phi = F.radians(lat)
    height = F.asin(F.sin(phi) * F.sin(declination) + F.cos(phi) * F.cos(declination) * F.cos(hour))
    azimuth = F.atan2(-F.sin(hour), F.tan(declination) * F.cos(phi) - F.sin(phi) * F.cos(hour))
    turned = F.degrees(azimuth)
    return F.degrees(height), F.when(turned < 0, turned + 360.0).otherwise(turned)


def shadow(azimuth: Column, elevation: Column, height: Column, slope: Column, aspect: Column) -> list[Column]:
    """status, east, north, length, azimuth of the shadow of a height (null: direction only) on a sloping plane.

    Status: below_horizon, ok, direction_only, or no_intersection where light never meets the plane.
    """
    a, e, s, f = (F.radians(x) for x in (azimuth, elevation, slope, F.coalesce(aspect, F.lit(0.0))))
    ray = -F.sin(a) * F.cos(e), -F.cos(a) * F.cos(e), -F.sin(e)
    normal = F.sin(s) * F.sin(f), F.sin(s) * F.cos(f), F.cos(s)
    slant = sum((n * r for n, r in zip(normal, ray, strict=True)), F.lit(0.0))
    tall = F.coalesce(height, F.lit(1.0))
    along = F.when(F.abs(slant) >= PARALLEL, -(normal[2] * tall) / slant)
    up = elevation > 0
    flat = up & (height == 0)
    meets = up & F.coalesce(along > 0, F.lit(False))
    status = (
        F.when(~up, "below_horizon").when(flat, "ok").when(~meets, "no_intersection").when(height.isNull(), "direction_only").otherwise("ok")
    )
    east, north, rise = along * ray[0], along * ray[1], tall + along * ray[2]
    shown = status == "ok"

    def measure(x: Column) -> Column:
        return F.when(flat, 0.0).when(shown, x)

    opposite = F.pmod(azimuth + 180.0, F.lit(360.0))
    turned = F.pmod(F.degrees(F.atan2(east, north)), F.lit(360.0))
    cast = meets & (F.coalesce(height, F.lit(1.0)) != 0) & ((F.abs(east) > PARALLEL) | (F.abs(north) > PARALLEL))
    return [status, measure(east), measure(north), measure(F.sqrt(east * east + north * north + rise * rise)), F.when(cast, turned).otherwise(opposite)]
