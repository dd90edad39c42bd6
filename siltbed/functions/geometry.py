"""Shapes in degrees from GeoJSON and its looser forms, as one struct: points, lines, and rings that are holes or not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POINT = "struct<x: double, y: double>"
SHAPE = f"struct<points: array<{POINT}>, lines: array<array<{POINT}>>, rings: array<struct<hole: boolean, points: array<{POINT}>>>>"
#: How many brackets bring a kind's coordinates to polygons of rings of positions.
DEPTH = {"point": 3, "multipoint": 2, "linestring": 2, "polygon": 1, "multilinestring": 1, "multipolygon": 0}


def _fields(structs: Column, name: str) -> Column:
    return F.transform(structs, lambda s: s[name])


def _points(positions: Column) -> Column:
    return F.transform(positions, lambda c: F.struct(F.get(c, F.lit(0)).alias("x"), F.get(c, F.lit(1)).alias("y")))


def _closed(ring: Column) -> Column:
    return F.when(F.get(ring, F.lit(0)) == F.get(ring, F.size(ring) - 1), ring).otherwise(F.concat(ring, F.slice(ring, F.lit(1), F.lit(1))))


def _shape(points: Column | None = None, lines: Column | None = None, rings: Column | None = None) -> Column:
    given = {"points": points, "lines": lines, "rings": rings}
    return F.struct(*[(F.array() if c is None else c).alias(name) for name, c in given.items()]).cast(SHAPE)


def box_shape(west: Column, south: Column, east: Column, north: Column) -> Column:
    corners = [(west, south), (east, south), (east, north), (west, north), (west, south)]
    ring = F.array(*[F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in corners])
    return _shape(rings=F.array(F.struct(F.lit(False).alias("hole"), ring.alias("points"))))


def point_shape(lon: Column, lat: Column) -> Column:
    return _shape(points=F.array(F.struct(lon.cast("double").alias("x"), lat.cast("double").alias("y"))))


def _simple(text: Column) -> Column:
    """kind and positions of a geometry object with coordinates, as polygons of rings of positions."""
    kind = F.lower(F.get_json_object(text, "$.type"))
    depth = F.element_at(F.create_map(*[F.lit(x) for pair in DEPTH.items() for x in pair]), kind)
    nested = F.concat(F.repeat(F.lit("["), depth), F.get_json_object(text, "$.coordinates"), F.repeat(F.lit("]"), depth))
    return F.struct(kind.alias("kind"), F.from_json(nested, "array<array<array<array<double>>>>").alias("at"))


def _assembled(found: Column) -> Column:
    """The shape of kind and positions."""
    kind, at = found["kind"], found["at"]

    def ring(r: Column, i: Column) -> Column:
        return F.struct((i > 0).alias("hole"), _points(r).alias("points"))

    points = F.when(kind.isin("point", "multipoint"), _points(F.flatten(F.flatten(at))))
    lines = F.when(kind.isin("linestring", "multilinestring"), F.transform(F.flatten(at), _points))
    rings = F.when(kind.isin("polygon", "multipolygon"), F.flatten(F.transform(at, lambda polygon: F.transform(polygon, ring))))
    given = {"points": points, "lines": lines, "rings": rings}
    return F.struct(*[F.coalesce(c, F.array()).alias(name) for name, c in given.items()]).cast(SHAPE)


def _loose(text: Column) -> Column:
    """Bounds by name, a place by lat and lon (or lng), or a list of two or four numbers."""
    west, south, east, north = (F.get_json_object(text, f"$.{side}").try_cast("double") for side in ("west", "south", "east", "north"))
    lat = F.get_json_object(text, "$.lat").try_cast("double")
    lon = F.coalesce(F.get_json_object(text, "$.lon"), F.get_json_object(text, "$.lng")).try_cast("double")
    numbers = F.from_json(text, "array<double>")
    known = F.size(F.filter(numbers, lambda n: n.isNotNull()))
    at = [F.get(numbers, F.lit(i)) for i in range(4)]
    bounds = west.isNotNull() & south.isNotNull() & east.isNotNull() & north.isNotNull()
    return (
        F.when(bounds, box_shape(west, south, east, north))
        .when(lat.isNotNull() & lon.isNotNull(), point_shape(lon, lat))
        .when((F.size(numbers) == 4) & (known == 4), box_shape(*at))
        .when((F.size(numbers) == 2) & (known == 2), point_shape(*at[:2]))
    )


def _sound(lines: Column, rings: Column, every: Column) -> Column:
    """Whether there is a position, every one has a finite place, and no line or ring is too short."""
    finite = F.forall(every, lambda p: F.coalesce((F.abs(p["x"]) < 1e300) & (F.abs(p["y"]) < 1e300), F.lit(False)))
    return (F.size(every) > 0) & finite & F.forall(lines, lambda line: F.size(line) >= 2) & F.forall(rings, lambda r: F.size(r["points"]) >= 4)


def with_shape(df: DataFrame, text: str, name: str = "shape") -> DataFrame:
    """Adds the shape of a JSON text: a geometry, a collection of geometries, a feature, bounds or a place; null if it has none.

    Each step is a column of its own, so that nothing is parsed twice. The last one has a term that is always true and that
    the optimiser may not move, so that conditions on shapes stay above it; pushed down, they would repeat every step.
    """
    inner = F.get_json_object(text, "$.geometry")
    out = df.withColumn("own json", F.when(inner.startswith("{"), inner).otherwise(F.col(text)))
    out = out.withColumn("members", F.from_json(F.get_json_object("own json", "$.geometries"), "array<string>"))
    out = out.withColumn("members", F.coalesce("members", F.array("own json")))
    out = out.withColumn("parts", F.filter(F.transform("members", _simple), lambda p: p["at"].isNotNull()))
    out = out.withColumn("parts", F.transform("parts", _assembled)).withColumn("loose", F.when(F.size("parts") == 0, _loose(F.col("own json"))))
    out = out.withColumn("parts", F.when(F.col("loose").isNotNull(), F.array("loose")).otherwise(F.col("parts")))
    out = out.withColumn("found", F.struct(*[F.flatten(_fields(F.col("parts"), n)).alias(n) for n in ("points", "lines", "rings")]))
    closed = F.transform("found.rings", lambda r: F.struct(r["hole"].alias("hole"), _closed(r["points"]).alias("points")))
    out = out.withColumn("found", F.struct("found.points", "found.lines", closed.alias("rings")))
    every = F.concat("found.points", F.flatten("found.lines"), F.flatten(_fields(F.col("found.rings"), "points")))
    out = out.withColumn("every", every)
    sound = _sound(F.col("found.lines"), F.col("found.rings"), F.col("every"))
    return out.withColumn(name, F.when(sound & (F.monotonically_increasing_id() >= 0), F.col("found"))).drop("own json", "members", "parts", "loose", "found", "every")


def features_of(text: Column) -> Column:
    """The JSON texts of a payload's features: of its ``features``, ``elements`` or ``result``, its list, or itself."""
    nested = F.get_json_object(text, "$.result")

    def listed(own: Column) -> Column:
        named = [F.from_json(F.get_json_object(own, f"$.{name}"), "array<string>") for name in ("features", "elements")]
        return F.coalesce(*named, F.when(own.startswith("["), F.from_json(own, "array<string>")))

    return F.coalesce(listed(text), listed(nested), F.when(nested.isNotNull(), F.array(nested)), F.when(text.isNotNull(), F.array(text)))
