"""Spatial, raster and vector queries over points derived from keys, and over embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.functions import arrays as ar
from siltbed.functions import geo
from siltbed.functions import text as tx
from siltbed.operators import spatial as sp
from siltbed.sources import fixtures as fx


_pairs = fx.customer_supplier_pairs


def haversine_pairs(spark: SparkSession, sf: str) -> DataFrame:
    p = [F.col(x) for x in ("lat", "lon", "lat2", "lon2")]
    return _pairs(spark, sf).select("id", F.round(geo.haversine(*p), 3).alias("mean_metres"), F.round(geo.haversine(*p, geo.AUTHALIC_RADIUS), 3).alias("authalic_metres"))


def bearing_compass8(spark: SparkSession, sf: str) -> DataFrame:
    angle = geo.bearing(*[F.col(x) for x in ("lat", "lon", "lat2", "lon2")])
    rows = _pairs(spark, sf).withColumn("angle", F.round(angle, 6))
    lat, lon = geo.offset(F.col("lat"), F.col("lon"), F.col("angle"), F.lit(1000.0))
    return rows.select("id", "angle", geo.compass8(F.col("angle")).alias("compass"), F.round(geo.angle_diff(F.col("angle"), F.lit(350.0)), 6).alias("off"),
                       geo.along_axis(F.col("angle"), F.lit(90.0)).alias("east_west"), F.round(lat, 9).alias("lat1"), F.round(lon, 9).alias("lon1"))


def gcj02_forward(spark: SparkSession, sf: str) -> DataFrame:
    lon, lat = geo.gcj02(F.col("lon"), F.col("lat"))
    rows = fx.customer_points(spark, sf).select("id", lon.alias("lon"), lat.alias("lat"))
    bd_lon, bd_lat = geo.bd09(F.col("lon"), F.col("lat"))
    return rows.select("id", F.round("lon", 8).alias("gcj_lon"), F.round("lat", 8).alias("gcj_lat"), F.round(bd_lon, 8).alias("bd_lon"), F.round(bd_lat, 8).alias("bd_lat"))


def bbox_null_pass(spark: SparkSession, sf: str) -> DataFrame:
    """Points inside a box; those without a place pass."""
    rows = fx.customer_points(spark, sf).withColumn("lat", F.when(F.col("id") % 11 != 0, F.col("lat")))
    inside = F.col("lat").isNull() | (F.col("lat").between(25, 35) & F.col("lon").between(103, 110))
    return rows.where(inside).select("id", F.col("lat").isNull().alias("placeless"))


def tile_cover(spark: SparkSession, sf: str) -> DataFrame:
    west, south, east, north = geo.bbox(F.col("lat"), F.col("lon"), F.lit(30_000.0))
    boxes = fx.supplier_points(spark, sf).select("id", west.alias("west"), south.alias("south"), east.alias("east"), north.alias("north"))
    out = sp.tiles(boxes, 0.2, 0.01)
    return out.select("id", "tile_x", "tile_y", *[F.round(c, 7).alias(c) for c in ("tile_west", "tile_south", "tile_east", "tile_north")])


def _star(lon, lat):
    """A closed five-cornered ring around a point."""
    corners = [(0.0, 3.0), (1.0, -2.0), (3.5, -1.0), (0.5, 0.5), (-3.0, 0.25), (0.0, 3.0)]
    return F.array(*[F.struct((lon + dx).alias("lon"), (lat + dy).alias("lat")) for dx, dy in corners])


def point_in_polygon(spark: SparkSession, sf: str) -> DataFrame:
    polygons = fx.supplier_points(spark, sf).select(F.col("id").alias("polygon_id"), _star(F.col("lon") + 0.0037, F.col("lat") + 0.0041).alias("ring"))
    return sp.in_polygons(fx.customer_points(spark, sf), polygons, 1.0)


def _segments(points: DataFrame, dx: float, dy: float) -> DataFrame:
    return points.select("id", F.col("lon").alias("x1"), F.col("lat").alias("y1"), (F.col("lon") + dx).alias("x2"), (F.col("lat") + dy).alias("y2"))


def segment_crossings(spark: SparkSession, sf: str) -> DataFrame:
    a = _segments(fx.customer_points(spark, sf), 0.31, 0.17)
    b = _segments(fx.supplier_points(spark, sf), -0.23, 0.29)
    out = sp.crossing_points(a, b, 0.5)
    return out.select("left_id", "right_id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


def near_join(spark: SparkSession, sf: str) -> DataFrame:
    out = sp.near_join(fx.customer_points(spark, sf), fx.supplier_points(spark, sf), 25_000.0)
    return out.select("left_id", "right_id", F.round("distance", 3).alias("distance"))


def nearest_reference(spark: SparkSession, sf: str) -> DataFrame:
    out = sp.nearest_within(fx.customer_points(spark, sf), fx.supplier_points(spark, sf), 60_000.0)
    return out.select("left_id", "right_id", F.round("distance", 3).alias("distance"))


def polyline_length(spark: SparkSession, sf: str) -> DataFrame:
    """Paths of orders: the points of their lines' parts in line order."""
    rows = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", fx.latitude(F.col("l_partkey")).alias("lat"), fx.longitude(F.col("l_partkey")).alias("lon"))
    return sp.path_lengths(rows, ["l_orderkey"], ["l_linenumber", "l_partkey"]).select("l_orderkey", F.round("metres", 2).alias("metres"), "segments")


def circular_mean(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.table(spark, sf, "orders").select("o_custkey", F.radians((F.col("o_orderkey") % 360).cast("double")).alias("a"))
    mean = F.pmod(F.degrees(F.atan2(F.avg(F.sin("a")), F.avg(F.cos("a")))) + 360.0, F.lit(360.0))
    strength = F.hypot(F.avg(F.sin("a")), F.avg(F.cos("a")))
    return rows.groupBy("o_custkey").agg(mean.alias("mean"), strength.alias("strength")).where("strength > 1e-6").select("o_custkey", F.round("mean", 5).alias("mean"))


def _cells(spark: SparkSession, sf: str) -> DataFrame:
    """Terrain of 50 columns: heights from keys, every 97th without data."""
    key = F.col("p_partkey") - 1
    height = F.when(F.col("p_partkey") % 97 != 0, ((key * 7919) % 1000).cast("double") / 4.0)
    return fx.table(spark, sf, "part").select((key % 20).cast("int").alias("grid"), F.floor(key / 20 / 50).cast("int").alias("row"), (F.floor(key / 20) % 50).cast("int").alias("col"), height.alias("value"))


def horn_slope(spark: SparkSession, sf: str) -> DataFrame:
    cells = _cells(spark, sf).withColumn("row", (F.col("col") / 10).cast("int") + F.col("row") * 5).withColumn("col", F.col("col") % 10)
    out = sp.horn(cells, ["grid"], 30.0, 1.0)
    return out.select("grid", "row", "col", *[F.round(c, 5).alias(c) for c in ("slope", "aspect", "ruggedness")])


def relief_class(spark: SparkSession, sf: str) -> DataFrame:
    """Height statistics of each grid, and a class by its relief."""
    out = _cells(spark, sf).groupBy("grid").agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.round(F.avg("value"), 6).alias("mean"),
        F.round(F.percentile("value", F.lit(0.1)), 6).alias("p10"), F.round(F.percentile("value", F.lit(0.9)), 6).alias("p90"),
    )
    relief = F.col("high") - F.col("low")
    return out.withColumn("relief", F.when(relief < 30, "flat").when(relief < 150, "rolling").when(relief < 249.7, "hilly").otherwise("mountain"))


def line_obstruction(spark: SparkSession, sf: str) -> DataFrame:
    """Sight along each order's lines: terrain from the lines' quantities."""
    rows = fx.table(spark, sf, "lineitem").select("l_orderkey", ((F.col("l_linenumber") - 1) * 500.0).alias("distance"), F.col("l_quantity").alias("terrain"), (F.col("l_partkey") % 40 + 2.0).alias("end"), "l_partkey", "l_suppkey")
    rows = rows.groupBy("l_orderkey", "distance").agg(*[F.min_by(c, F.struct("l_partkey", "l_suppkey")).alias(c) for c in ("terrain", "end")])
    ends = rows.groupBy("l_orderkey").agg(F.max("distance").alias("total"), F.min_by("end", "distance").alias("eye"), F.max_by("end", "distance").alias("aim"))
    out = sp.obstruction(rows.join(ends.where("total > 0"), "l_orderkey"), ["l_orderkey"])
    return out.select("l_orderkey", "blocked_at", F.round("above", 6).alias("above"), "visible")


def terrain_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Terrain between cells at each customer's place on a grid, some of them beyond its edge."""
    cells = _cells(spark, sf).withColumn("row", (F.col("col") / 10).cast("int") + F.col("row") * 5).withColumn("col", F.col("col") % 10)
    key = F.col("c_custkey")
    places = fx.table(spark, sf, "customer").select((key % 20).cast("int").alias("grid"), key.alias("id"), ((key * 37 % 115) / 10.0 - 0.5).alias("x"), ((key * 53 % 120) / 10.0 - 0.5).alias("y"))
    return sp.sampled(places, cells).select("id", F.round("value", 6).alias("value"))


def geodesic_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """The line on the ellipsoid from each customer to a supplier; all suppliers by turns."""
    line = geo.geodesic()(*[F.col(x) for x in ("lat", "lon", "lat2", "lon2")])
    found = _pairs(spark, sf).select("id", line.alias("line"))
    return found.select("id", *[F.round(f"line.{c}", 4).alias(c) for c in ("metres", "forward", "back")])


def _next_vectors(spark: SparkSession, sf: str) -> DataFrame:
    v = fx.table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("x"))
    return v.join(v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("x").alias("y")), "vec_id")


def embedding_ncc(spark: SparkSession, sf: str) -> DataFrame:
    return _next_vectors(spark, sf).select("vec_id", F.round(ar.correlation(F.col("x"), F.col("y")), 6).alias("ncc"))


def hist_bhattacharyya(spark: SparkSession, sf: str) -> DataFrame:
    positive = [F.transform(c, lambda x: F.abs(x)) for c in ("x", "y")]
    return _next_vectors(spark, sf).select("vec_id", F.round(ar.bhattacharyya(*positive), 6).alias("distance"))


def pixel_change(spark: SparkSession, sf: str) -> DataFrame:
    """Mean absolute difference of neighbouring vectors, and the share of places that changed much."""
    change = F.zip_with("x", "y", lambda a, b: F.abs(a - b))
    rows = _next_vectors(spark, sf).select("vec_id", change.alias("d"))
    much = F.size(F.filter("d", lambda x: x > 0.1))
    return rows.select("vec_id", F.round(ar.total(F.col("d")) / F.size("d"), 6).alias("mae"), F.round(much / F.size("d"), 6).alias("changed"))


def first_capture_compare(spark: SparkSession, sf: str) -> DataFrame:
    """Each vector of a label against the label's first, which one shuffle brings to it."""
    v = fx.table(spark, sf, "embeddings").select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("x"))
    first = v.groupBy("label").agg(F.min_by("x", "vec_id").alias("y"), F.min("vec_id").alias("first_id"))
    out = v.join(first, "label").where("vec_id != first_id")
    return out.select("vec_id", "first_id", F.round(ar.correlation(F.col("x"), F.col("y")), 6).alias("ncc"))


def gps_degrees(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    value = tx.dms_degrees((key % 90).cast("double"), (key % 60).cast("double"), (key % 3600) / 60.0, F.when(key % 2 == 0, "s").otherwise("N"))
    return fx.table(spark, sf, "customer").select(key.alias("id"), (F.round(value, 8) + 0.0).alias("degrees"))


def HAVERSINE(r: float, a: str = "lat", b: str = "lon", c: str = "lat2", d: str = "lon2") -> str:
    return f"""{2 * r}::DOUBLE * asin(least(1.0::DOUBLE, sqrt(sin(radians({c} - {a}) / 2) * sin(radians({c} - {a}) / 2)
        + cos(radians({a})) * cos(radians({c})) * sin(radians({d} - {b}) / 2) * sin(radians({d} - {b}) / 2))))"""


P = f"WITH {fx.PAIRS_SQL}"
BEARING = "degrees(atan2(sin(radians(lon2 - lon)) * cos(radians(lat2)), cos(radians(lat)) * sin(radians(lat2)) - sin(radians(lat)) * cos(radians(lat2)) * cos(radians(lon2 - lon))))"
V = "WITH v AS (SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS x FROM embeddings), n AS (SELECT a.vec_id, a.x, b.x AS y FROM v a JOIN v b ON b.vec_id = a.vec_id + 1)"
CELLS = """c AS (SELECT CAST((p_partkey - 1) % 20 AS INT) AS grid, CAST((p_partkey - 1) // 20 // 50 AS INT) AS row, CAST((p_partkey - 1) // 20 % 50 AS INT) AS col,
    CASE WHEN p_partkey % 97 <> 0 THEN CAST((p_partkey - 1) * 7919 % 1000 AS DOUBLE) / 4.0::DOUBLE END AS value FROM part)"""


def _waves(*terms: tuple[float, str]) -> str:
    return "((" + " + ".join(f"{a}::DOUBLE * sin({x})" for a, x in terms) + ") * (2.0::DOUBLE / 3.0::DOUBLE))"


_R = _waves((20.0, "x * 6 * pi()"), (20.0, "x * 2 * pi()"))
_NORTH = f"(-100.0::DOUBLE + x * 2 + y * 3 + y * y * 0.2::DOUBLE + x * y * 0.1::DOUBLE + sqrt(abs(x)) * 0.2::DOUBLE + {_R} + {_waves((20.0, 'y * pi()'), (40.0, 'y / 3 * pi()'))} + {_waves((160.0, 'y / 12 * pi()'), (320.0, 'y * pi() / 30'))})"
_EAST = f"(300.0::DOUBLE + x + y * 2 + x * x * 0.1::DOUBLE + x * y * 0.1::DOUBLE + sqrt(abs(x)) * 0.1::DOUBLE + {_R} + {_waves((20.0, 'x * pi()'), (40.0, 'x / 3 * pi()'))} + {_waves((150.0, 'x / 12 * pi()'), (300.0, 'x / 30 * pi()'))})"
_STAR = "[(0.0, 3.0), (1.0, -2.0), (3.5, -1.0), (0.5, 0.5), (-3.0, 0.25), (0.0, 3.0)]"
_EE, _AXIS, _BD = geo.GCJ_ECCENTRICITY, geo.GCJ_AXIS, geo.BD_PI

_NEXT = """SELECT id, n + 1 AS n, l, u, v, l + (1 - k) * f * sa * (arc + k * ss * (mid + k * cs * (2 * mid * mid - 1))) AS t FROM (
    SELECT *, 1 / 298.257223563::DOUBLE AS f, sqrt(pow(cos(v) * sin(t), 2) + pow(cos(u) * sin(v) - sin(u) * cos(v) * cos(t), 2)) AS ss,
    sin(u) * sin(v) + cos(u) * cos(v) * cos(t) AS cs, atan2(ss, cs) AS arc, cos(u) * cos(v) * sin(t) / ss AS sa, 1 - sa * sa AS ca,
    cs - 2 * sin(u) * sin(v) / ca AS mid, f / 16 * ca * (4 + f * (4 - 3 * ca)) AS k FROM turns) WHERE n < 12"""

ORACLE_SQL = {
    "terrain_samples": """WITH k AS (SELECT p_partkey - 1 AS key, CASE WHEN p_partkey % 97 <> 0 THEN CAST((p_partkey - 1) * 7919 % 1000 AS DOUBLE) / 4.0::DOUBLE END AS value FROM part),
        g AS (SELECT key % 20 AS grid, key // 20 % 50 // 10 + key // 20 // 50 * 5 AS row, key // 20 % 50 % 10 AS col, value FROM k),
        h AS (SELECT grid, max(row) + 1 AS rows, max(col) + 1 AS cols FROM g GROUP BY grid),
        p AS (SELECT c_custkey % 20 AS grid, c_custkey AS id, c_custkey * 37 % 115 / 10.0::DOUBLE - 0.5::DOUBLE AS x, c_custkey * 53 % 120 / 10.0::DOUBLE - 0.5::DOUBLE AS y FROM customer),
        q AS (SELECT *, CAST(floor(x - 0.5::DOUBLE) AS BIGINT) AS c0, CAST(floor(y - 0.5::DOUBLE) AS BIGINT) AS r0, x - 0.5::DOUBLE - c0 AS dx, y - 0.5::DOUBLE - r0 AS dy,
              c0 >= 0 AND r0 >= 0 AND c0 + 1 < cols AND r0 + 1 < rows AS four FROM p LEFT JOIN h USING (grid)),
        e AS (SELECT q.*, g1.value AS v1, g2.value AS v2, g3.value AS v3, g4.value AS v4, g5.value AS v5 FROM q
              LEFT JOIN g g1 ON g1.grid = q.grid AND g1.row = r0 AND g1.col = c0 LEFT JOIN g g2 ON g2.grid = q.grid AND g2.row = r0 AND g2.col = c0 + 1
              LEFT JOIN g g3 ON g3.grid = q.grid AND g3.row = r0 + 1 AND g3.col = c0 LEFT JOIN g g4 ON g4.grid = q.grid AND g4.row = r0 + 1 AND g4.col = c0 + 1
              LEFT JOIN g g5 ON g5.grid = q.grid AND g5.row = least(greatest(floor(y), 0), rows - 1) AND g5.col = least(greatest(floor(x), 0), cols - 1))
        SELECT id, round(CASE WHEN x < 0 OR y < 0 OR x > cols OR y > rows THEN NULL
            WHEN four THEN (v1 * (1 - dx) + v2 * dx) * (1 - dy) + (v3 * (1 - dx) + v4 * dx) * dy ELSE v5 END, 6) AS value FROM e""",
    "geodesic_pairs": f"""WITH RECURSIVE {fx.PAIRS_SQL}, m AS (SELECT id, radians(lon2 - lon) AS l, atan((1 - 1 / 298.257223563::DOUBLE) * tan(radians(lat))) AS u,
        atan((1 - 1 / 298.257223563::DOUBLE) * tan(radians(lat2))) AS v FROM p),
        turns AS (SELECT id, 0 AS n, l, u, v, l AS t FROM m UNION ALL {_NEXT}),
        d AS (SELECT id, t, cos(v) * sin(t) AS across, cos(u) * sin(v) - sin(u) * cos(v) * cos(t) AS along, sqrt(across * across + along * along) AS ss,
              sin(u) * sin(v) + cos(u) * cos(v) * cos(t) AS cs, atan2(ss, cs) AS arc, cos(u) * across / ss AS sa, 1 - sa * sa AS ca, cs - 2 * sin(u) * sin(v) / ca AS mid,
              6378137.0::DOUBLE * (1 - 1 / 298.257223563::DOUBLE) AS b, ca * (pow(6378137.0::DOUBLE / b, 2) - 1) AS k,
              1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k))) AS a1, k / 1024 * (256 + k * (-128 + k * (74 - 47 * k))) AS b1,
              b1 * ss * (mid + b1 / 4 * (cs * (2 * mid * mid - 1) - b1 / 6 * mid * (4 * ss * ss - 3) * (4 * mid * mid - 3))) AS less,
              atan2(cos(u) * sin(t), cos(u) * sin(v) * cos(t) - sin(u) * cos(v)) AS last FROM turns WHERE n = 12)
        SELECT id, CASE WHEN isnan(t) THEN 0 ELSE round(b * a1 * (arc - less), 4) END AS metres, CASE WHEN NOT isnan(t) THEN round((degrees(atan2(across, along)) + 360) % 360, 4) END AS forward,
            CASE WHEN NOT isnan(t) THEN round((degrees(last) + 540) % 360, 4) END AS back FROM d  -- equal places are 0 metres apart without a direction""",
    "haversine_pairs": f"{P} SELECT id, round({HAVERSINE(geo.MEAN_RADIUS)}, 3) AS mean_metres, round({HAVERSINE(geo.AUTHALIC_RADIUS)}, 3) AS authalic_metres FROM p",
    "bearing_compass8": f"""{P}, a AS (SELECT id, lat, lon, round(({BEARING} + 360) % 360, 6) AS angle FROM p)
        SELECT id, angle, ['N','NE','E','SE','S','SW','W','NW'][CAST(floor((angle + 22.5::DOUBLE) / 45) AS BIGINT) % 8 + 1] AS compass,
        round(least(abs(angle - 350), 360 - abs(angle - 350)), 6) AS off, least(abs(angle - 90) % 180, 180 - abs(angle - 90) % 180) <= 20 AS east_west,
        round(lat + 1000.0::DOUBLE * cos(radians(angle)) / 111320, 9) AS lat1, round(lon + 1000.0::DOUBLE * sin(radians(angle)) / (111320.0::DOUBLE * cos(radians(lat))), 9) AS lon1 FROM a""",
    "gcj02_forward": f"""WITH {fx.POINTS_SQL}, d AS (SELECT id, lat, lon, lon - 105 AS x, lat - 35 AS y, 1 - {_EE}::DOUBLE * sin(radians(lat)) * sin(radians(lat)) AS flat FROM c),
        g AS (SELECT id, CASE WHEN i THEN lon + {_EAST} * 180 / ({_AXIS}::DOUBLE / sqrt(flat) * cos(radians(lat)) * pi()) ELSE lon END AS lon,
              CASE WHEN i THEN lat + {_NORTH} * 180 / ({_AXIS * (1 - _EE)}::DOUBLE / (flat * sqrt(flat)) * pi()) ELSE lat END AS lat
              FROM (SELECT *, lon BETWEEN 72.004 AND 137.8347 AND lat BETWEEN 0.8293 AND 55.8271 AS i FROM d)),
        b AS (SELECT *, sqrt(lon * lon + lat * lat) + sin(lat * {_BD}::DOUBLE) * 0.00002::DOUBLE AS z, atan2(lat, lon) + cos(lon * {_BD}::DOUBLE) * 0.000003::DOUBLE AS t FROM g)
        SELECT id, round(lon, 8) AS gcj_lon, round(lat, 8) AS gcj_lat, round(z * cos(t) + 0.0065::DOUBLE, 8) AS bd_lon, round(z * sin(t) + 0.006::DOUBLE, 8) AS bd_lat FROM b""",
    "bbox_null_pass": f"WITH {fx.POINTS_SQL} SELECT id, id % 11 = 0 AS placeless FROM c WHERE id % 11 = 0 OR (lat BETWEEN 25 AND 35 AND lon BETWEEN 103 AND 110)",
    "tile_cover": f"""WITH {fx.POINTS_SQL}, d AS (SELECT id, lat, lon, 30000.0::DOUBLE / 111320 AS dy, 30000.0::DOUBLE / (111320.0::DOUBLE * greatest(cos(radians(lat)), 0.01)) AS dx FROM s),
        b AS (SELECT id, lon - dx AS w, lat - dy AS s, lon + dx AS e, lat + dy AS n FROM d),
        x AS (SELECT *, CAST(unnest(range(0, greatest(1, CAST(ceil((e - w) / 0.2::DOUBLE) AS BIGINT)))) AS INT) AS tile_x FROM b),
        y AS (SELECT *, CAST(unnest(range(0, greatest(1, CAST(ceil((n - s) / 0.2::DOUBLE) AS BIGINT)))) AS INT) AS tile_y FROM x)
        SELECT id, tile_x, tile_y, round(greatest(w, w + tile_x * 0.2::DOUBLE - 0.01::DOUBLE), 7) AS tile_west, round(greatest(s, s + tile_y * 0.2::DOUBLE - 0.01::DOUBLE), 7) AS tile_south,
        round(least(e, w + (tile_x + 1) * 0.2::DOUBLE + 0.01::DOUBLE), 7) AS tile_east, round(least(n, s + (tile_y + 1) * 0.2::DOUBLE + 0.01::DOUBLE), 7) AS tile_north FROM y""",
    "point_in_polygon": f"""WITH {fx.POINTS_SQL}, k AS (SELECT unnest(range(1, 6)) AS k), o AS (SELECT {_STAR} AS o),
        e AS (SELECT s.id AS polygon_id, s.lon + 0.0037::DOUBLE + o[k][1]::DOUBLE AS ax, s.lat + 0.0041::DOUBLE + o[k][2]::DOUBLE AS ay,
              s.lon + 0.0037::DOUBLE + o[k + 1][1]::DOUBLE AS bx, s.lat + 0.0041::DOUBLE + o[k + 1][2]::DOUBLE AS "by" FROM s, k, o)
        SELECT c.id, polygon_id FROM c, e WHERE (ay > c.lat) <> ("by" > c.lat) AND c.lon < (bx - ax) * (c.lat - ay) / ("by" - ay) + ax
        GROUP BY c.id, polygon_id HAVING count(*) % 2 = 1""",
    "segment_crossings": f"""WITH {fx.POINTS_SQL}, m AS (SELECT c.id AS left_id, s.id AS right_id, c.lon AS ax, c.lat AS ay, c.lon + 0.31::DOUBLE AS bx, c.lat + 0.17::DOUBLE AS b_y,
        s.lon AS cx, s.lat AS cy, s.lon + -0.23::DOUBLE AS dx, s.lat + 0.29::DOUBLE AS dy FROM c, s WHERE abs(c.lon - s.lon) < 1 AND abs(c.lat - s.lat) < 1),
        d AS (SELECT *, (bx - ax) * (dy - cy) - (b_y - ay) * (dx - cx) AS det FROM m),
        t AS (SELECT *, ((cx - ax) * (dy - cy) - (cy - ay) * (dx - cx)) / det AS t, ((cx - ax) * (b_y - ay) - (cy - ay) * (bx - ax)) / det AS u FROM d WHERE abs(det) >= 1e-9)
        SELECT left_id, right_id, round(ax + t * (bx - ax), 6) AS x, round(ay + t * (b_y - ay), 6) AS y FROM t WHERE t BETWEEN 0 AND 1 AND u BETWEEN 0 AND 1""",
    "near_join": f"""WITH {fx.POINTS_SQL}, m AS (SELECT c.id AS left_id, s.id AS right_id, {HAVERSINE(geo.MEAN_RADIUS, 'c.lat', 'c.lon', 's.lat', 's.lon')} AS d FROM c, s WHERE abs(c.lat - s.lat) < 1)
        SELECT left_id, right_id, round(d, 3) AS distance FROM m WHERE d <= 25000""",
    "nearest_reference": f"""WITH {fx.POINTS_SQL}, m AS (SELECT c.id AS left_id, s.id AS right_id, {HAVERSINE(geo.MEAN_RADIUS, 'c.lat', 'c.lon', 's.lat', 's.lon')} AS d FROM c, s WHERE abs(c.lat - s.lat) < 1),
        r AS (SELECT *, row_number() OVER (PARTITION BY left_id ORDER BY d, right_id) AS rank FROM m WHERE d <= 60000) SELECT left_id, right_id, round(d, 3) AS distance FROM r WHERE rank = 1""",
    "polyline_length": f"""WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, {fx.LAT_SQL.format('l_partkey')} AS lat, {fx.LON_SQL.format('l_partkey')} AS lon FROM lineitem),
        n AS (SELECT *, lead(lat) OVER w AS lat2, lead(lon) OVER w AS lon2 FROM l WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey))
        SELECT l_orderkey, round(sum({HAVERSINE(geo.MEAN_RADIUS)}), 2) AS metres, count(*) AS segments FROM n WHERE lat2 IS NOT NULL GROUP BY l_orderkey""",
    "circular_mean": """WITH r AS (SELECT o_custkey, avg(sin(radians(CAST(o_orderkey % 360 AS DOUBLE)))) AS s, avg(cos(radians(CAST(o_orderkey % 360 AS DOUBLE)))) AS c FROM orders GROUP BY 1)
        SELECT o_custkey, round((degrees(atan2(s, c)) + 360) % 360, 5) AS mean FROM r WHERE sqrt(s * s + c * c) > 1e-6""",
    "horn_slope": f"""WITH {CELLS}, g AS (SELECT grid, CAST(col // 10 + row * 5 AS INT) AS row, CAST(col % 10 AS INT) AS col, value FROM c),
        m AS (SELECT a.grid, a.row, a.col, b.row - a.row AS dr, b.col - a.col AS dc, b.value FROM g a JOIN g b ON a.grid = b.grid AND abs(a.row - b.row) <= 1 AND abs(a.col - b.col) <= 1),
        s AS (SELECT grid, row, col, count(*) AS n, max(value) FILTER (dr = 0 AND dc = 0) AS e,
            CASE WHEN count(value) FILTER (dc = 1) = 3 AND count(value) FILTER (dc = -1) = 3 THEN sum(value * dc * (CASE WHEN dr = 0 THEN 2 ELSE 1 END)) FILTER (dc <> 0) END AS east,
            CASE WHEN count(value) FILTER (dr = 1) = 3 AND count(value) FILTER (dr = -1) = 3 THEN sum(-value * dr * (CASE WHEN dc = 0 THEN 2 ELSE 1 END)) FILTER (dr <> 0) END AS north FROM m GROUP BY ALL),
        h AS (SELECT s.*, east / 240.0::DOUBLE AS dx, north / 240.0::DOUBLE AS dy, (SELECT coalesce(sum((m.value - s.e) * (m.value - s.e)), 0) FROM m WHERE m.grid = s.grid AND m.row = s.row AND m.col = s.col) AS q FROM s WHERE n = 9),
        f AS (SELECT *, degrees(atan(sqrt(dx * dx + dy * dy))) AS slope FROM h)
        SELECT grid, row, col, round(slope, 5) AS slope, CASE WHEN slope >= 1 THEN round((degrees(atan2(-dx, -dy)) + 360) % 360, 5) END AS aspect,
        CASE WHEN e IS NOT NULL THEN round(sqrt(q), 5) END AS ruggedness FROM f""",
    "relief_class": f"""WITH {CELLS}, s AS (SELECT grid, min(value) AS low, max(value) AS high, round(avg(value), 6) AS mean,
        round(quantile_cont(value, 0.1), 6) AS p10, round(quantile_cont(value, 0.9), 6) AS p90 FROM c GROUP BY grid)
        SELECT *, CASE WHEN high - low < 30 THEN 'flat' WHEN high - low < 150 THEN 'rolling' WHEN high - low < 249.7::DOUBLE THEN 'hilly' ELSE 'mountain' END AS relief FROM s""",
    "line_obstruction": """WITH l AS (SELECT l_orderkey, (l_linenumber - 1) * 500.0::DOUBLE AS distance, arg_min(l_quantity, (l_partkey, l_suppkey)) AS terrain,
        arg_min(l_partkey % 40 + 2.0::DOUBLE, (l_partkey, l_suppkey)) AS "end" FROM lineitem GROUP BY 1, 2),
        e AS (SELECT l_orderkey, max(distance) AS total, arg_min("end", distance) AS eye, arg_max("end", distance) AS aim FROM l GROUP BY 1 HAVING max(distance) > 0),
        s AS (SELECT l_orderkey, distance, terrain, total, eye + (aim - eye) * distance / total - distance * (total - distance) / (2 * 1.33 * 6371000.0)::DOUBLE AS sight FROM l JOIN e USING (l_orderkey)),
        b AS (SELECT l_orderkey, min(distance) AS blocked_at, arg_min(terrain - sight, distance) AS above FROM s WHERE distance > 0 AND distance < total AND terrain > sight + 0.05::DOUBLE GROUP BY 1)
        SELECT e.l_orderkey, blocked_at, round(above, 6) AS above, blocked_at IS NULL AS visible FROM e LEFT JOIN b USING (l_orderkey)""",
    "embedding_ncc": f"""{V}, m AS (SELECT vec_id, list_avg(x) AS mx, list_avg(y) AS my, list_sum([x[i] * y[i] FOR i IN range(1, 65)]) / 64 AS xy,
        list_sum([a * a FOR a IN x]) / 64 AS xx, list_sum([a * a FOR a IN y]) / 64 AS yy FROM n)
        SELECT vec_id, round(CASE WHEN xx - mx * mx < 1e-6 OR yy - my * my < 1e-6 THEN 0 ELSE (xy - mx * my) / sqrt((xx - mx * mx) * (yy - my * my)) END, 6) AS ncc FROM m""",
    "hist_bhattacharyya": f"""{V} SELECT vec_id, round(sqrt(greatest(0, 1 - list_sum([sqrt(abs(x[i]) * abs(y[i])) FOR i IN range(1, 65)])
        / sqrt(list_sum([abs(a) FOR a IN x]) * list_sum([abs(a) FOR a IN y])))), 6) AS distance FROM n""",
    "pixel_change": f"""{V} SELECT vec_id, round(list_sum([abs(x[i] - y[i]) FOR i IN range(1, 65)]) / 64, 6) AS mae,
        round(len([i FOR i IN range(1, 65) IF abs(x[i] - y[i]) > 0.1::DOUBLE]) / 64.0::DOUBLE, 6) AS changed FROM n""",
    "first_capture_compare": """WITH v AS (SELECT vec_id, label, [CAST(x AS DOUBLE) FOR x IN embedding] AS x FROM embeddings),
        f AS (SELECT label, min(vec_id) AS first_id FROM v GROUP BY label), n AS (SELECT v.vec_id, first_id, v.x, w.x AS y FROM v JOIN f USING (label) JOIN v w ON w.vec_id = first_id WHERE v.vec_id <> first_id),
        m AS (SELECT vec_id, first_id, list_avg(x) AS mx, list_avg(y) AS my, list_sum([x[i] * y[i] FOR i IN range(1, 65)]) / 64 AS xy,
        list_sum([a * a FOR a IN x]) / 64 AS xx, list_sum([a * a FOR a IN y]) / 64 AS yy FROM n)
        SELECT vec_id, first_id, round(CASE WHEN xx - mx * mx < 1e-6 OR yy - my * my < 1e-6 THEN 0 ELSE (xy - mx * my) / sqrt((xx - mx * mx) * (yy - my * my)) END, 6) AS ncc FROM m""",
    "gps_degrees": """SELECT c_custkey AS id, round((CASE WHEN c_custkey % 2 = 0 THEN -1 ELSE 1 END)
        * (CAST(c_custkey % 90 AS DOUBLE) + CAST(c_custkey % 60 AS DOUBLE) / 60 + c_custkey % 3600 / 60.0::DOUBLE / 3600), 8) + 0.0::DOUBLE AS degrees FROM customer""",
}

QUERIES = {
    f.__name__: f
    for f in (
        haversine_pairs, bearing_compass8, gcj02_forward, bbox_null_pass, tile_cover, point_in_polygon, segment_crossings, near_join,
        nearest_reference, polyline_length, circular_mean, horn_slope, terrain_samples, geodesic_pairs, relief_class, line_obstruction, embedding_ncc,
        hist_bhattacharyya, pixel_change, first_capture_compare, gps_degrees,
    )
}
