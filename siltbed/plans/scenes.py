"""Near copies by hashes, changed regions, parts of pictures, clusters in order and terrain along paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.functions import arrays as ar
from siltbed.functions import geo
from siltbed.operators import clusters, hashes, rasters, terrain
from siltbed.plans.places import CELLS, HAVERSINE, _cells
from siltbed.sources import fixtures as fx

LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: Pairs of letters whose counts a text's hash compares, a bit each: neighbours first, then letters two and three apart.
COMPARED = [(i, i + gap) for gap in (1, 2, 3) for i in range(26 - gap)][:64]
BIT = [1 << k if k < 63 else -(1 << 63) for k in range(64)]
NEAR_BITS = 3


def letter_hash(text: Column) -> list[Column]:
    """Counts of letters, as columns n0 to n25."""
    return [(F.char_length(text) - F.char_length(F.replace(text, F.lit(c), F.lit("")))).alias(f"n{i}") for i, c in enumerate(LETTERS)]


def near_duplicate_drop(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of a language whose letters are ordered by frequency nearly as in an earlier document that stays."""
    docs = fx.table(spark, sf, "documents").select("doc_id", "lang", *letter_hash(F.coalesce("text", F.lit(""))))
    value = sum((F.when(F.col(f"n{a}") > F.col(f"n{b}"), F.lit(bit)).otherwise(0) for (a, b), bit in zip(COMPARED, BIT, strict=True)), F.lit(0).cast("long"))
    rows = docs.select("doc_id", "lang", value.cast("long").alias("hash"))
    return hashes.near_dropped(rows, "lang", "doc_id", "hash", NEAR_BITS).select("doc_id", "lang", "kept")


def _grid(spark: SparkSession, sf: str) -> DataFrame:
    """The terrain of parts, ten columns wide."""
    return _cells(spark, sf).withColumn("row", (F.col("col") / 10).cast("int") + F.col("row") * 5).withColumn("col", F.col("col") % 10)


CHANGED = 120.0


def change_regions(spark: SparkSession, sf: str) -> DataFrame:
    """Where each even grid and the seventh after it differ much: the largest boxes around connected cells."""
    now = _grid(spark, sf)
    then = now.select((F.col("grid") - 7).alias("grid"), "row", "col", F.col("value").alias("other"))
    changed = now.where("grid % 2 = 0").join(then, ["grid", "row", "col"]).where(F.abs(F.col("value") - F.col("other")) > CHANGED)
    return rasters.change_regions(changed, "grid", tile=4)


def moving_centroids(spark: SparkSession, sf: str) -> DataFrame:
    """Customers of a nation in the order of their keys, joined to the first cluster within 250 km."""
    at = fx.customer_points(spark, sf).join(fx.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), "c_nationkey"), "id")
    found = clusters.moving_centroids(at, "c_nationkey", "id", 250_000.0)
    return found.select("c_nationkey", "first", F.round("lat", 7).alias("lat"), F.round("lon", 7).alias("lon"), "count")


def terrain_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Length, climb and relief of a path of three places for each customer, at steps of 0.4 cells; clipped to a box."""
    key = F.col("c_custkey")
    place = F.struct(F.col("j"), ((key * 37 + F.col("j") * 41) % 90 / 10.0 + 0.5).alias("x"), ((key * 53 + F.col("j") * 29) % 90 / 10.0 + 0.5).alias("y"))
    paths = fx.table(spark, sf, "customer").select("c_custkey", (key % 20).cast("int").alias("grid"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("j"))
    paths = paths.select("c_custkey", "grid", place.alias("p")).select("c_custkey", "grid", "p.*")
    cells = terrain.clipped(_grid(spark, sf), 0.0, 0.0, 10.0, 9.5, (1.0, 0.0, 0.0, 0.0, 1.0, 0.0))
    found = terrain.profile_summary(terrain.profile(paths, cells, "c_custkey", "j", 0.4, keep=50), "c_custkey")
    return found.select("c_custkey", *[F.round(c, 6).alias(c) for c in ("length", "climb", "descent", "relief", "steepest")])


def containment(spark: SparkSession, sf: str) -> DataFrame:
    """Neighbouring vectors as pictures of eight by eight: whether one shows a part of the other."""
    v = fx.table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("x"))
    # Every third vector is compared with an enlarged part of its neighbour.
    part = ar.shown(F.col("x"), ar.panel_places(8, 8, ar.PANELS[4], 8))
    other = v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("x").alias("y"))
    rows = v.join(other, "vec_id").withColumn("y", F.when(F.col("vec_id") % 3 == 0, part).otherwise(F.col("y")))
    found = rows.select("vec_id", ar.containment(F.col("x"), F.col("y"), 8, 8, 4).alias("c"))
    return found.select("vec_id", "c.kind", F.round("c.score", 6).alias("score"))


def _listed(name: str, places: list[int]) -> str:
    return "[" + ", ".join(f"{name}[{p + 1}]" for p in places) + "]"


def _ncc(p: str, q: str) -> str:
    n = f"len({p})"
    vp, vq = (f"(list_sum([t * t FOR t IN {x}]) / {n} - list_avg({x}) * list_avg({x}))" for x in (p, q))
    return f"CASE WHEN {vp} < 1e-6 OR {vq} < 1e-6 THEN 0 ELSE (list_sum([{p}[i] * {q}[i] FOR i IN range(1, 17)]) / {n} - list_avg({p}) * list_avg({q})) / sqrt({vp} * {vq}) END"


_PANEL_SQL = ", ".join(f"{_listed('x', ar.panel_places(8, 8, p, 4))} AS x{i}, {_listed('y', ar.panel_places(8, 8, p, 4))} AS y{i}" for i, p in enumerate(ar.PANELS))
_GRID_SQL = f"{CELLS}, g AS (SELECT grid, CAST(col // 10 + row * 5 AS INT) AS row, CAST(col % 10 AS INT) AS col, value FROM c)"
_COUNTS = ", ".join(f"length(t) - length(replace(t, '{c}', '')) AS n{i}" for i, c in enumerate(LETTERS))
_BITS = " + ".join(f"CASE WHEN n{a} > n{b} THEN ({bit})::BIGINT ELSE 0 END" for (a, b), bit in zip(COMPARED, BIT, strict=True))

ORACLE_SQL = {
    "near_duplicate_drop": f"""WITH RECURSIVE t AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS t FROM documents),
        n AS (SELECT doc_id, lang, {_COUNTS} FROM t), h AS (SELECT doc_id, lang, {_BITS} AS hash, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS i FROM n),
        r AS (SELECT lang, 0 AS i, -1::BIGINT AS doc_id, true AS kept, []::BIGINT[] AS held FROM (SELECT DISTINCT lang FROM h)
              UNION ALL SELECT lang, i, doc_id, kept, CASE WHEN kept THEN list_append(held, hash) ELSE held END FROM (
                  SELECT r.lang, h.i, h.doc_id, h.hash, r.held, len([x FOR x IN r.held IF bit_count(xor(x, h.hash)) <= {NEAR_BITS}]) = 0 AS kept
                  FROM r JOIN h ON h.lang = r.lang AND h.i = r.i + 1))
        SELECT doc_id, lang, kept FROM r WHERE i > 0""",
    "change_regions": f"""WITH RECURSIVE {_GRID_SQL},
        ch AS (SELECT a.grid AS k, a.row, a.col FROM g a JOIN g b ON b.grid = a.grid + 7 AND a.row = b.row AND a.col = b.col WHERE a.grid % 2 = 0 AND abs(a.value - b.value) > {CHANGED}),
        reach AS (SELECT k, row AS r0, col AS c0, row, col FROM ch UNION SELECT e.k, e.r0, e.c0, c.row, c.col FROM reach e JOIN ch c ON c.k = e.k AND abs(c.row - e.row) <= 1 AND abs(c.col - e.col) <= 1),
        lab AS (SELECT k, row, col, min(r0 * 1000 + c0) AS l FROM reach GROUP BY k, row, col),
        box AS (SELECT k, l, min(col) AS west, min(row) AS north, max(col) + 1 AS east, max(row) + 1 AS south FROM lab GROUP BY k, l),
        size AS (SELECT max(row) AS h, max(col) AS w FROM g),
        air AS (SELECT k, l, -1 AS row, -1 AS col FROM box UNION SELECT a.k, a.l, a.row + dr, a.col + dc FROM air a, size, (VALUES (0, 1), (1, 0), (0, -1), (-1, 0)) m(dr, dc)
            WHERE a.row + dr BETWEEN -1 AND h + 1 AND a.col + dc BETWEEN -1 AND w + 1
            AND NOT EXISTS (SELECT 1 FROM lab WHERE lab.k = a.k AND lab.l = a.l AND lab.row = a.row + dr AND lab.col = a.col + dc)),
        held AS (SELECT DISTINCT c.k, c.l FROM box c JOIN box d ON d.k = c.k AND d.l <> c.l WHERE NOT EXISTS (SELECT 1 FROM air WHERE air.k = c.k AND air.l = d.l AND air.row = c.l // 1000 AND air.col = c.l % 1000)),
        f AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY (east - west) * (south - north) DESC, l) AS rank FROM box ANTI JOIN held USING (k, l) WHERE (east - west) * (south - north) >= 16)
        SELECT k AS grid, rank, west, north, east, south FROM f WHERE rank <= 8""",
    "moving_centroids": f"""WITH RECURSIVE {fx.POINTS_SQL}, p AS (SELECT c_nationkey AS k, c.id, lat, lon, row_number() OVER (PARTITION BY c_nationkey ORDER BY c.id) AS i FROM c JOIN customer ON c_custkey = c.id),
        r AS (SELECT k, 0 AS i, []::STRUCT(lat DOUBLE, lon DOUBLE, n BIGINT, f BIGINT)[] AS held FROM (SELECT DISTINCT k FROM p)
            UNION ALL SELECT k, i, CASE WHEN hit = 0 THEN list_append(held, {{'lat': lat, 'lon': lon, 'n': 1::BIGINT, 'f': id}})
                ELSE [CASE WHEN j = hit THEN {{'lat': (held[j].lat * held[j].n + lat) / (held[j].n + 1), 'lon': (held[j].lon * held[j].n + lon) / (held[j].n + 1), 'n': held[j].n + 1, 'f': held[j].f}} ELSE held[j] END FOR j IN range(1, len(held) + 1)] END
            FROM (SELECT r.k, p.i, p.id, p.lat, p.lon, r.held, coalesce(list_position([{HAVERSINE(geo.AUTHALIC_RADIUS, 'x.lat', 'x.lon', 'p.lat', 'p.lon')} <= 250000 FOR x IN r.held], true), 0) AS hit
                  FROM r JOIN p ON p.k = r.k AND p.i = r.i + 1)),
        f AS (SELECT k, unnest(held) AS h FROM r WHERE i = (SELECT max(i) FROM p WHERE p.k = r.k))
        SELECT k AS c_nationkey, h.f AS first, round(h.lat, 7) AS lat, round(h.lon, 7) AS lon, h.n AS count FROM f""",
    "terrain_profile": f"""WITH {_GRID_SQL}, v AS (SELECT * FROM g WHERE col + 0.5 BETWEEN 0 AND 10 AND row + 0.5 BETWEEN 0 AND 9.5), s AS (SELECT grid, max(row) + 1 AS rows, max(col) + 1 AS cols FROM v GROUP BY grid),
        p AS (SELECT c_custkey, c_custkey % 20 AS grid, j, (c_custkey * 37 + j * 41) % 90 / 10.0::DOUBLE + 0.5::DOUBLE AS x, (c_custkey * 53 + j * 29) % 90 / 10.0::DOUBLE + 0.5::DOUBLE AS y FROM customer, range(0, 3) r(j)),
        l AS (SELECT a.c_custkey, a.grid, a.j, a.x, a.y, b.x - a.x AS dx, b.y - a.y AS dy, sqrt((b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y)) AS size FROM p a JOIN p b ON a.c_custkey = b.c_custkey AND b.j = a.j + 1),
        k AS (SELECT *, CAST(greatest(2, ceil(size / 0.4::DOUBLE)) AS BIGINT) AS n, CASE WHEN j = 0 THEN 0 ELSE lag(size) OVER (PARTITION BY c_custkey ORDER BY j) END AS before FROM l),
        m AS (SELECT *, unnest(range(CASE WHEN j = 0 THEN 0 ELSE 1 END, n + 1)) AS i FROM k),
        d AS (SELECT c_custkey, grid, j, i, x + i::DOUBLE / n * dx AS x, y + i::DOUBLE / n * dy AS y, before + i::DOUBLE / n * size AS distance FROM m),
        q AS (SELECT d.*, rows, cols, CAST(floor(x - 0.5::DOUBLE) AS BIGINT) AS c0, CAST(floor(y - 0.5::DOUBLE) AS BIGINT) AS r0, x - 0.5::DOUBLE - c0 AS fx, y - 0.5::DOUBLE - r0 AS fy,
              c0 >= 0 AND r0 >= 0 AND c0 + 1 < cols AND r0 + 1 < rows AS four FROM d LEFT JOIN s USING (grid)),
        e AS (SELECT q.c_custkey, j, i, distance, CASE WHEN x < 0 OR y < 0 OR x > cols OR y > rows THEN NULL
                WHEN four THEN (v1.value * (1 - fx) + v2.value * fx) * (1 - fy) + (v3.value * (1 - fx) + v4.value * fx) * fy ELSE v5.value END AS value FROM q
              LEFT JOIN v v1 ON v1.grid = q.grid AND v1.row = r0 AND v1.col = c0 LEFT JOIN v v2 ON v2.grid = q.grid AND v2.row = r0 AND v2.col = c0 + 1
              LEFT JOIN v v3 ON v3.grid = q.grid AND v3.row = r0 + 1 AND v3.col = c0 LEFT JOIN v v4 ON v4.grid = q.grid AND v4.row = r0 + 1 AND v4.col = c0 + 1
              LEFT JOIN v v5 ON v5.grid = q.grid AND v5.row = least(greatest(floor(y), 0), rows - 1) AND v5.col = least(greatest(floor(x), 0), cols - 1)),
        o AS (SELECT *, row_number() OVER w - 1 AS place, count(*) OVER (PARTITION BY c_custkey) AS total FROM e
              WHERE c_custkey NOT IN (SELECT c_custkey FROM e WHERE value IS NULL) WINDOW w AS (PARTITION BY c_custkey ORDER BY j, i)),
        u AS (SELECT * FROM o WHERE total <= 50 OR list_contains([round_even(t * (total - 1) / 49.0::DOUBLE, 0) FOR t IN range(0, 50)], place)),
        z AS (SELECT *, value - lag(value) OVER w AS rise, distance - lag(distance) OVER w AS run FROM u WINDOW w AS (PARTITION BY c_custkey ORDER BY place))
        SELECT c_custkey, round(max(distance), 6) AS length, round(sum(greatest(rise, 0)), 6) AS climb, round(sum(greatest(-rise, 0)), 6) AS descent, round(max(value) - min(value), 6) AS relief,
            round(max(CASE WHEN run > 0 THEN abs(rise) / run END), 6) AS steepest FROM z GROUP BY c_custkey""",
    "containment": f"""WITH v AS (SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS x FROM embeddings),
        n AS (SELECT a.vec_id, a.x, CASE WHEN a.vec_id % 3 = 0 THEN {_listed('a.x', ar.panel_places(8, 8, ar.PANELS[4], 8))} ELSE b.x END AS y FROM v a JOIN v b ON b.vec_id = a.vec_id + 1),
        p AS (SELECT vec_id, {_PANEL_SQL} FROM n),
        s AS (SELECT vec_id, greatest(0, {", ".join(_ncc(f"x{i}", "y5") for i in range(6))}) AS ab, greatest(0, {", ".join(_ncc(f"y{i}", "x5") for i in range(6))}) AS ba FROM p)
        SELECT vec_id, CASE WHEN ab >= ba AND ab >= 0.82::DOUBLE THEN 'a_contains_b' WHEN ba > ab AND ba >= 0.82::DOUBLE THEN 'b_contains_a' ELSE 'none' END AS kind, round(greatest(ab, ba), 6) AS score FROM s""",
}

QUERIES = {f.__name__: f for f in (near_duplicate_drop, change_regions, moving_centroids, terrain_profile, containment)}
