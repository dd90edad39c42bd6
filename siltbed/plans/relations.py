"""Shapes of customers and suppliers: relations, distances and widths, from GeoJSON texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.functions import geometry as gm
from siltbed.operators import hulls
from siltbed.operators import shapes as sh
from siltbed.sources import fixtures as fx
from siltbed.stages import numbered, staged

# Hundredths of a degree: a supplier's ring with a hole, and a customer's line, box and large box.
OUTER, HOLE = (0, 0, 100, 80), (20, 20, 60, 50)
WIDE, TALL, BOX, LARGE = 60, 45, (30, 20), (140, 120)


def _json(kind: str, *rings: list[tuple[int, int]] | tuple[int, int]) -> Column:
    """A geometry's text; places are given in hundredths from (X, Y)."""

    def place(at: tuple[int, int]) -> list[Column]:
        return [F.lit("["), ((F.col("X") + at[0]) / 100.0).cast("string"), F.lit(","), ((F.col("Y") + at[1]) / 100.0).cast("string"), F.lit("]")]

    def nested(x) -> list[Column]:
        if isinstance(x, tuple):
            return place(x)
        out = [F.lit("[")]
        for i, item in enumerate(x):
            out += [F.lit(",")] * bool(i) + nested(item)
        return [*out, F.lit("]")]

    body = rings[0] if kind in ("Point", "LineString") else list(rings)
    return F.concat(F.lit(f'{{"type":"{kind}","coordinates":'), *nested(body), F.lit("}"))


def _ring(west: int, south: int, east: int, north: int) -> list[tuple[int, int]]:
    return [(west, south), (east, south), (east, north), (west, north), (west, south)]


def _places(df: DataFrame, key: Column) -> DataFrame:
    return df.select(key.alias("id"), (key * 37 % 2000 + 10000).alias("X"), (key * 53 % 3000 + 2000).alias("Y"))


def customer_shapes(spark: SparkSession, sf: str) -> DataFrame:
    """id and text: a point, a line to the east, a line to the north, a box or a large box, by turns."""
    kind = F.col("id") % 5
    text = (
        F.when(kind == 0, _json("Point", (0, 0))).when(kind == 1, _json("LineString", [(0, 0), (WIDE, 0)])).when(kind == 2, _json("LineString", [(0, 0), (0, TALL)]))
        .when(kind == 3, _json("Polygon", _ring(0, 0, *BOX))).otherwise(_json("Polygon", _ring(0, 0, *LARGE)))
    )
    return _places(fx.table(spark, sf, "customer"), F.col("c_custkey")).select("id", text.alias("text"))


def supplier_shapes(spark: SparkSession, sf: str) -> DataFrame:
    text = _json("Polygon", _ring(*OUTER), _ring(*HOLE))
    return _places(fx.table(spark, sf, "supplier"), F.col("s_suppkey")).select("id", text.alias("text"))


def _shapes(df: DataFrame) -> DataFrame:
    """id, shape; each text is read once, however many have it."""
    texts, ids = numbered(df, ["text"], "kind", "texts")
    return ids.join(staged(gm.with_shape(texts, "text").select("kind", "shape"), "texts-shapes"), "kind").select("id", "shape")


def spatial_relations(spark: SparkSession, sf: str) -> DataFrame:
    """How each customer's shape and each supplier's ring with a hole lie, where they have a common place."""
    found = sh.relate(_shapes(customer_shapes(spark, sf)), _shapes(supplier_shapes(spark, sf)))
    return found.where("intersects").select("left_id", "right_id", "within", "contains", "crosses")


def near_shapes(spark: SparkSession, sf: str) -> DataFrame:
    """Customers' shapes at most 20 km from suppliers' rings with holes."""
    found = sh.near(_shapes(customer_shapes(spark, sf)), _shapes(supplier_shapes(spark, sf)), 20_000.0)
    return found.select("left_id", "right_id", F.round("distance", 3).alias("distance"))


def shape_widths(spark: SparkSession, sf: str) -> DataFrame:
    """Sides of the least rectangle around each customer's box."""
    return hulls.widths(_shapes(customer_shapes(spark, sf))).select("id", F.round("width", 3).alias("width"), F.round("length", 3).alias("length"))


_LINE = """SELECT l.id, r.id AS right_id, l.{along} AS lo, l.{along} + {size} AS hi, l.{across} AS v, r.{along} + {o0} AS o1, r.{along} + {o2} AS o2, r.{across} + {o1} AS w1, r.{across} + {o3} AS w2,
    r.{along} + {h0} AS h1, r.{along} + {h2} AS h2, r.{across} + {h1} AS g1, r.{across} + {h3} AS g2 FROM l JOIN r ON l.kind = {kind}
    AND l.{along} + {size} >= r.{along} + {o0} AND l.{along} <= r.{along} + {o2} AND l.{across} BETWEEN r.{across} + {o1} AND r.{across} + {o3}"""


def _line(kind: int, along: str, size: int) -> str:
    turn = (0, 1, 2, 3) if along == "X" else (1, 0, 3, 2)
    numbers = {f"{n}{i}": box[t] for n, box in (("o", OUTER), ("h", HOLE)) for i, t in enumerate(turn)}
    return _LINE.format(along=along, across="Y" if along == "X" else "X", size=size, kind=kind, **numbers)


_H = ", ".join(f"r.{a} + {v} AS {n}" for a, v, n in zip("XYXY", HOLE, ("h1", "k1", "h2", "k2"), strict=True))


def _box(kind: int, size: tuple[int, int]) -> str:
    w, h = size
    return f"""SELECT l.id AS left_id, r.id AS right_id, l.X >= r.X AND l.Y >= r.Y AND l.X + {w} <= r.X + {OUTER[2]} AND l.Y + {h} <= r.Y + {OUTER[3]}
            AND (l.X + {w} <= r.X + {HOLE[0]} OR l.X >= r.X + {HOLE[2]} OR l.Y + {h} <= r.Y + {HOLE[1]} OR l.Y >= r.Y + {HOLE[3]}) AS within,
        r.X >= l.X AND r.Y >= l.Y AND r.X + {OUTER[2]} <= l.X + {w} AND r.Y + {OUTER[3]} <= l.Y + {h} AS contains, false AS crosses
        FROM l JOIN r ON l.kind = {kind} AND l.X <= r.X + {OUTER[2]} AND l.X + {w} >= r.X AND l.Y <= r.Y + {OUTER[3]} AND l.Y + {h} >= r.Y
        AND NOT (l.X > r.X + {HOLE[0]} AND l.X + {w} < r.X + {HOLE[2]} AND l.Y > r.Y + {HOLE[1]} AND l.Y + {h} < r.Y + {HOLE[3]})"""


ORACLE_SQL = {
    "spatial_relations": f"""WITH l AS (SELECT c_custkey AS id, c_custkey % 5 AS kind, c_custkey * 37 % 2000 + 10000 AS X, c_custkey * 53 % 3000 + 2000 AS Y FROM customer),
        r AS (SELECT s_suppkey AS id, s_suppkey * 37 % 2000 + 10000 AS X, s_suppkey * 53 % 3000 + 2000 AS Y FROM supplier),
        dots AS (SELECT l.id AS left_id, r.id AS right_id, l.X AS x, l.Y AS y, r.X AS rx, r.Y AS ry, {_H} FROM l JOIN r ON l.kind = 0
            AND l.X BETWEEN r.X AND r.X + {OUTER[2]} AND l.Y BETWEEN r.Y AND r.Y + {OUTER[3]}),
        lines AS ({_line(1, "X", WIDE)} UNION ALL {_line(2, "Y", TALL)}),
        seen AS (SELECT *, greatest(lo, o1) AS p1, least(hi, o2) AS p2, v > g1 AND v < g2 AND lo < h2 AND hi > h1 AS in_hole FROM lines),
        lines_found AS (SELECT id AS left_id, right_id, lo >= o1 AND hi <= o2 AND v > w1 AND v < w2 AND NOT in_hole AS within, false AS contains,
            v > w1 AND v < w2 AND p1 < p2 AND NOT (v BETWEEN g1 AND g2 AND p1 >= h1 AND p2 <= h2) AND (lo < o1 OR hi > o2 OR in_hole) AS crosses
            FROM seen WHERE NOT (v > g1 AND v < g2 AND p1 > h1 AND p2 < h2))
        SELECT left_id, right_id, x > rx AND x < rx + {OUTER[2]} AND y > ry AND y < ry + {OUTER[3]} AND NOT (x BETWEEN h1 AND h2 AND y BETWEEN k1 AND k2) AS within, false AS contains, false AS crosses
        FROM dots WHERE NOT (x > h1 AND x < h2 AND y > k1 AND y < k2)
        UNION ALL SELECT * FROM lines_found UNION ALL {_box(3, BOX)} UNION ALL {_box(4, LARGE)}""",
}

QUERIES = {f.__name__: f for f in (spatial_relations, near_shapes, shape_widths)}
