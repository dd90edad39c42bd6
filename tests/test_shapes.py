"""Shapes: what JSON means, relations with holes and touching edges, distances, hulls and least rectangles."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltbed.functions import geometry as gm
from siltbed.operators import hulls
from siltbed.operators import shapes as sh


def ring(*corners):
    return [list(map(float, c)) for c in [*corners, corners[0]]]


def polygon(*rings):
    return {"type": "Polygon", "coordinates": list(rings)}


def line(*points):
    return {"type": "LineString", "coordinates": [list(p) for p in points]}


def point(*at):
    return {"type": "Point", "coordinates": list(at)}


SQUARE = ring((0, 0), (2, 0), (2, 2), (0, 2))
INNER = ring((0.5, 0.5), (1.5, 0.5), (1.5, 1.5), (0.5, 1.5))
SHAPES = {
    "square": polygon(SQUARE), "inner": polygon(INNER), "donut": polygon(SQUARE, INNER), "beside": polygon(ring((2, 0), (3, 0), (3, 2), (2, 2))),
    "corner": polygon(ring((2, 2), (3, 2), (3, 3), (2, 3))), "over": polygon(ring((1, 1), (3, 1), (3, 1.5), (1, 1.5))), "away": polygon(ring((5, 5), (6, 5), (6, 6))),
    "strip": polygon(ring((0, 0.1), (2, 0.1), (2, 0.4), (0, 0.4))), "two": {"type": "MultiPolygon", "coordinates": [[SQUARE], [ring((5, 5), (6, 5), (6, 6))]]},
    "turned": polygon(SQUARE[::-1]), "across": line((-1, 1), (3, 1)), "into": line((1, 0.2), (1, 5)), "through": line((0, 0.2), (2, 0.2)), "rim": line((0, 0), (2, 0)),
    "part": line((0.5, 0), (1.5, 0)), "cross": line((1, -1), (1, 1)), "tee": line((1, 0), (1, -1)), "apart": line((10, 10), (11, 11)), "in_hole": point(1, 1), "on_hole": point(0.5, 1),
    "dot": point(0.2, 0.2), "end": point(0, 0), "mid": point(1, 0), "dots": {"type": "MultiPoint", "coordinates": [[0.2, 0.2], [9, 9]]},
    "bent": {"type": "MultiLineString", "coordinates": [[[0.0, 0.0], [1.0, 0.0]], [[1.0, 0.0], [2.0, 0.0]]]},
}

#: (left, right) -> the relations that hold.
EXPECTED = {
    ("inner", "square"): "within intersects", ("square", "inner"): "contains intersects", ("donut", "square"): "within intersects", ("square", "donut"): "contains intersects",
    ("inner", "donut"): "intersects", ("square", "turned"): "within contains intersects", ("beside", "square"): "intersects", ("corner", "square"): "intersects", ("over", "square"): "intersects",
    ("away", "square"): "", ("away", "two"): "within intersects", ("two", "square"): "contains intersects", ("strip", "donut"): "within intersects", ("strip", "square"): "within intersects",
    ("across", "square"): "intersects crosses", ("across", "donut"): "intersects crosses", ("into", "square"): "intersects crosses", ("through", "square"): "within intersects",
    ("through", "donut"): "within intersects", ("rim", "square"): "intersects", ("square", "across"): "intersects crosses", ("square", "through"): "contains intersects",
    ("part", "rim"): "within intersects", ("rim", "part"): "contains intersects", ("cross", "rim"): "intersects crosses", ("tee", "rim"): "intersects", ("rim", "tee"): "intersects",
    ("rim", "bent"): "within contains intersects", ("apart", "rim"): "", ("in_hole", "donut"): "", ("on_hole", "donut"): "intersects", ("in_hole", "square"): "within intersects",
    ("dot", "donut"): "within intersects", ("donut", "dot"): "contains intersects", ("end", "rim"): "intersects", ("mid", "rim"): "within intersects", ("mid", "bent"): "within intersects",
    ("dots", "square"): "intersects crosses", ("square", "dots"): "intersects crosses", ("dot", "dots"): "within intersects", ("dots", "dot"): "contains intersects", ("end", "square"): "intersects",
    ("into", "donut"): "intersects crosses", ("cross", "across"): "intersects", ("across", "into"): "intersects crosses",
}


def table(spark, found):
    rows = spark.createDataFrame([(k, json.dumps(v)) for k, v in found.items()], "id string, text string")
    return gm.with_shape(rows, "text").select("id", "shape")


@pytest.fixture(scope="module")
def relations(spark):
    rows = table(spark, SHAPES)
    names = ("within", "contains", "intersects", "crosses")
    return {(r["left_id"], r["right_id"]): " ".join(n for n in names if r[n]) for r in sh.relate(rows, rows, 1.0, 0.4).collect()}


@pytest.mark.parametrize("pair", sorted(EXPECTED))
def test_relations(relations, pair):
    assert relations.get(pair, "") == EXPECTED[pair]
    swapped = {"within": "contains", "contains": "within"}
    assert sorted(relations.get(pair[::-1], "").split()) == sorted(swapped.get(r, r) for r in EXPECTED[pair].split())


def test_cells_do_not_matter(spark, relations):
    rows = table(spark, SHAPES)
    names = ("within", "contains", "intersects", "crosses")
    again = {(r["left_id"], r["right_id"]): " ".join(n for n in names if r[n]) for r in sh.relate(rows, rows, 7.3, 0.013).collect()}
    assert again == relations
    assert {(r[0], r[1]) for r in sh.related(rows, rows, "crosses").collect()} == {k for k, v in relations.items() if "crosses" in v}


def test_odd_shapes(spark):
    rows = spark.createDataFrame([(1, None), (None, '{"type":"Point","coordinates":[1,1]}'), (2, "{"), (3, '{"type":"Point","coordinates":[1]}'),
                                  (4, '{"type":"Polygon","coordinates":[]}'), (5, '[1, 1]'), (5, '[1, 1]'), (6, "")], "id long, text string")
    shapes = gm.with_shape(rows, "text").select("id", "shape", F.lit(0).alias("x"), F.lit("q").alias("a"))
    assert [r["id"] for r in shapes.where("shape IS NOT NULL").collect() if r["id"]] == [5, 5]
    assert [(r["left_id"], r["right_id"], r["within"]) for r in sh.relate(shapes, shapes).collect()] == [(5, 5, True)]
    assert sh.relate(shapes.limit(0), shapes).count() == 0 and sh.near(shapes, shapes.limit(0), 10.0).count() == 0
    with pytest.raises(ValueError):
        sh.near(shapes, shapes, 3e6)


@pytest.mark.parametrize(
    ("text", "points", "lines", "rings"),
    [
        ('{"type":"Feature","geometry":{"type":"Point","coordinates":[1,2]}}', [(1, 2)], 0, 0),
        ('{"lat": 2, "lng": 1}', [(1, 2)], 0, 0),
        ("[1, 2]", [(1, 2)], 0, 0),
        ("[0, 0, 2, 1]", [], 0, 1),
        ('{"west":0,"south":0,"east":2,"north":1}', [], 0, 1),
        ('{"type":"GeometryCollection","geometries":[{"type":"Point","coordinates":[1,2]},{"type":"LineString","coordinates":[[0,0],[1,1]]}]}', [(1, 2)], 1, 0),
        ('{"geometry":{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[1,1]]],[[[5,5],[6,5],[6,6],[5,5]]]]}}', [], 0, 2),
    ],
)
def test_parsed(spark, text, points, lines, rings):
    row = gm.with_shape(spark.createDataFrame([(text,)], "t string"), "t").first()["shape"]
    assert ([tuple(p) for p in row["points"]], len(row["lines"]), len(row["rings"])) == (points, lines, rings)
    assert all(r["points"][0] == r["points"][-1] for r in row["rings"])


@pytest.mark.parametrize(("text", "n"), [('{"type":"FeatureCollection","features":[{"id":1},{"id":2}]}', 2), ('{"result":{"elements":[{"id":1}]}}', 1), ('[{"id":1},{"id":2},{"id":3}]', 3), ('{"type":"Point"}', 1)])
def test_features(spark, text, n):
    assert len(spark.createDataFrame([(text,)], "t string").select(gm.features_of(F.col("t")).alias("f")).first()["f"]) == n


def test_near(spark):
    # A degree of the meridian at the equator is 110,574 m long; of the equator 111,320 m.
    found = {"river": line((0.0, 0.0), (1.0, 0.0)), "bridge": line((0.5, -0.1), (0.5, 0.1)), "pole": point(0.5, 0.001), "field": polygon(ring((0.2, 0.01), (0.4, 0.01), (0.4, 0.03), (0.2, 0.03))), "well": point(0.3, 0.02), "far": point(0.5, 0.05)}
    rows = table(spark, found)
    got = {(r["left_id"], r["right_id"]): r["distance"] for r in sh.near(rows, rows, 2000.0).collect()}
    assert got["river", "pole"] == pytest.approx(110.574, abs=0.01) and got["river", "bridge"] == 0 and got["field", "well"] == 0
    assert got["river", "field"] == pytest.approx(1105.74, abs=0.5) and got["well", "field"] == 0
    assert ("river", "far") not in got and ("far", "river") not in got
    assert all(got[b, a] == pytest.approx(d, abs=1e-6) for (a, b), d in got.items())
    # Flinders Peak to Buninyong: 54,972.271 m on the ellipsoid; the plane around the middle keeps it.
    ends = table(spark, {"f": point(144 + 25 / 60 + 29.52440 / 3600, -(37 + 57 / 60 + 3.72030 / 3600)), "b": point(143 + 55 / 60 + 35.38390 / 3600, -(37 + 39 / 60 + 10.15610 / 3600))})
    got = {(r["left_id"], r["right_id"]): r["distance"] for r in sh.near(ends, ends, 60_000.0).collect()}
    assert got["f", "b"] == pytest.approx(54_972.271, abs=2.0)


def test_least_rectangle_by_angles():
    rng = np.random.default_rng(5)
    for n in (3, 5, 40):
        points = rng.normal(size=(n, 2)) @ np.array([[3, 1], [0, 1]])
        short, long = hulls.least_rectangle(hulls.hull(points))
        turns = np.linspace(0, math.pi / 2, 20_001)
        spans = [np.ptp(points @ np.stack([np.cos(turns + d), np.sin(turns + d)]), axis=0) for d in (0, math.pi / 2)]
        assert short * long <= (spans[0] * spans[1]).min() + 1e-9
        assert short * long == pytest.approx((spans[0] * spans[1]).min(), rel=1e-3)
        inside = hulls.hull(np.concatenate([points, points.mean(axis=0, keepdims=True)]))
        assert np.array_equal(inside, hulls.hull(points))


def test_widths(spark):
    turn = math.radians(30)
    corners = [(u * math.cos(turn) - v * math.sin(turn), u * math.sin(turn) + v * math.cos(turn)) for u, v in ((0, 0), (1000, 0), (1000, 200), (500, 100), (0, 200))]
    turned = polygon(ring(*[(8 + x / (111_320 * math.cos(math.radians(46.0))), 46 + y / 111_150) for x, y in corners]))
    flat = polygon(ring((0, 0), (1, 0), (2, 0)))
    got = {r["id"]: (r["width"], r["length"]) for r in hulls.widths(table(spark, {"turned": turned, "flat": flat, "dot": point(1, 1)})).collect()}
    assert got["turned"] == pytest.approx((200, 1000), rel=3e-3) and got["flat"] == (None, None) and "dot" not in got
    many = spark.range(40_000).select((F.col("id") % 3).alias("id"), F.cos("id").alias("x"), (F.sin("id") * 2).alias("y")).repartition(7)
    assert {r["id"]: (round(r["short"], 2), round(r["long"], 2)) for r in hulls.rectangles(many).collect()} == {i: (2.0, 4.0) for i in range(3)}
