"""Ordered and connected things against plain loops: hashes, regions, clusters, paths, parts of pictures."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltbed.functions import arrays as ar
from siltbed.functions import geo
from siltbed.operators import clusters, hashes, rasters, terrain


@pytest.mark.parametrize("distance", [0, 2, 5])
def test_near_dropped_is_the_loop(spark, distance):
    rng = random.Random(distance)
    base = [rng.getrandbits(64) - (1 << 63) for _ in range(6)]
    rows = []
    for i in range(300):
        h = base[rng.randrange(6)]
        for _ in range(rng.randrange(7)):
            h ^= 1 << rng.randrange(63)
        rows.append((i, rng.choice(["a", "b", None]), None if i % 50 == 7 else h, "x"))
    want, seen = {}, {}
    for i, k, h, _ in rows:
        near = h is not None and any(((h ^ o) & (2**64 - 1)).bit_count() <= distance for o in seen.get(k, []))
        want[i] = not near
        if h is not None and not near:
            seen.setdefault(k, []).append(h)
    table = spark.createDataFrame(rows, "id long, k string, hash long, place string").repartition(5)
    got = hashes.near_dropped(table, "k", "id", "hash", distance)
    assert got.columns == [*table.columns, "kept"] and {r["id"]: r["kept"] for r in got.collect()} == want
    assert hashes.near_dropped(table.limit(0), "k", "id", "hash", distance).count() == 0


def brute_regions(cells, least=16, top=8):
    def flood(start, free, moves):
        found, open_ = {start}, [start]
        while open_:
            r, c = open_.pop()
            for dr, dc in moves:
                p = (r + dr, c + dc)
                if p not in found and free(p):
                    found.add(p)
                    open_.append(p)
        return found

    sides = [(0, 1), (1, 0), (0, -1), (-1, 0)]
    around = sides + [(1, 1), (1, -1), (-1, 1), (-1, -1)]
    left, regions = set(cells), []
    while left:
        one = flood(min(left), cells.__contains__, around)
        left -= one
        regions.append(one)
    size = max(max(p) for p in cells) + 1
    air = [flood((-1, -1), lambda p, own=own: p not in own and -1 <= min(p) and max(p) <= size, sides) for own in regions]
    out = []
    for own in regions:
        if all(min(own) in air[j] for j, other in enumerate(regions) if other is not own):
            rows, cols = [p[0] for p in own], [p[1] for p in own]
            box = (min(cols), min(rows), max(cols) + 1, max(rows) + 1)
            area = (box[2] - box[0]) * (box[3] - box[1])
            out += [(-area, min(own), box)] * (area >= least)
    return [box for _, _, box in sorted(out)[:top]]


def test_regions_are_flooded(spark):
    rng = random.Random(2)
    ring = {(r, c) for r in range(10) for c in range(10) if r in (0, 9) or c in (0, 9)}
    shapes = {
        "ring": ring | {(r, c) for r in range(3, 7) for c in range(3, 7)}, "open": (ring - {(0, 4)}) | {(r, c) for r in range(3, 7) for c in range(3, 7)},
        "snake": {(r, c) for r in range(0, 21, 2) for c in range(20)} | {(r, 0 if r % 4 == 1 else 19) for r in range(1, 20, 2)},
        "noise": {(r, c) for r in range(40) for c in range(40) if rng.random() < 0.3}, "stairs": {(i, i) for i in range(30)}, "dot": {(5, 5)},
    }
    rows = [(k, r, c, r) for k, cells in shapes.items() for r, c in cells]
    table = spark.createDataFrame(rows + rows[:5] + [("ring", None, 1, 0)], "k string, row int, col int, label int")
    got = {}
    for r in rasters.change_regions(table, "k", tile=7).orderBy("k", "rank").collect():
        got.setdefault(r["k"], []).append((r["west"], r["north"], r["east"], r["south"]))
    assert got == {k: b for k, c in shapes.items() if (b := brute_regions(c))}


def loop_clusters(points, metres):
    held = []
    for o, lat, lon in sorted(points):
        for g in held:
            a, b = math.radians(lat - g[1]), math.radians(lon - g[2])
            chord = math.sin(a / 2) ** 2 + math.cos(math.radians(lat)) * math.cos(math.radians(g[1])) * math.sin(b / 2) ** 2
            if 2 * geo.AUTHALIC_RADIUS * math.asin(math.sqrt(chord)) <= metres:
                g[3] += 1
                g[1], g[2] = (g[1] * (g[3] - 1) + lat) / g[3], (g[2] * (g[3] - 1) + lon) / g[3]
                break
        else:
            held.append([o, lat, lon, 1])
    return {(o, round(a, 7), round(b, 7), n) for o, a, b, n in held}


def test_moving_centroids_are_the_loop(spark):
    rng = np.random.default_rng(8)
    rows = []
    for k, spread, where in (("dense", 0.02, (48.0, 11.0)), ("wide", 3.0, (-30.0, 20.0)), ("polar", 8.0, (70.0, 30.0)), (None, 0.1, (0.0, 179.0))):
        middles = rng.normal(size=(5, 2)) * spread * 3 + where
        rows += [(k, int(i), float(a), float(b)) for i, (a, b) in enumerate(middles[rng.integers(0, 5, 120)] + rng.normal(size=(120, 2)) * spread)]
    table = spark.createDataFrame(rows + [("dense", 999, None, 1.0)], "k string, n long, lat double, lon double").repartition(4)
    for metres in (900.0, 60_000.0):
        got = {}
        for r in clusters.moving_centroids(table, "k", "n", metres).collect():
            got.setdefault(r["k"], set()).add((r["first"], round(r["lat"], 7), round(r["lon"], 7), r["count"]))
        assert got == {k: loop_clusters([x[1:] for x in rows if x[0] == k], metres) for k in {x[0] for x in rows}}
    parts = clusters.pieces(table.where("k = 'wide' AND lat IS NOT NULL"), "k", 900.0).select("piece").distinct().count()
    assert parts > 20
    assert clusters.moving_centroids(table.limit(0), "k", "n", 10.0).count() == 0


def test_profile(spark):
    cells = spark.createDataFrame([(1, r, c, float(c)) for r in range(4) for c in range(10)], "grid int, row int, col int, value double")
    paths = spark.createDataFrame([("a", 1, 0, 1.0, 1.0), ("a", 1, 1, 5.0, 1.0), ("a", 1, 2, 5.0, 1.0), ("a", 1, 3, 2.0, 1.0), ("one", 1, 0, 3.5, 2.0), ("out", 1, 0, 1.0, 1.0), ("out", 1, 1, 30.0, 1.0)],
                                  "p string, grid int, n int, x double, y double")
    found = terrain.profile(paths, cells, "p", "n", 1.0)
    rows = [(round(r["x"], 9), round(r["distance"], 9), round(r["value"], 9)) for r in found.where("p = 'a'").orderBy("place").collect()]
    assert rows[:5] == [(1, 0, 0.5), (2, 1, 1.5), (3, 2, 2.5), (4, 3, 3.5), (5, 4, 4.5)] and rows[-1] == (2, 7, 1.5)
    assert [tuple(r)[1:] for r in found.where("p = 'one'").collect()] == [(1, 3.5, 2.0, 0.0, 3.0)]
    assert found.where("p = 'out'").count() == 0
    s = terrain.profile_summary(found, "p").where("p = 'a'").first()
    assert [round(s[c], 9) for c in ("length", "climb", "descent", "relief", "steepest")] == [7, 4, 3, 4, 1]
    assert terrain.clipped(cells, 2.0, 0.0, 4.0, 1.0, (1.0, 0.0, 0.0, 0.0, 1.0, 0.0)).count() == 2


def test_containment(spark):
    rng = np.random.default_rng(3)
    whole = rng.random((12, 16))
    part = whole[:, :8]
    rows = [(1, whole.ravel().tolist(), np.repeat(part, 2, axis=1).ravel().tolist()), (2, np.repeat(part, 2, axis=1).ravel().tolist(), whole.ravel().tolist()),
            (3, rng.random(192).tolist(), rng.random(192).tolist()), (4, [1.0] * 192, [1.0] * 192)]
    table = spark.createDataFrame(rows, "id int, a array<double>, b array<double>")
    got = {r["id"]: r["c"] for r in table.select("id", ar.containment(F.col("a"), F.col("b"), 12, 16, 6).alias("c")).collect()}
    assert [got[i]["kind"] for i in (1, 2, 3, 4)] == ["a_contains_b", "b_contains_a", "none", "none"] and got[1]["score"] == pytest.approx(1)
