"""Rules that SQL does not hold: brute force on small fixtures."""

import random
from math import asin, cos, radians, sin, sqrt

import pytest
from pyspark.sql import functions as F

from siltbed.functions import geo, sky
from siltbed.functions import text as tx
from siltbed.operators import dedup, elements, intervals, series, spatial, tasks


def metres(a, b):
    (la, lo), (lb, mo) = a, b
    h = sin(radians(lb - la) / 2) ** 2 + cos(radians(la)) * cos(radians(lb)) * sin(radians(mo - lo) / 2) ** 2
    return 2 * geo.MEAN_RADIUS * asin(min(1, sqrt(h)))


@pytest.mark.parametrize("reach", [2_500.0, 60_000.0])
def test_near_join_anywhere(spark, reach):
    """At the poles, at high latitudes and across 180 degrees."""
    rng = random.Random(2)
    near = lambda lat, lon, d: (max(-90.0, min(90.0, lat + rng.uniform(-d, d))), (lon + rng.uniform(-9 * d, 9 * d) + 180) % 360 - 180)
    d = reach / 60_000
    left = [(rng.choice((80.0, 89.9, -89.95, 0.0, 60.0, -45.0)), rng.choice((179.99, -179.999, 0.0, 12.0))) for _ in range(150)]
    left = [near(*p, d) for p in left]
    right = [near(*p, d) for p in left]
    want = {(i, j) for i, p in enumerate(left) for j, q in enumerate(right) if metres(p, q) <= reach}
    frames = [spark.createDataFrame([(i, *p) for i, p in enumerate(side)], "id long, lat double, lon double") for side in (left, right)]
    rows = spatial.near_join(*frames, reach).collect()
    assert sorted((r["left_id"], r["right_id"]) for r in rows) == sorted(want) and len(want) > 100


def plain_chunks(segments, window, duration):
    out = []
    for s, e in sorted((max(0.0, s), min(duration, e)) for s, e in segments):
        if e <= s:
            continue
        if out and e - out[-1][0] <= window * 1.25:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    if out and out[0][0] > 0.5:
        out.insert(0, [0.0, out[0][0]])
    if out and out[-1][1] < duration - 0.5:
        out.append([out[-1][1], duration])
    return [tuple(x) for x in out]


def test_chunks_are_the_rule(spark):
    rng = random.Random(3)
    rows, want = [], []
    for k in range(30):
        at, own = rng.choice((0.0, 3.0)), []
        for _ in range(rng.randrange(1, 40)):
            own.append((at, at + rng.choice((0.0, 2.0, 5.0, 17.0, 40.0))))
            at += rng.choice((0.5, 1.0, 6.0, 50.0))
        duration = at - rng.choice((0.0, 10.0)) + rng.choice((0.0, 20.0))
        rows += [(k, s, e, duration) for s, e in own]
        want += [(k, *x) for x in plain_chunks(own, 20.0, duration)]
    df = spark.createDataFrame(rows, "key long, start double, end double, duration double")
    got = intervals.chunked(df, "key", 20.0).collect()
    assert sorted((r["key"], r["start"], r["end"]) for r in got) == sorted(want)


@pytest.mark.parametrize(("url", "public"), [
    ("http://user@10.0.0.1/", False), ("http://user:x@example.com/", False), ("http://[::1]/", False), ("http://example.com", True), ("HTTPS://A.Example.com:443/x", True),
    ("ftp://example.com", False), ("http://localhost/", False), ("http://a.localhost./", False), ("http://printer.local/", False), ("http://127.0.0.1/", False), ("http://8.8.8.8:53/", True),
    ("http://100.64.0.1/", False), ("http://0x7f.1/", False), ("http://2130706433/", False), ("http://010.0.0.1/", False), ("http://example.com:99999999/", False), ("http:///x", False), ("http://", False), (None, False),
    ("http://1.2.3.4\\@10.0.0.1/", False), ("http://172.20.1.1/", False), ("http://203.0.113.9/", False),
])
def test_gate_fails_closed(spark, url, public):
    row = spark.createDataFrame([(url,)], "url string").select(tx.public_http(F.col("url")).alias("p")).first()
    assert row["p"] is public


def test_credential_fields(spark):
    fields = {"api_key": "x", "note": "Bearer\tabcdefghijklmnop1", "ok": "fine", "hash": "a" * 40}
    row = spark.createDataFrame([(fields,)], "f map<string,string>").select(tx.redacted_fields(F.col("f")).alias("f")).first()
    assert row["f"] == {"api_key": tx.REDACTED, "note": tx.REDACTED, "ok": "fine", "hash": "a" * 40}


def test_unknown_tags_are_an_error(spark):
    df = spark.createDataFrame([(1, "node", {"a": "1"}), (2, "way", {"a": "2", "b": None}), (3, "node", None)], "id long, osm_type string, tags map<string,string>")
    assert [r["id"] for r in elements.tag_filtered(df, {"a": "*"}, ("way",)).collect()] == [2]
    assert elements.tag_filtered(df, {"b": "*"}).count() == 0
    with pytest.raises(ValueError, match="unsupported_filter: c"):
        elements.tag_filtered(df, {"a": "*", "c": "1"})


def test_kept_stamps(spark):
    df = spark.createDataFrame([([5.0, 1.0, 1.0005, 5.0015, 99.0, -1.0],), ([],)], "t array<double>")
    rows = df.select(tasks.kept_stamps(F.col("t"), F.lit(0.0), F.lit(10.0), 5).alias("k")).collect()
    assert [r["k"] for r in rows] == [[5.0, 1.0, 5.0015], [5.0]]


def test_sun_over_known_places(spark):
    """Noon of the equinox on the equator, and a published low-precision case: 12 May 2000, 18:00 UTC, 40 N 75 W."""
    df = spark.createDataFrame([(953553600.0 + 440, 0.0, 0.0), (958154400.0, 40.0, -75.0)], "t double, lat double, lon double")
    up, turned = sky.sun_position(F.col("t"), F.col("lat"), F.col("lon"))
    noon, may = df.select(up.alias("up"), turned.alias("az")).collect()
    assert noon["up"] > 89.5
    assert 60 < may["up"] < 70 and 200 < may["az"] < 230


def test_greedy_matches_are_greedy(spark):
    rng = random.Random(4)
    pairs = sorted({(rng.randrange(30), 100 + rng.randrange(30)): rng.randrange(1000) / 1000 for _ in range(200)}.items())
    df = spark.createDataFrame([("x", a, b, s) for (a, b), s in pairs], "block string, left long, right long, similarity double")
    taken, want = set(), set()
    for (a, b), s in sorted(pairs, key=lambda x: (x[1], x[0]), reverse=True):
        if a not in taken and b not in taken:
            taken |= {a, b}
            want.add((a, b))
    rows = dedup.greedy_matches(df).collect()
    assert {(r["left"], r["right"]) for r in rows} == want


def plain_fold(rows, gap):
    """The fold of one key's segments, in order."""
    out = []
    for s, e, t in sorted((s, e, (t or "").strip(" ")) for s, e, t in rows):
        if out and s - out[-1][1] <= gap and (t in out[-1][2] or out[-1][2] in t):
            out[-1][1], out[-1][2] = max(out[-1][1], e), max(out[-1][2], t, key=len)
        elif t:
            out.append([s, e, t])
    return [tuple(x) for x in out]


def test_adjacent_segments_are_the_fold(spark):
    """A hot key, a null key, null and blank texts, equal rows and pauses, over small batches."""
    rng = random.Random(5)
    words = [None, "", " ", "a", "ab", "abc", "b", "bc", "x"]
    rows = []
    for _ in range(900):
        s = rng.randrange(0, 1500) / 4
        rows.append((rng.choice((1, 1, 1, 2, None)), s, s + rng.choice((0.1, 0.25, 0.5)), rng.choice(words)))
    rows += rows[:30]
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.createDataFrame(rows, "conv_id long, start double, end double, text string")
        got = intervals.adjacent_merged(df, "conv_id").collect()
        assert intervals.adjacent_merged(df.limit(0), "conv_id").collect() == []
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
    for key in (1, 2, None):
        want = plain_fold([r[1:] for r in rows if r[0] == key], 0.35)
        assert sorted((r["start"], r["end"], r["text"]) for r in got if r["conv_id"] == key) == sorted(want)


def test_geodesic_known_lines(spark):
    """A published line on its ellipsoid, a degree of the equator, a quarter meridian, one place, nulls, antipodes."""

    def degrees(d, m, s):
        return (abs(d) + m / 60 + s / 3600) * (-1 if d < 0 else 1)

    line = (degrees(-37, 57, 3.72030), degrees(144, 25, 29.52440), degrees(-37, 39, 10.15610), degrees(143, 55, 35.38390))
    rows = [(0, *line), (1, 0.0, 179.5, 0.0, -179.5), (2, 0.0, 0.0, 90.0, 0.0), (3, 12.0, 7.0, 12.0, 7.0), (4, None, 0.0, 1.0, 1.0), (5, -30.0, 0.0, 29.9, 179.8)]
    rows += [(6, 0.0, 0.0, 0.5, 179.7), (7, 0.5, 179.7, 0.0, 0.0), (8, 0.0, 10.0, 0.0, -170.0), (9, 29.9, 179.8, -30.0, 0.0), (10, 30.0, 0.0, -29.9, -179.8), (11, 90.0, 0.0, -90.0, 5.0)]
    df = spark.createDataFrame(rows, "id long, lat1 double, lon1 double, lat2 double, lon2 double")
    grs80, wgs84 = geo.geodesic(flattening=1 / 298.257222101), geo.geodesic()
    names = ("lat1", "lon1", "lat2", "lon2")
    got = {r["id"]: (r["grs"], r["wgs"]) for r in df.select("id", grs80(*names).alias("grs"), wgs84(*names).alias("wgs")).collect()}
    first = got[0][0]
    assert abs(first["metres"] - 54972.271) < 0.001
    assert abs(first["forward"] - degrees(306, 52, 5.37)) < 1e-5 and abs(first["back"] - degrees(127, 10, 25.07)) < 1e-5
    assert abs(got[1][1]["metres"] - 111319.4908) < 0.001 and abs(got[2][1]["metres"] - 10001965.729) < 0.001
    assert tuple(got[3][1]) == (0.0, None, None)
    assert tuple(got[4][1]) == (None, None, None)
    # Almost opposite places: published lines, and the same ones from their other ends and mirrored.
    far = {i: got[i][1] for i in range(5, 12)}
    for i, metres in ((5, 19989832.8276), (6, 19944127.421), (7, 19944127.421), (8, 20003931.4586), (9, 19989832.8276), (10, 19989832.8276), (11, 20003931.4586)):
        assert abs(far[i]["metres"] - metres) < 0.01
    assert abs(far[5]["forward"] - 161.890525) < 1e-4 and abs((far[5]["back"] + 180) % 360 - 18.090737) < 1e-4
    assert abs(far[9]["forward"] - far[5]["back"]) < 1e-6 and abs(far[9]["back"] - far[5]["forward"]) < 1e-6
    assert abs(far[7]["forward"] - far[6]["back"]) < 1e-6 and abs(far[7]["back"] - far[6]["forward"]) < 1e-6
    assert abs(far[10]["forward"] - (161.890525 + 180) % 360) < 1e-4


def test_dusk_at_the_equinox(spark):
    """On the equator at 20 March 2024 the sun sets at about 18:10:45 of the meridian; a polar night has no crossing."""
    start = 1710892800.0
    df = spark.createDataFrame([(0, start, 0.0, 0.0), (1, 1703116800.0, 89.0, 0.0)], "id long, start double, lat double, lon double")
    found = series.sun_crossings(df, "id", {"dusk": (sky.HORIZONS["sunset"], False), "dawn": (sky.HORIZONS["civil"], True)})
    (_, dusk, dawn), polar = found.orderBy("id").collect()
    assert abs(dusk - start - (18 * 3600 + 645)) < 60 and 5 * 3600 < dawn - start < 6 * 3600
    assert tuple(polar)[1:] == (None, None)
