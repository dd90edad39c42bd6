"""Choices among records, components of tasks and crossings on rows with nulls, ties and repeats."""

import math
from datetime import date

from pyspark.sql import functions as F

from siltbed.functions import dates, weather
from siltbed.operators import choices, elements
from tests.test_scenes import loop_clusters


def test_captures(spark):
    captures = spark.createDataFrame([(1, 1, date(2020, 1, 1), 0.0, 0.0), (1, 2, date(2020, 1, 1), 0.0, 1.0), (1, 3, None, 0.0, 0.0), (1, 4, date(2021, 5, 1), 0.0, 5.0), (1, 5, date(2021, 5, 1), 0.0, 5.0), (2, 6, None, 0.0, 0.0)],
                                     "k int, n int, captured date, lat double, lon double")
    asked = [("earliest", None, None, 0.9), ("latest", None, None, 0.9), ("window", date(2020, 1, 1), date(2020, 12, 31), 0.1), ("window", date(1999, 1, 1), date(1999, 2, 1), 0.0)]
    for (mode, start, end, lon), want in zip(asked, (2, 4, 1, None), strict=True):
        question = spark.createDataFrame([(k, mode, start, end, 0.0, lon) for k in (1, 2)], "k int, mode string, start date, end date, at_lat double, at_lon double")
        assert [(r["k"], r["n"]) for r in choices.select_capture(captures, question, "k", "n").collect()] == ([(1, want)] if want else [])


def test_areas(spark):
    areas = spark.createDataFrame([(1, 1, "x", 8), (1, 2, "y", None), (1, 3, "x", 9), (2, 4, "z", None), (2, 5, None, 4), (3, 6, "y", 2), (3, 7, "y", 2), (3, 8, "w", 99)], "k int, n int, name string, level int").withColumn("asked", F.lit("y"))
    got = {r["k"]: (r["n"], r["level"]) for r in choices.choose_area(areas, "k", "n", "asked").collect()}
    assert got == {1: (2, None), 2: (5, 4), 3: (6, 2)}


def test_distinct_and_complete(spark):
    rows = spark.createDataFrame([(1, None, "a"), (2, None, "a"), (3, "x", "a"), (4, None, None), (5, None, None)], "n int, p string, q string")
    assert sorted(r["n"] for r in choices.distinct_records(rows, ["p", "q"], ["n"]).collect()) == [1, 3, 4]
    frames = spark.createDataFrame([("g", 1, False, True, False, 0.9), ("g", 2, True, False, True, None), ("g", 3, True, None, None, 0.1), ("h", 4, None, None, None, None)], "g string, n int, preferred boolean, clean boolean, overlay boolean, quality double")
    assert sorted((r["g"], r["n"]) for r in choices.most_complete(frames, ["g"], ["n"]).collect()) == [("g", 3), ("h", 4)]


def test_components(spark):
    parts = ("trajectory", *choices.REQUIRED)
    rows = [("a", k, f"{k}/1") for k in parts] + [("b", k, f"{k}/1") for k in parts] + [("b", "report_retry", "again"), ("a", "task", "task/2")] + [("c", k, "x") for k in parts[:-1]] + [("c", "report_retry", "y")]
    got = {r["t"]: (r["task"], r["report"]) for r in choices.task_components(spark.createDataFrame(rows, "t string, kind string, path string"), "t").collect()}
    assert got == {"a": ("task/2", "report/1"), "b": ("task/1", "again")}
    trajectories = spark.createDataFrame([(i,) for i in range(6)], "k int")
    scores = spark.createDataFrame([(1, "accept", 0.9), (2, " reject ", 0.9), (3, "accept", 0.1), (4, None, None), (5, "accept", 0.1), (5, None, 0.8)], "k int, decision string, quality_score double")
    got = {r["k"]: r["skipped"] for r in choices.admitted(trajectories, scores, "k", 0.5).collect()}
    assert got == {0: "missing", 1: None, 2: "rejected", 3: "low", 4: "unscored", 5: None}
    assert choices.admitted(trajectories, scores, "k", 0.5, unscored=True).where("k = 0 AND skipped IS NULL").count() == 1


def test_captured_in(spark):
    notes = ["2020-05-03T10:00:00", "2020", "from 2018 to 2021", "none", None, "1700", "2022-01-01"]
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(notes)], "i int, note string")
    window = [F.lit(d).cast("date") for d in ("2020-05-03", "2020-12-31")]
    assert sorted(r["i"] for r in rows.where(dates.captured_in(F.col("note"), *window)).collect()) == [0, 1, 2]


def loop_crossings(ways, metres):
    """Segments against segments in order, then the first cluster in reach."""
    hits = []
    for i, own, a in ways:
        for j, other, b in ways:
            if own == "road" and other == "river":
                for m, (p, q) in enumerate(zip(a, a[1:])):
                    for n, (r, s) in enumerate(zip(b, b[1:])):
                        det = (q[1] - p[1]) * (s[0] - r[0]) - (q[0] - p[0]) * (s[1] - r[1])
                        if abs(det) < 1e-9:
                            continue
                        t = ((r[1] - p[1]) * (s[0] - r[0]) - (r[0] - p[0]) * (s[1] - r[1])) / det
                        u = ((r[1] - p[1]) * (q[0] - p[0]) - (r[0] - p[0]) * (q[1] - p[1])) / det
                        if 0 <= t <= 1 and 0 <= u <= 1:
                            hits.append(((i, m, j, n), p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
    return sorted((round(lat, 6), round(lon, 6), n) for _, lat, lon, n in loop_clusters(hits, metres))


def test_crossings_are_the_loop(spark):
    ways = []
    for i in range(24):
        at = (10 + math.sin(i * 7.0) / 3, 20 + math.cos(i * 3.0) / 3)
        ways.append((i, "road" if i % 2 else "river", [at, (at[0] + math.sin(i) / 2, at[1] + math.cos(i) / 2), (at[0] - 0.2, at[1] + 0.31)]))
    rows = [(i, {"way": kind}, [{"lat": a, "lon": b} for a, b in points]) for i, kind, points in ways] + [(None, {"way": "road"}, [{"lat": 1.0, "lon": 1.0}]), (99, None, None), (98, {"way": "road"}, [])]
    table = spark.createDataFrame(rows, "id int, tags map<string, string>, points array<struct<lat: double, lon: double>>")
    for metres in (1.0, 20_000.0):
        got = sorted((r["lat"], r["lon"], r["count"]) for r in elements.crossings(table, '["way"="road"]', '["way"="river"]', metres).collect())
        want = loop_crossings(ways, metres)
        assert [r[2] for r in got] == [r[2] for r in want] and len(got) > 5
        assert all(math.hypot(a[0] - b[0], a[1] - b[1]) < 2e-6 for a, b in zip(got, want, strict=True))
    # Without a way that fits the reference, all others are it.
    again = elements.crossings(table, '["way"="road"]', '["bridge"]', 1.0).count()
    assert again == len(loop_crossings(ways, 1.0))
    assert elements.crossings(table.limit(0), '["way"]', '["way"]', 1.0).count() == 0


def test_windows_of_texts(spark):
    want = {
        "2020": ("2020-01-01", "2020-12-31"), "1990s": ("1990-01-01", "1999-12-31"), "1990's": ("1990-01-01", "1999-12-31"), "1980 年代": ("1980-01-01", "1989-12-31"), "2001至2003": ("2001-01-01", "2003-12-31"),
        "2003-2001": None, "2020-02-29": ("2020-02-29", "2020-02-29"), "2021-02-29": None, "2020-01-05 / 2020-02-01": ("2020-01-05", "2020-02-01"), "Winter 2019": ("2019-12-01", "2020-02-29"),
        "2018 汛期": ("2018-06-01", "2018-09-30"), "summer": None, "": None, "soon": None, None: None, "1995s": None,
    }
    rows = spark.createDataFrame([(t,) for t in want], "t string").select("t", dates.window_of(F.col("t")).alias("w")).collect()
    assert {r["t"]: r["w"] and (str(r["w"]["start"]), str(r["w"]["end"])) for r in rows} == want


def test_conditions(spark):
    values = {"cloud_cover": 10.0, "snow_depth": 3.0, "rain": 2.5, "own": -1.0, "visibility": None}
    want = {"晴": True, "Clear": True, "雪": True, "cloud<10": False, "云量 <= 10": True, "rainfall == 2.5": True, "own < 0": True, "wind > 3": None, "能见度 > 1": None, "rain": None, "rain < x": None, "": None, None: None, "own = -1.0": True}
    rows = spark.createDataFrame([(t, values) for t in want], "t string, v map<string, double>")
    assert {r["t"]: r["f"] for r in rows.select("t", weather.satisfied(F.col("v"), F.col("t")).alias("f")).collect()} == want
