"""Readers and sinks with files written and read back."""

import csv
import hashlib
import json
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from siltbed.plans import exports
from siltbed.sources import readers, sinks

SF = "/root/testdata/sf0.001"


def test_jobs(spark, tmp_path):
    (tmp_path / "jobs.json").write_text(json.dumps([{"video_path": "a.mp4", "groundtruth": [1.5, 2.0], "video_id": "v1", "unknown": 1}, {"video_path": "b.mp4"}]))
    got = readers.jobs(spark, str(tmp_path / "jobs.json")).collect()
    assert [(r["video_path"], r["groundtruth"], r["video_id"]) for r in got] == [("a.mp4", [1.5, 2.0], "v1"), ("b.mp4", None, None)]
    (tmp_path / "bad.json").write_text('[{"video_path": ')
    with pytest.raises(Exception):
        readers.jobs(spark, str(tmp_path / "bad.json")).collect()


def test_transcripts_of_both_shapes(spark, tmp_path):
    segments = [{"start": 0.0, "end": 1.5, "text": "one"}, {"start": 1.5, "end": 2.0, "text": "é two"}]
    (tmp_path / "deep").mkdir()
    (tmp_path / "a.json").write_text(json.dumps(segments))
    (tmp_path / "deep" / "b.json").write_text(json.dumps({"language": "en", "segments": segments[:1]}))
    (tmp_path / "c.json").write_text("[]")
    got = sorted(tuple(r) for r in readers.transcripts(spark, str(tmp_path)).collect())
    assert got == [("a", 0, 0.0, 1.5, "one"), ("a", 1, 1.5, 2.0, "é two"), ("b", 0, 0.0, 1.5, "one")]


def test_trajectories_at_any_depth(spark, tmp_path):
    for task, folder in (("t1", "x/t1"), ("t2", "y/z/t2")):
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / "stage3_trajectory.json").write_text(json.dumps({"id": task, "steps": [{"tool": "map", "params": "{}"}]}, indent=1))
        (tmp_path / folder / "other.json").write_text("{}")
    got = {r["task_id"]: (r["id"], r["steps"][0]["tool"], len(r["steps"])) for r in readers.trajectories(spark, str(tmp_path)).collect()}
    assert got == {"t1": ("t1", "map", 1), "t2": ("t2", "map", 1)}


def test_components_of_unlike_columns(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, x int")
    new = spark.createDataFrame([("b", "y"), ("c", None)], "k string, z string")
    got = {r["k"]: (r["x"], r["z"]) for r in readers.components([old, new], "k").collect()}
    assert got == {"a": (1, None), "b": (None, "y"), "c": (None, None)}


def test_inventories(spark):
    lines = spark.createDataFrame([("main/ann/x1.mp4",), ("main/bob/x2.mp4",), ("readme.md",), (None,)], "path string")
    one = readers.inventory(lines, "path", "main", r"^main/([^/]+)/(\w+)\.mp4$", ["author", "item_id"])
    two = spark.createDataFrame([("tutorial", "t/1", 7)], "source string, path string, size int")
    got = sorted((r["source"], r["author"] or "", r["item_id"] or "", r["size"] or 0) for r in readers.all_inventories(one, two).collect())
    assert got == [("main", "ann", "x1", 0), ("main", "bob", "x2", 0), ("tutorial", "", "", 7)]


def test_registries_of_both_forms(spark, tmp_path):
    rows, schema = [{"name": "Ann, Ltd", "level": 4}, {"name": 'Quote "q"', "level": None}, {"name": "Two\nlines", "level": 6}], "name string, level int"
    with open(tmp_path / "r.csv", "w", newline="", encoding="utf-8-sig") as file:
        writer = csv.DictWriter(file, ["name", "level"])
        writer.writeheader()
        writer.writerows(rows)
    (tmp_path / "r.jsonl").write_text("\n".join(map(json.dumps, rows)))
    for name in ("r.csv", "r.jsonl"):
        assert sorted(tuple(r) for r in readers.registry(spark, str(tmp_path / name), schema).collect()) == [("Ann, Ltd", 4), ('Quote "q"', None), ("Two\nlines", 6)]


def test_terrain_without_data(spark):
    grid = spark.createDataFrame([(1, [[1.0, -9999.0], [None, 2.0]], -9999.0), (2, [[-9999.0]], None), (3, [], 0.0)], "k int, v array<array<double>>, n double")
    got = sorted(tuple(r) for r in readers.terrain_cells(grid, "k", "v", "n").collect())
    assert got == [(1, 0, 0, 1.0), (1, 0, 1, None), (1, 1, 0, None), (1, 1, 1, 2.0), (2, 0, 0, -9999.0)]


def test_shards_merge_in_order(spark, tmp_path):
    rows = spark.createDataFrame([(i % 3, f"f{i:03d}", i) for i in range(90)], "shard int, name string, x int")
    sinks.write_shards(rows, "shard", str(tmp_path / "shards"))
    back = spark.read.schema("shard int, name string, x int").json(str(tmp_path / "shards"))
    sinks.merged_shards(back, "shard", "name").write.json(str(tmp_path / "merged"))
    lines = [json.loads(x) for part in sorted((tmp_path / "merged").glob("part-*")) for x in part.read_text().splitlines()]
    assert [(r["shard"], r["name"], r["x"]) for r in lines] == sorted((i % 3, f"f{i:03d}", i) for i in range(90))


def test_rescored_keeps_what_has_no_score(spark):
    rows = spark.createDataFrame([("a", 0.1, "x"), ("b", 0.2, "y"), (None, 0.3, "z")], "k string, score double, other string")
    new = spark.createDataFrame([("b", 0.9), ("c", 1.0)], "k string, score double")
    assert sorted((r["other"], r["score"]) for r in sinks.rescored(rows, new, "k", "score").collect()) == [("x", 0.1), ("y", 0.9), ("z", 0.3)]


def test_ids_from_content(spark):
    got = [r["id"] for r in spark.createDataFrame([("payload",), ("",)], "p string").select(sinks.result_id("img", F.col("p")).alias("id")).collect()]
    assert got == ["img_" + hashlib.sha256(p.encode()).hexdigest()[:16] for p in ("payload", "")]


def test_exports_are_read_by_others(spark, tmp_path):
    elements = exports._elements(spark, SF)
    want = {r["result_id"]: r for r in elements.collect()}
    exports.geojson_features(spark, SF).select("feature").write.text(str(tmp_path / "features"))
    features = [json.loads(x) for part in (tmp_path / "features").glob("part-*") for x in part.read_text().splitlines()]
    assert {f["id"]: (f["geometry"]["coordinates"], f["properties"]) for f in features} == {k: ([r["lon"], r["lat"]], r["tags"]) for k, r in want.items()}
    for r in exports.osm_nodes(spark, SF).collect():
        node, known = ElementTree.fromstring(r["node"]), want[r["result_id"]]
        assert (int(node.get("id")), float(node.get("lat")), float(node.get("lon"))) == (known["id"], known["lat"], known["lon"])
        assert {t.get("k"): t.get("v") for t in node} == known["tags"]
    for r in exports.kml_placemarks(spark, SF).collect():
        mark = ElementTree.fromstring(r["placemark"])
        assert mark.find("name").text == want[r["result_id"]]["tags"]["name"]
    sheet = exports.tag_sheet(spark, SF)
    assert sheet.columns == ["result_id", "name", "segment", "note"]
    assert not any((v or "").startswith(("=", "-", "+", "@")) for r in sheet.collect() for v in r)
