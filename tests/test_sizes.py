"""Queries on inputs that are large in one way: many keys, many copies, many pairs."""

import random
import time
from difflib import SequenceMatcher

import numpy as np
from pyspark.sql import functions as F

from siltbed.functions import geometry as gm
from siltbed.operators import dedup, intervals, prints, spatial, terrain
from siltbed.operators import shapes as sh


def test_chunks_of_many_short_runs(spark):
    """Six thousand runs of two segments: a call of Python for each run took some 50 s on eight cores."""
    rows = spark.range(12_000).select(F.expr("id div 2").alias("key"), ((F.col("id") % 2) * 5.0).alias("start"), ((F.col("id") % 2) * 5.0 + 3.0).alias("end"), F.lit(9.0).alias("duration"))
    began = time.monotonic()
    got = intervals.chunked(rows, "key", 20.0).groupBy("start", "end", "segments").count().collect()
    assert time.monotonic() - began < 25
    assert sorted(map(tuple, got)) == [(0.0, 8.0, 2, 6000), (8.0, 9.0, 0, 6000)]


def joined_rows(monkeypatch, module, label):
    """What is written under the label, as a list that fills while a query runs."""
    seen, real = [], module.staged

    def staged(df, name, **options):
        out = real(df, name, **options)
        if name == label:
            seen.append(out.count())
        return out

    monkeypatch.setattr(module, "staged", staged)
    return seen


TEXTS = ('{"type":"Point","coordinates":[1,1]}', '{"type":"Polygon","coordinates":[[[0,0],[2,0],[2,2],[0,2],[0,0]]]}', '{"type":"LineString","coordinates":[[1,1],[5,1]]}', '{"type":"Point","coordinates":[8,8]}')


def copies(spark, n):
    text = F.element_at(F.array(*map(F.lit, TEXTS)), (F.col("id") % len(TEXTS) + 1).cast("int"))
    return gm.with_shape(spark.range(n).select("id", text.alias("text")), "text").select("id", "shape")


def by_kinds(rows, *columns):
    """How often each two kinds and values meet."""
    n = len(TEXTS)
    return {tuple(r)[:-1]: r["count"] for r in rows.groupBy((F.col("left_id") % n).alias("a"), (F.col("right_id") % n).alias("b"), *columns).count().collect()}


def test_equal_shapes_are_related_once(spark, monkeypatch):
    """Forty copies of each of four shapes: 4 x 4 shapes are compared, and 160 x 160 pairs told."""
    pairs = joined_rows(monkeypatch, sh, "shapes-pairs")
    many = copies(spark, 160).unionByName(copies(spark, 4))  # repeated rows count once
    got = by_kinds(sh.relate(many, many).where("intersects"), "within", "contains", "crosses")
    assert max(pairs) <= 16
    assert got == {key: n * 1600 for key, n in by_kinds(sh.relate(copies(spark, 4), copies(spark, 4)).where("intersects"), "within", "contains", "crosses").items()} and len(got) > 5


def test_near_copies_are_measured_once(spark, monkeypatch):
    pairs = joined_rows(monkeypatch, sh, "near-pairs")
    many = copies(spark, 160)
    got = by_kinds(sh.near(many, many, 500_000.0), F.round("distance", 3))
    assert max(pairs) <= 16
    assert got == {key: n * 1600 for key, n in by_kinds(sh.near(copies(spark, 4), copies(spark, 4), 500_000.0), F.round("distance", 3)).items()} and len(got) > 5


def test_equal_places_meet_equal_rings_once(spark, monkeypatch):
    """Of ids that share a place or a ring, and of repeated rows, all pairs are told; places without a coordinate are in none."""
    found = joined_rows(monkeypatch, spatial, "places-in-rings")
    points = spark.range(600).select((F.col("id") % 300).alias("id"), (F.col("id") % 3 * 1.0).alias("lat"), F.when(F.col("id") % 100 > 0, 0.5).alias("lon"))
    ring = F.array(*[F.struct(F.lit(x).alias("lon"), F.lit(y).alias("lat")) for x, y in ((0.0, -0.5), (1.0, -0.5), (1.0, 1.5), (0.0, 1.5), (0.0, -0.5))])
    got = spatial.in_polygons(points, spark.range(70).select(F.col("id").alias("polygon_id"), ring.alias("ring")), 1.0)
    assert got.count() == 2 * 198 * 70 and got.distinct().count() == 198 * 70
    assert found == [2]


def test_an_id_with_several_shapes_has_the_least(spark):
    rows = spark.createDataFrame([(1, TEXTS[0]), (1, TEXTS[3]), (1, TEXTS[0]), (2, TEXTS[3]), (None, TEXTS[0])], "id long, text string")
    rows = gm.with_shape(rows, "text").select("id", "shape")
    assert sorted((r["left_id"], r["right_id"]) for r in sh.relate(rows, rows).where("intersects").collect()) == [(1, 1), (2, 2)]


def test_samples_do_not_go_through_the_driver(spark, tmp_path):
    """Estimates by the size of files take exploded samples for a small table: only the grids' sizes, a row each, may be broadcast."""
    spark.range(500).select(F.col("id").alias("path"), F.lit(0).alias("grid"), F.explode(F.array(F.lit(0), F.lit(1))).alias("j")).withColumn("x", F.col("j") * 4.0 + 1).withColumn("y", F.lit(2.0)).write.parquet(str(tmp_path / "p"))
    spark.range(60).select(F.lit(0).alias("grid"), F.expr("cast(id div 10 as int)").alias("row"), F.expr("cast(id % 10 as int)").alias("col"), (F.col("id") * 1.0).alias("value")).write.parquet(str(tmp_path / "c"))
    found = terrain.profile(spark.read.parquet(str(tmp_path / "p")), spark.read.parquet(str(tmp_path / "c")), "path", "j", 0.1, keep=7)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") <= 1 and plan.count("SortMergeJoin") >= 2
    assert found.count() == 3500


def test_even_places_are_those_of_all_steps(spark):
    rows = spark.createDataFrame([(n, i) for n in (1, 2, 5, 6, 7, 11, 12, 50, 51) for i in range(n)], "k long, i long")
    for keep in (2, 5, 6, 7):
        got = sorted(map(tuple, intervals.even_subsample(rows, ["k"], ["i"], keep).select("k", "i").collect()))
        assert got == sorted({(n, i) for n in (1, 2, 5, 6, 7, 11, 12, 50, 51) for i in (range(n) if n <= keep else [round(j * (n - 1) / (keep - 1)) for j in range(keep)])})


def test_few_titles_are_compared_and_none_is_lost():
    rng = random.Random(8)
    parts = ["the", "ing", "ou", "re", "st", "an", "or", "ti", "tion", "ha", "éa"]
    titles = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 24))) for _ in range(240)]
    titles += [t[:k] + rng.choice("xyz") + t[k + d :] for t in titles[:60] for k, d in ((rng.randrange(len(t)), rng.randrange(3)),)] + ["", "a", "ab", "aa"]
    for least in (0.84, 0.6):
        may = dedup.may_match(titles[::2], titles[1::2], least)
        for i, a in enumerate(titles[::2]):
            for j, b in enumerate(titles[1::2]):
                assert may[i, j] or dedup.similarity(a, b, SequenceMatcher(None, "", b)) < least
        assert least < 0.84 or may.mean() < 0.1


def test_equal_similarities_take_few_rounds(spark, monkeypatch):
    """Of 40 x 40 equal titles each round of best pairs takes one pair: forty rounds."""
    chosen = joined_rows(monkeypatch, dedup, "chosen")
    pairs = spark.range(1600).select((F.col("id") % 2).alias("block"), F.expr("id div 40").alias("left"), (F.col("id") % 40 + 100).alias("right"), F.lit(1.0).alias("similarity"))
    got = {tuple(r) for r in dedup.greedy_matches(pairs).select("left", "right").collect()}
    want, lefts, rights = set(), set(), set()
    for r in sorted(pairs.collect(), key=lambda r: (r["similarity"], r["left"], r["right"]), reverse=True):
        if (r["block"], r["left"]) not in lefts and (r["block"], r["right"]) not in rights:
            want.add((r["left"], r["right"]))
            lefts.add((r["block"], r["left"]))
            rights.add((r["block"], r["right"]))
    assert got == want and len(chosen) <= 4


def test_agreement_in_pieces_is_the_count_of_bits(monkeypatch):
    """Products of matrices over several pieces of a print give the counts of bits themselves."""
    monkeypatch.setattr(prints, "PIECE", 32 * 20)
    rng = np.random.default_rng(4)
    left, right = ([rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32) for n in sizes] for sizes in ((15, 30, 90), (16, 41, 77, 100)))
    right[3][5:95] = left[2]

    def plain(a, b):
        scores = [0.0]
        for shift in range(-prints.SHIFTS, prints.SHIFTS + 1):
            one, two = a[max(shift, 0) :], b[max(-shift, 0) :]
            n = min(len(one), len(two))
            if n >= prints.LEAST:
                scores.append(1 - int(np.bitwise_count(one[:n] ^ two[:n]).sum()) / (n * 32.0))
        return max(scores)

    assert prints.agreement(left, right).tolist() == [[plain(a, b) for b in right] for a in left] and prints.agreement(left, right)[2, 3] == 1
