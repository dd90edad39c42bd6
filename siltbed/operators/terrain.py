"""Profiles of terrain along paths, and the part of a grid inside a box."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltbed.operators import intervals
from siltbed.operators import spatial as sp

#: Most samples of a leg, as fixed by the rule, and of a profile.
LEG_SAMPLES, PROFILE_SAMPLES = 2048, 200


def path_samples(paths: DataFrame, path: str, order: str, step: float, most: int = LEG_SAMPLES) -> DataFrame:
    """(path, leg, n, x, y, distance): places along paths (path, order, x, y) at most ``step`` apart, both ends among them.

    A leg is cut into as many equal pieces as its length asks for, two at least and ``most`` - 1 at most; its first place
    is the last of the leg before. A path of one place is one sample. Distances run along the path.
    """
    w = Window.partitionBy(path).orderBy(order)
    rows = paths.select(path, F.col(order), F.col("x").cast("double"), F.col("y").cast("double"))
    rows = rows.withColumn("leg", F.row_number().over(w)).withColumn("x2", F.lead("x").over(w)).withColumn("y2", F.lead("y").over(w))
    rows = rows.withColumn("size", F.hypot(F.col("x2") - F.col("x"), F.col("y2") - F.col("y")))
    before = F.coalesce(F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rows = rows.withColumn("before", before).where(F.col("x2").isNotNull() | (F.col("leg") == 1))
    pieces = F.least(F.greatest(F.lit(2), F.ceil(F.col("size") / step)), F.lit(most - 1)).cast("int")
    pieces = F.when(F.col("size") > 1e-6, pieces).otherwise(F.when(F.col("size").isNull() | (F.col("leg") > 1), 0).otherwise(1))
    rows = rows.withColumn("pieces", pieces)
    first = F.when(F.col("leg") == 1, 0).otherwise(1)
    rows = rows.where(first <= F.col("pieces")).withColumn("n", F.explode(F.sequence(first, F.col("pieces"))))
    part = F.when(F.col("pieces") > 0, F.col("n") / F.col("pieces")).otherwise(0.0)
    size = F.coalesce("size", F.lit(0.0))
    return rows.select(
        path, "leg", "n", (F.col("x") + part * (F.coalesce("x2", "x") - F.col("x"))).alias("x"), (F.col("y") + part * (F.coalesce("y2", "y") - F.col("y"))).alias("y"),
        (F.col("before") + part * size).alias("distance"),
    )


def profile(paths: DataFrame, cells: DataFrame, path: str, order: str, step: float, keep: int = PROFILE_SAMPLES) -> DataFrame:
    """(path, place, x, y, distance, value): heights of cells (grid, row, col, value) along paths (path, grid, order, x, y).

    x and y are columns and rows of the grid's pixel corners; heights lie between the four cells around. Of more than
    ``keep`` samples, that many evenly spread ones stay, both ends among them. A path that has a sample off the grid or
    without a height gives no rows.
    """
    grid = paths.groupBy(path).agg(F.min("grid").alias("grid"))
    rows = path_samples(paths, path, order, step).join(grid.hint("merge"), path)
    at = F.struct(path, "leg", "n", "distance").alias("id")
    found = sp.sampled(rows.select("grid", at, "x", "y"), cells).select("id.*", "x", "y", "value")
    lost = F.max(F.col("value").isNull()).over(Window.partitionBy(path))
    rows = intervals.even_subsample(found.withColumn("lost", lost).where("NOT lost").drop("lost"), [path], ["leg", "n"], keep)
    place = F.row_number().over(Window.partitionBy(path).orderBy("leg", "n"))
    return rows.select(path, place.alias("place"), "x", "y", "distance", "value")


def profile_summary(samples: DataFrame, path: str) -> DataFrame:
    """(path, length, climb, descent, relief, steepest): of a profile; steepest is the largest rise or fall by distance."""
    w = Window.partitionBy(path).orderBy("place")
    rise, run = F.col("value") - F.lag("value").over(w), F.col("distance") - F.lag("distance").over(w)
    rows = samples.withColumn("rise", rise).withColumn("run", run)
    return rows.groupBy(path).agg(
        F.max("distance").alias("length"), F.sum(F.greatest("rise", F.lit(0.0))).alias("climb"), F.sum(F.greatest(-F.col("rise"), F.lit(0.0))).alias("descent"),
        (F.max("value") - F.min("value")).alias("relief"), F.max(F.when(F.col("run") > 0, F.abs("rise") / F.col("run"))).alias("steepest"),
    )


def clipped(cells: DataFrame, west: float, south: float, east: float, north: float, affine: tuple[float, float, float, float, float, float]) -> DataFrame:
    """The cells (row, col, ...) whose centres lie in the box; affine (a, b, c, d, e, f): x = a col + b row + c, y = d col + e row + f."""
    a, b, c, d, e, f = affine
    col, row = F.col("col") + 0.5, F.col("row") + 0.5
    x, y = F.lit(c) + F.lit(a) * col + F.lit(b) * row, F.lit(f) + F.lit(d) * col + F.lit(e) * row
    return cells.where(x.between(west, east) & y.between(south, north))
