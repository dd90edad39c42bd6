"""Convex hulls and least rectangles around points. Every task keeps the hull of what it has seen of a shape, so that only
hull points are dealt out; a shape's hull is the hull of those."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.operators import shapes as sh


def hull(points: np.ndarray) -> np.ndarray:
    """The corners of the convex hull, anticlockwise, by a monotone chain; of points on a line its two ends."""
    points = np.unique(points, axis=0)  # in the order of x, then y
    if len(points) < 3:
        return points

    def chain(ordered: list) -> list:
        out: list = []
        for p in ordered:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]):
                out.pop()
            out.append(p)
        return out[:-1]

    ordered = points.tolist()
    return np.array(chain(ordered) + chain(ordered[::-1]))


def least_rectangle(corners: np.ndarray, at_once: int = 256) -> tuple[float, float]:
    """(short, long) side of the rectangle of least area around a hull; one of its sides lies along the hull."""
    if len(corners) < 3:
        return 0.0, float(np.hypot(*(corners[-1] - corners[0]))) if len(corners) else 0.0
    along = np.roll(corners, -1, axis=0) - corners
    along /= np.hypot(*along.T)[:, None]
    best = (np.inf, 0.0, 0.0)
    for low in range(0, len(along), at_once):
        u = along[low : low + at_once]
        spans = [np.ptp(corners @ d.T, axis=0) for d in (u, np.column_stack([-u[:, 1], u[:, 0]]))]
        area = spans[0] * spans[1]
        i = int(np.argmin(area))
        best = min(best, (area[i], *sorted((spans[0][i], spans[1][i]))))
    return float(best[1]), float(best[2])


def _hulls(pdf: pd.DataFrame) -> pd.DataFrame:
    found = [(key, hull(part[["x", "y"]].to_numpy())) for key, part in pdf.groupby("id", sort=False)]
    return pd.DataFrame({"id": np.repeat([k for k, _ in found], [len(h) for _, h in found]), **{c: np.concatenate([h[:, i] for _, h in found]) for i, c in enumerate("xy")}})


def hull_corners(points: DataFrame) -> DataFrame:
    """The points (id, x, y) that each task finds on its own hull of an id: all corners of the ids' hulls, and few others."""

    def partial(batches):
        held = None
        for pdf in batches:
            pdf = pdf.dropna()
            held = pdf if held is None else pd.concat([held, pdf])
            if len(held):
                held = _hulls(held)
            if held["id"].nunique() > 10_000:  # many shapes: let them go
                yield held
                held = None
        if held is not None and len(held):
            yield held

    return points.select("id", "x", "y").mapInPandas(partial, points.select("id", "x", "y").schema)


def rectangles(points: DataFrame) -> DataFrame:
    """(id, short, long) of the least rectangle around each id's points (id, x, y). Rows with a null are left out."""
    schema = T.StructType([points.schema["id"], *T.StructType.fromDDL("short double, long double").fields])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        short, long = least_rectangle(hull(pdf[["x", "y"]].to_numpy()))
        return pd.DataFrame({"id": pdf["id"].iloc[:1], "short": [short], "long": [long]})

    return hull_corners(points).groupBy("id").applyInPandas(solve, schema)


def widths(shapes: DataFrame) -> DataFrame:
    """(id, width, length): metres of the sides of the least rectangle around each shape (id, shape) with rings, on a plane
    around its centroid; null where the rings have no area. Lines and points of a collection are not counted."""
    own = sh.shaped(shapes, "id").where("size(shape.rings) > 0")
    at = F.flatten(F.transform("shape.rings", lambda r: r["points"]))
    middle = sh.centroids(own, "id").select("id", F.col("cx").alias("lon0"), F.col("cy").alias("lat0"))
    rows = own.select("id", F.explode(at).alias("p")).select("id", "p.x", "p.y").join(middle, "id")
    sides = rectangles(sh.projected(rows, [("x", "y")]).select("id", "x", "y"))
    return sides.select("id", F.when(F.col("short") > 1e-6, F.col("short")).alias("width"), F.when(F.col("short") > 1e-6, F.col("long")).alias("length"))
