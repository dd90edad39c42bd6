"""Connected regions of raster cells (key, row, col): labels inside tiles, then over the tiles' borders."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.operators import graph
from siltbed.operators import shapes as sh
from siltbed.stages import staged

SIDES = [(0, 1), (1, 0)]
DIAGONALS = [(1, 1), (1, -1)]


def labelled(cells: DataFrame, key: str, diagonal: bool = True, tile: int = 256) -> DataFrame:
    """(key, row, col, at_row, at_col): each cell with the first cell of its region, by row and then column.

    Cells that share a side touch, with ``diagonal`` those that share a corner too. A tile's cells are labelled together;
    only cells at tiles' borders are joined with their neighbours, and only labels go through the components. Repeated
    cells count once; a null key is a key; cells without a place are left out.
    """
    moves = SIDES + DIAGONALS * diagonal
    own = cells.where("row IS NOT NULL AND col IS NOT NULL").select(F.col(key).alias("k"), F.col("row").cast("long"), F.col("col").cast("long")).distinct()
    own = own.withColumn("tr", F.floor(F.col("row") / tile)).withColumn("tc", F.floor(F.col("col") / tile))
    schema = T.StructType([T.StructField("k", cells.schema[key].dataType), *T.StructType.fromDDL("row long, col long, at_row long, at_col long").fields])

    inner = own.groupBy("k", "tr", "tc").applyInPandas(_labeller(moves), schema)
    inner = staged(inner, "regions-tiles")
    node = F.struct("k", F.col("at_row").alias("r"), F.col("at_col").alias("c"))
    edge = [F.pmod(c, F.lit(tile)).isin(0, tile - 1) for c in (F.col("row"), F.col("col"))]
    border = inner.where(edge[0] | edge[1])
    there = border.select(F.col("k").alias("other"), F.col("row").alias("r2"), F.col("col").alias("c2"), node.alias("b"))
    step = F.explode(F.array(*[F.struct(F.lit(dr).alias("dr"), F.lit(dc).alias("dc")) for dr, dc in moves]))
    here = border.withColumn("m", step).select("k", (F.col("row") + F.col("m.dr")).alias("row"), (F.col("col") + F.col("m.dc")).alias("col"), node.alias("a"))
    links = here.join(there, F.col("k").eqNullSafe(F.col("other")) & (F.col("row") == F.col("r2")) & (F.col("col") == F.col("c2"))).where("a != b").select("a", "b")
    merged = graph.components(links)
    named = inner.withColumn("own", node).join(merged, F.col("own") == F.col("node"), "left")
    return named.select(
        F.col("k").alias(key), "row", "col", F.coalesce("label.r", "at_row").alias("at_row"), F.coalesce("label.c", "at_col").alias("at_col")
    )


def _labeller(moves: list[tuple[int, int]]):
    """A function that gives each cell of a tile the first cell of its region."""

    def label(pdf: pd.DataFrame) -> pd.DataFrame:
        places = sorted(zip(pdf["row"].tolist(), pdf["col"].tolist(), strict=True))
        held, first = set(places), {}
        for start in places:  # in order, so that the first cell of a region names it
            if start in first:
                continue
            first[start], open_ = start, [start]
            while open_:
                r, c = open_.pop()
                for dr, dc in moves:
                    for near in ((r + dr, c + dc), (r - dr, c - dc)):
                        if near in held and near not in first:
                            first[near] = start
                            open_.append(near)
        found = pd.DataFrame([(r, c, *first[r, c]) for r, c in places], columns=["row", "col", "at_row", "at_col"])
        found.insert(0, "k", [pdf["k"].iloc[0]] * len(found))
        return found

    return label


def change_regions(cells: DataFrame, key: str, least_area: int = 16, top: int = 8, tile: int = 256) -> DataFrame:
    """(key, rank, west, north, east, south): the largest boxes around regions of changed cells (key, row, col), at most
    ``top`` of each key; ties by the first cell.

    Corners count as touching; east and south are exclusive; a box's area is its width by its height, of at least
    ``least_area``. A region inside a hole of another one is not reported: inside the box of each region that holds other
    boxes, the cells that the region leaves are labelled by sides, and those that cannot reach the box's edge are in holes.
    """
    found = staged(labelled(cells, key, True, tile).withColumnRenamed(key, "k"), "regions-cells")
    name = ["k", "at_row", "at_col"]
    boxes = found.groupBy(*name).agg(F.min("col").alias("west"), F.min("row").alias("south"), F.max("col").alias("east"), F.max("row").alias("north"))
    boxes = staged(boxes, "regions-boxes")
    label = F.struct(*name, "west", "south", "east", "north")
    pairs = sh.box_pairs(boxes.withColumn("a", label), boxes.withColumn("b", label), float(tile), "k")
    inside = " AND ".join(f"a.{c} {'>' if c in ('west', 'south') else '<'} b.{c}" for c in ("west", "south", "east", "north"))
    pairs = staged(pairs.where(inside), "regions-pairs")
    outer = pairs.select("b").distinct()
    lattice = outer.withColumn("row", F.explode(F.sequence("b.south", "b.north"))).withColumn("col", F.explode(F.sequence("b.west", "b.east")))
    own = found.select(F.struct(*name).alias("owner"), F.col("row").alias("r"), F.col("col").alias("c"))
    holder = F.struct(*[F.col(f"b.{c}") for c in name])
    left = lattice.join(own, (holder == F.col("owner")) & (F.col("row") == F.col("r")) & (F.col("col") == F.col("c")), "left_anti")
    left = staged(labelled(left, "b", False, tile), "regions-left")
    rim = (F.col("row") == F.col("b.south")) | (F.col("row") == F.col("b.north")) | (F.col("col") == F.col("b.west")) | (F.col("col") == F.col("b.east"))
    holes = left.groupBy("b", "at_row", "at_col").agg(F.max(rim).alias("open")).where("NOT open")
    held = left.join(holes, ["b", "at_row", "at_col"], "left_semi").select("b", F.col("row").alias("r"), F.col("col").alias("c"))
    nested = pairs.join(held, ["b"]).where("r = a.at_row AND c = a.at_col").select(*[F.col(f"a.{c}").alias(c) for c in name]).distinct()
    same = (boxes["k"].eqNullSafe(nested["k"])) & (boxes["at_row"] == nested["at_row"]) & (boxes["at_col"] == nested["at_col"])
    area = (F.col("east") - F.col("west") + 1) * (F.col("north") - F.col("south") + 1)
    kept = boxes.join(nested, same, "left_anti").withColumn("area", area).where(F.col("area") >= least_area)
    order = Window.partitionBy("k").orderBy(F.desc("area"), "at_row", "at_col")
    kept = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return kept.select(F.col("k").alias(key), "rank", "west", F.col("south").alias("north"), (F.col("east") + 1).alias("east"), (F.col("north") + 1).alias("south"))
