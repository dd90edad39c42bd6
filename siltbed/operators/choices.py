"""Choosing one record of many: captures by time and distance, areas by name and level, components of tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltbed.functions import geo


def select_capture(captures: DataFrame, asked: DataFrame, key: str, order: str) -> DataFrame:
    """(key, and the chosen capture's order, captured, metres): for each question the capture of the wanted time that is nearest.

    captures: key, order, captured (date), lat, lon; asked: key, mode (earliest, latest or window), start, end, at_lat,
    at_lon. Undated captures are never chosen; earliest and latest mean all captures of that one day; ties go to the
    smaller order. A question without a match gives no row.
    """
    rows = captures.where(F.col("captured").isNotNull()).join(asked, key)
    days = rows.groupBy(key).agg(F.min("captured").alias("first day"), F.max("captured").alias("last day"))
    mode = F.col("mode")
    fits = (
        F.when(mode == "earliest", F.col("captured") == F.col("first day")).when(mode == "latest", F.col("captured") == F.col("last day"))
        .when(mode == "window", F.col("captured").between(F.col("start"), F.col("end")))
    )
    metres = geo.haversine(F.col("lat"), F.col("lon"), F.col("at_lat"), F.col("at_lon"))
    best = F.min(F.struct(metres.alias("metres"), F.col(order).alias("n"), F.col("captured").alias("day"))).alias("best")
    found = rows.join(days, key).where(fits).groupBy(key).agg(best)
    return found.select(key, F.col("best.n").alias(order), F.col("best.day").alias("captured"), F.col("best.metres").alias("metres"))


def choose_area(areas: DataFrame, key: str, order: str, query: str) -> DataFrame:
    """(key, order, name, level): of each key's areas the one named as the query is, else that of the highest level.

    A missing level is below all others; ties, also among areas of the same name, go to the higher level and then to the
    smaller order.
    """
    exact = F.coalesce(F.col("name") == F.col(query), F.lit(False))
    rank = F.struct(exact.cast("int").alias("exact"), F.coalesce(F.col("level").cast("int"), F.lit(-1)).alias("level"), (-F.col(order)).alias("n"))
    best = areas.groupBy(key).agg(F.max_by(F.struct(order, "name", "level"), rank).alias("best"))
    return best.select(key, f"best.{order}", "best.name", "best.level")


def most_complete(frames: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """The best frame of each group (preferred, clean, overlay, quality): preferred ones first, then clean ones, those
    without an overlay, the better quality and the first in order. Unknown marks count as no, an unknown quality as 0."""
    flag = [F.coalesce(c, F.lit(False)).cast("int") for c in (F.col("preferred"), F.col("clean"), ~F.col("overlay"))]
    rank = Window.partitionBy(*group).orderBy(*[f.desc() for f in flag], F.coalesce("quality", F.lit(0.0)).desc(), *order)
    return frames.withColumn("own rank", F.row_number().over(rank)).where(F.col("own rank") == 1).drop("own rank")


def distinct_records(records: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first record of each combination of the keys, nulls being equal to each other."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return records.withColumn("own rank", rank).where(F.col("own rank") == 1).drop("own rank")


# What a task must have besides its trajectory, and the report that a retried one replaces.
REQUIRED, RETRIED = ("task", "transcript", "freeform", "mapping", "report"), "report_retry"


def task_components(files: DataFrame, key: str) -> DataFrame:
    """(key, trajectory, task, transcript, freeform, mapping, report): the paths of complete tasks.

    files: key, kind, path. Of several files of a kind the last by path counts. A retried report stands for the report,
    which must be there all the same; a task that lacks a part gives no row. One shuffle, by the key.
    """
    kinds = ("trajectory", *REQUIRED, RETRIED)
    one = files.groupBy(key).agg(*[F.max(F.when(F.col("kind") == k, F.col("path"))).alias(k) for k in kinds])
    whole = one.dropna(subset=["trajectory", *REQUIRED])
    return whole.select(key, "trajectory", *REQUIRED[:-1], F.coalesce(RETRIED, REQUIRED[-1]).alias(REQUIRED[-1]))


def admitted(trajectories: DataFrame, confidence: DataFrame, key: str, least: float, unscored: bool = False) -> DataFrame:
    """trajectories with ``skipped``: why one is left out (missing, unscored, rejected, low), or null where it is admitted.

    confidence: key, decision, quality_score. A trajectory without a row is left out unless ``unscored``; a row without a
    score never admits. Of several rows of a key the highest score counts.
    """
    own = confidence.groupBy(F.col(key).alias("own key")).agg(F.max(F.struct("quality_score", "decision")).alias("c"), F.lit(True).alias("there"))
    rows = trajectories.join(own, F.col(key) == F.col("own key"), "left")
    reason = (
        F.when(F.col("there").isNull(), None if unscored else "missing").when(F.col("c.quality_score").isNull(), "unscored")
        .when(F.trim("c.decision") == "reject", "rejected").when(F.col("c.quality_score") < least, "low")
    )
    return rows.withColumn("skipped", reason).drop("own key", "c", "there")
