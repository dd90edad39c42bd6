"""Tables of tasks split from recordings: structural anomalies, missed actions, time stamps of candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def split_flags(tasks: DataFrame, key: str, duration: str, tolerance: float) -> DataFrame:
    """tasks with ``anomalies``: codes of the rules that a task (start, end, display_start, display_end, status, place) breaks.

    Codes: inverted_window, outside_recording, display_inverted, display_contradicts, resolved_without_place, same_place
    (another resolved task of the key has this very place).
    """
    start, end, shown, hidden = (F.col(c) for c in ("start", "end", "display_start", "display_end"))
    low, high = F.least(start, end) - tolerance, F.greatest(start, end) + tolerance
    known = F.nullif(F.lower(F.regexp_replace(F.coalesce("place", F.lit("")), r"[\s,.;:]+", "")), F.lit(""))
    resolved = F.col("status") == "resolved"
    rows = tasks.withColumn("place_key", F.when(resolved, known))
    places = rows.where(F.col("place_key").isNotNull()).groupBy(F.col(key).alias("of_key"), F.col("place_key").alias("of_place")).count().where("count > 1")
    rows = rows.join(places, (F.col(key) == F.col("of_key")) & (F.col("place_key") == F.col("of_place")), "left")
    outside = (F.col(duration) > 0) & ((start < -1e-6) | (end > F.col(duration) + 1e-6))
    rules = [
        ("inverted_window", end < start),
        ("outside_recording", outside),
        ("display_inverted", hidden < shown),
        ("display_contradicts", (hidden >= shown) & ((hidden < low) | (shown > high))),
        ("resolved_without_place", resolved & F.col("place_key").isNull()),
        ("same_place", F.col("of_place").isNotNull()),
    ]
    codes = F.array_compact(F.array(*[F.when(rule, code) for code, rule in rules]))
    return rows.withColumn("anomalies", codes).drop("place_key", "of_key", "of_place", "count")


def missed_actions(items: DataFrame, covered: str, confidence: str, least: float = 0.85) -> DataFrame:
    """Actions that a trajectory leaves out although they are sure enough."""
    return items.where(~F.col(covered) & (F.col(confidence) >= least))


def kept_stamps(stamps: Column, start: Column, end: Column, most: int, apart: float = 1e-3) -> Column:
    """Stamps inside the window, in their order, without those within ``apart`` of one kept before; at most ``most``.

    Without any, the middle of the window. The limit is the feature: so many frames are asked for.
    """
    low = F.greatest(F.lit(0.0), start)
    high = F.greatest(low, end)
    inside = F.filter(stamps, lambda t: t.between(low - 1e-6, high + 1e-6))
    kept = F.aggregate(
        inside,
        F.array().cast("array<double>"),
        lambda seen, t: F.when(F.exists(seen, lambda s: F.abs(s - t) <= apart), seen).otherwise(F.concat(seen, F.array(t))),
    )
    return F.slice(F.when(F.size(kept) > 0, kept).otherwise(F.array((low + high) * 0.5)), 1, max(1, most))


def readiness_summary(calls: DataFrame, key: str, level: str, order: tuple[str, ...]) -> DataFrame:
    """A row for each key: total, a count for each level and the worst; an unknown level counts as the last."""
    known = F.when(F.trim(level).isin(*order), F.trim(level)).when(F.col(level).isNull(), order[0]).otherwise(order[-1])
    rows = calls.withColumn("own", known).withColumn("rank", F.array_position(F.array(*[F.lit(x) for x in order]), F.col("own")))
    counts = [F.count_if(F.col("own") == x).alias(x) for x in order]
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("total"), *counts, F.max_by("own", "rank").alias("worst"))


def chunk_runs(df: DataFrame, key: str, window: float, most: float) -> DataFrame:
    """df with ``run``: a number that grows wherever no open chunk can reach across, so that runs fold apart.

    A chunk's start is never before its run's start, and a segment that ends later than ``most`` windows after the one
    before starts cannot be in that one's chunk.
    """
    order = Window.partitionBy(key).orderBy("start", "end")
    breaks = F.col("end") - F.lag("start").over(order) > window * most
    return df.withColumn("breaks", F.coalesce(breaks, F.lit(False)).cast("int")).withColumn("run", F.sum("breaks").over(order)).drop("breaks")
