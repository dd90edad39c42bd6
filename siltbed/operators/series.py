"""Time series, scenes, captures and provider results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltbed.functions import sky


def daily(df: DataFrame, key: list[str], ts: str, value: str, order: str) -> DataFrame:
    """key, day, mean, sum and mode of each day's numbers; of modes as frequent, the one seen first (by ts, order)."""
    rows = df.withColumn("day", F.to_date(ts))
    counted = rows.where(F.col(value).isNotNull()).groupBy(*key, "day", value).agg(
        F.count(F.lit(1)).alias("times"), F.min(F.struct(ts, order)).alias("seen")
    )
    # The most repeats come first, then the earliest seen: no list of a day's values is ever held.
    first = F.min(F.struct((-F.col("times")).alias("fewer"), "seen", F.col(value).alias("mode"))).alias("first")
    mode = counted.groupBy(*key, "day").agg(first).select(*key, "day", "first.mode")
    sums = rows.groupBy(*key, "day").agg(F.avg(value).alias("mean"), F.sum(value).alias("sum"))
    return sums.join(mode, [*key, "day"], "left")


def condition(value: Column, operator: str, threshold: float) -> Column:
    """A comparison that a null fails."""
    test = {"<": value < threshold, ">": value > threshold, "<=": value <= threshold, ">=": value >= threshold, "==": value == threshold}
    return F.coalesce(test[operator], F.lit(False))


def refined(df: DataFrame, ts: str, start, end, value: str, operator: str, threshold: float) -> DataFrame:
    """Rows of the closed window whose value meets the condition."""
    return df.where(F.col(ts).between(F.lit(start), F.lit(end)) & condition(F.col(value), operator, threshold))


def aligned(targets: DataFrame, series: DataFrame, stamp: str, order: str, value: str) -> DataFrame:
    """targets with the series' value of the same stamp, the last by order where a stamp repeats; null if absent."""
    last = series.groupBy(stamp).agg(F.max_by(value, order).alias(value))
    return targets.join(last, stamp, "left")


def nearest(points: DataFrame, others: DataFrame, key: list[str], at: str, other_at: str, id_: str, other_id: str) -> DataFrame:
    """For each point the other row of its key that is nearest in time (ties: earlier, then smaller id).

    Both sides are merged in time order and look one row back and ahead, so a key's rows are sorted, not paired.
    """
    row = F.struct(F.col(other_at).alias("t"), F.col(other_id).alias("id"))
    none = F.lit(None).cast(others.select(row.alias("r")).schema["r"].dataType)
    ids = points.schema[id_].dataType
    both = points.select(*key, F.col(at).alias("t"), F.col(id_).alias("point"), none.alias("other")).unionByName(
        others.select(*key, F.col(other_at).alias("t"), F.lit(None).cast(ids).alias("point"), row.alias("other"))
    )
    # Of equal times, the others come first for the look back; the smallest id of a time wins either way.
    firsts = Window.partitionBy(*key, F.col("other.t"))
    both = both.withColumn("other", F.when(F.col("other").isNotNull(), F.min("other").over(firsts)))
    ordered = Window.partitionBy(*key).orderBy("t", F.col("point").asc_nulls_first())
    before = F.last("other", ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first("other", ignorenulls=True).over(ordered.rowsBetween(0, Window.unboundedFollowing))
    found = both.withColumn("before", before).withColumn("after", after).where("point IS NOT NULL")
    late = (F.col("after.t") - F.col("t")) < (F.col("t") - F.col("before.t"))
    best = F.when(F.col("before").isNull() | F.coalesce(late, F.lit(False)), F.col("after")).otherwise(F.col("before"))
    return found.select(*key, F.col("point").alias(id_), F.col("t").alias(at), best["t"].alias(other_at), best["id"].alias(other_id))


def interleaved(df: DataFrame, provider: str, provider_rank: str, rank: list, limit: int) -> DataFrame:
    """Round robin over providers by each one's own order, up to the limit; adds ``position``."""
    turn = F.row_number().over(Window.partitionBy(provider).orderBy(*rank))
    # Only each provider's first rows can get a turn, so what is ordered globally is providers times limit.
    rows = df.withColumn("turn", turn).where(F.col("turn") <= limit).orderBy("turn", provider_rank).limit(limit)
    return rows.withColumn("position", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("turn", provider_rank))).drop("turn")


def chosen_scenes(df: DataFrame, key: list[str], mode: str, ts: str, cloud: str, id_: str) -> DataFrame:
    """One scene a key: earliest, latest, or least cloudy and then newest.

    For earliest and latest a cloud cover of 0 counts as unknown, that is as 100, in the tie-break.
    """
    falsy = F.when(F.coalesce(F.col(cloud), F.lit(0.0)) == 0, 100.0).otherwise(F.col(cloud))
    order = {
        "earliest": [F.col(ts).asc(), falsy.asc(), F.col(id_)],
        "latest": [F.col(ts).desc(), falsy.asc(), F.col(id_)],
        "least_cloud": [F.coalesce(F.col(cloud), F.lit(100.0)).asc(), F.col(ts).desc(), F.col(id_)],
    }[mode]
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("rank = 1").drop("rank")


def snapshot(df: DataFrame, key: list[str], ts: str, at, seconds: int) -> DataFrame:
    """The newest row of each key at a time, not older than the limit. One row a key leaves each task."""
    age = F.lit(at).cast("timestamp_ntz")
    fresh = df.where((F.col(ts) <= age) & (F.col(ts) >= age - F.expr(f"INTERVAL {seconds} SECONDS")))
    rest = [c for c in df.columns if c not in key]
    best = fresh.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(ts, *[c for c in rest if c != ts])).alias("row"))
    return best.select(*key, *[F.col(f"row.{c}").alias(c) for c in rest])


def crossings(df: DataFrame, key: list[str], ts: str, value: str, level: float, rising: bool) -> DataFrame:
    """The first rising or last falling crossing of a level, its time interpolated: key, crossed_at (seconds)."""
    ordered = Window.partitionBy(*key).orderBy(ts)
    rows = df.select(
        *key, F.col(ts).alias("t"), F.col(value).alias("v"), F.lead(ts).over(ordered).alias("t2"), F.lead(value).over(ordered).alias("v2")
    )
    hit = (F.col("v") < level) & (F.col("v2") >= level) if rising else (F.col("v") > level) & (F.col("v2") <= level)
    at = F.col("t") + (F.col("t2") - F.col("t")) * ((F.lit(level) - F.col("v")) / (F.col("v2") - F.col("v")))
    return rows.where(hit).groupBy(*key).agg((F.min if rising else F.max)(at).alias("crossed_at"))


SUN_GRID_SECONDS = 120.0


def sun_crossings(places: DataFrame, key: str, levels: dict[str, tuple[float, bool]]) -> DataFrame:
    """key and a column for each of ``levels`` (name: degrees, rising): when the sun crosses it within 24 hours of ``start``.

    places: key, start, lat, lon. A time is interpolated between samples two minutes apart; the first rise and the last
    fall count, and a level that is never crossed is null. Samples are rows that partial sums fold before the shuffle.
    """
    steps = F.explode(F.sequence(F.lit(0), F.lit(int(86400 / SUN_GRID_SECONDS) - 2))).alias("i")
    rows = places.select(key, "start", "lat", "lon", steps).withColumn("t", F.col("start") + F.col("i") * SUN_GRID_SECONDS)
    up, after = (sky.sun_position(F.col("t") + late, F.col("lat"), F.col("lon"))[0] for late in (0.0, SUN_GRID_SECONDS))
    rows = rows.withColumn("up", up).withColumn("after", after)
    found = []
    for name, (level, rising) in levels.items():
        crossed = (F.col("up") < level) & (F.col("after") >= level) if rising else (F.col("up") > level) & (F.col("after") <= level)
        at = F.when(crossed, F.col("t") + (level - F.col("up")) / (F.col("after") - F.col("up")) * SUN_GRID_SECONDS)
        found.append((F.min(at) if rising else F.max(at)).alias(name))
    return rows.groupBy(key).agg(*found)
