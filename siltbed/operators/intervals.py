"""Intervals, episodes and samples over timestamped rows."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.operators.tasks import chunk_runs
from siltbed.stages import staged


def merged(df: DataFrame, key: list[str], start: str, end: str, gap: float = 1e-3) -> DataFrame:
    """Islands of intervals that overlap or lie at most ``gap`` apart: key, start, end, members."""
    by_start = Window.partitionBy(*key).orderBy(start, end)
    seen = F.max(end).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(seen.isNull() | (F.col(start) > seen + gap), 1).otherwise(0)
    island = F.sum("opens").over(by_start.rowsBetween(Window.unboundedPreceding, 0))
    return (
        df.withColumn("opens", opens)
        .withColumn("island", island)
        .groupBy(*key, "island")
        .agg(F.min(start).alias(start), F.max(end).alias(end), F.count(F.lit(1)).alias("members"))
        .drop("island")
    )


def overlap_join(left: DataFrame, right: DataFrame, key: str, width: float, slack: float = 1e-6) -> DataFrame:
    """Pairs of intervals of one key that share more than ``slack``. Columns key, start_l, end_l / start_r, end_r, ...

    Both sides are cut into cells of ``width`` and meet cell by cell; a pair is kept only in the cell where its overlap
    begins, so nothing has to be made distinct. Slices then meet in (key, cell), which also splits hot keys.
    """

    def celled(df: DataFrame, start: str, end: str) -> DataFrame:
        low, high = (F.floor(F.col(c) / width).cast("long") for c in (start, end))
        return df.withColumn("cell", F.explode(F.sequence(low, F.greatest(low, high))))

    begins = F.floor(F.greatest("start_l", "start_r") / width).cast("long")
    pairs = celled(left, "start_l", "end_l").join(celled(right, "start_r", "end_r"), [key, "cell"])
    hit = (F.col("end_l") > F.col("start_r") + slack) & (F.col("start_l") < F.col("end_r") - slack)
    return pairs.where(hit & (F.col("cell") == begins)).drop("cell")


def role_at(points: DataFrame, roles: DataFrame, key: str, width: float, slack: float = 1e-6) -> DataFrame:
    """points (key, id, at) with ``role`` of the first interval (key, start, end, ord, role) that holds them, or null."""
    low, high = (F.floor(x / width).cast("long") for x in (F.col("start") - slack, F.col("end") + slack))
    cells = roles.withColumn("cell", F.explode(F.sequence(low, F.greatest(low, high))))
    met = points.withColumn("cell", F.floor(F.col("at") / width).cast("long")).join(cells, [key, "cell"])
    hit = met.where((F.col("at") >= F.col("start") - slack) & (F.col("at") <= F.col("end") + slack))
    first = hit.groupBy(key, "id").agg(F.min_by("role", "ord").alias("role"))
    return points.join(first, [key, "id"], "left")


def tumbling(df: DataFrame, duration: Column, size: float) -> DataFrame:
    """Fixed windows from 0 to the duration, the last one short: adds index, start, end."""
    n = F.ceil(duration / size).cast("int")
    out = df.where(duration > 0).withColumn("index", F.explode(F.sequence(F.lit(0), n - 1)))
    return out.withColumn("start", F.col("index") * F.lit(size)).withColumn("end", F.least(duration, (F.col("index") + 1) * F.lit(size)))


def episodes(df: DataFrame, key: list[str], order: list, eligible: Column, best: list) -> DataFrame:
    """The best row of each run of eligible rows; ineligible rows break a run. Adds ``episode`` and ``frames``."""
    ordered = Window.partitionBy(*key).orderBy(*order)
    breaks = F.sum(F.when(eligible, 0).otherwise(1)).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    run = Window.partitionBy(*key, "episode")
    return (
        df.withColumn("episode", breaks)
        .where(eligible)
        .withColumn("frames", F.count(F.lit(1)).over(run))
        .withColumn("rank", F.row_number().over(run.orderBy(*best)))
        .where("rank = 1")
        .drop("rank")
    )


def even_subsample(df: DataFrame, key: list[str], order: list, keep: int) -> DataFrame:
    """At most ``keep`` rows of each key, evenly spread with both ends; places are rounded half to even."""
    w = Window.partitionBy(*key)
    numbered = df.withColumn("place", F.row_number().over(w.orderBy(*order)) - 1).withColumn("count", F.count(F.lit(1)).over(w))
    # Steps are longer than a place, so only the step below a place and the next one can be rounded to it.
    below = F.floor(F.col("place") * F.lit(keep - 1) / F.nullif(F.col("count") - 1, F.lit(0))).cast("long")
    here = [F.bround(i * (F.col("count") - 1) / F.lit(keep - 1)).cast("int") == F.col("place") for i in (below, below + 1)]
    chosen = F.when(F.col("count") <= keep, True).otherwise(here[0] | here[1])
    return numbered.where(chosen).drop("place", "count")


def dense_samples(df: DataFrame, key: list[str], start: str, end: str, step_ms: int) -> DataFrame:
    """Times (ms) from start to end by step, the end always among them, each once for a key."""
    low, high = (F.round(F.col(c) * 1000).cast("long") for c in (start, end))
    times = F.array_union(F.sequence(low, F.greatest(low, high), F.lit(step_ms).cast("long")), F.array(F.greatest(low, high)))
    return df.select(*key, F.explode(times).alias("at_ms")).distinct()


def adjacent_merged(df: DataFrame, key: str, gap: float = 0.35) -> DataFrame:
    """Segments (key, start, end, text) folded in order: neighbours at most ``gap`` apart of which one text holds the
    other become one with the longer text; blank ones are absorbed, those that nothing absorbs go. Null keys are one key.

    The kept text decides later comparisons, so a run is folded in order; it is streamed over sorted partitions with
    only the open segment in memory. A pause longer than ``gap`` ends a run, and runs of one key fold apart.
    """
    order = Window.partitionBy(key).orderBy("start", "end", "text")
    seen = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = df.select(key, F.col("start").cast("double"), F.col("end").cast("double"), F.trim(F.coalesce("text", F.lit(""))).alias("text"))
    rows = rows.withColumn("opens", F.coalesce(F.col("start") - seen > gap, F.lit(False)).cast("int"))
    rows = rows.withColumn("run", F.sum("opens").over(order)).drop("opens")
    schema = T.StructType([df.schema[key], *T.StructType.fromDDL("start double, end double, text string").fields])

    def fold(batches):
        open_, run = None, None
        for batch in batches:
            kind, out = batch.schema.field(0).type, []
            for k, s, e, t, r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                same = open_ is not None and run == (k, r) and s - open_[2] <= gap
                if same and (t in open_[3] or open_[3] in t):
                    open_[2], open_[3] = max(open_[2], e), max(open_[3], t, key=len)
                elif t:
                    out += [open_] if open_ else []
                    open_, run = [k, s, e, t], (k, r)
            yield _rows(out, kind, schema.names, pa.string())
        if open_:
            yield _rows([open_], kind, schema.names, pa.string())

    ordered = rows.repartition(key, "run").sortWithinPartitions(key, "run", "start", "end", "text")
    return ordered.mapInArrow(fold, schema)


def _rows(rows: list[list], kind: pa.DataType, names: list[str], last: pa.DataType) -> pa.RecordBatch:
    kinds = [kind, pa.float64(), pa.float64(), last]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def chunked(df: DataFrame, key: str, window: float, most: float = 1.25, duration: str = "duration") -> DataFrame:
    """Windows (key, start, end, segments) over segments (key, start, end, duration) in order of their start.

    Segments are clipped to the recording, empty ones left out. A segment joins the open chunk while its end is at most
    ``most`` windows from the chunk's start, else opens the next. More than half a second before the first chunk or
    after the last is a window of its own, without segments. Runs between which no chunk can reach fold apart; they are
    streamed over sorted partitions with only the open chunk in memory. Null keys are one key.
    """
    clipped = df.select(key, F.greatest(F.lit(0.0), F.col("start")).alias("start"), F.least(F.col(duration), F.col("end")).alias("end"), F.col(duration).alias("duration"))
    clipped = clipped.where("end > start")
    schema = T.StructType([df.schema[key], *T.StructType.fromDDL("start double, end double, segments long").fields])

    def fold(batches):
        open_, run = None, None
        for batch in batches:
            kind, out = batch.schema.field(0).type, []
            for k, r, s, e in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if run == (k, r) and e - open_[1] <= window * most:
                    open_[2], open_[3] = max(open_[2], e), open_[3] + 1
                else:
                    out += [open_] if open_ else []
                    open_, run = [k, s, e, 1], (k, r)
            yield _rows(out, kind, schema.names, pa.int64())
        if open_:
            yield _rows([open_], kind, schema.names, pa.int64())

    runs = chunk_runs(clipped, key, window, most).select(key, "run", F.col("start").cast("double"), F.col("end").cast("double"))
    ordered = runs.repartition(key, "run").sortWithinPartitions(key, "run", "start", "end")
    chunks = staged(ordered.mapInArrow(fold, schema), "chunks")
    ends = chunks.groupBy(key).agg(F.min("start").alias("first"), F.max_by("end", F.struct("start", "end")).alias("last"))
    ends = ends.join(clipped.groupBy(key).agg(F.max("duration").alias("duration")), key)
    none = F.lit(0).cast("long").alias("segments")
    head = ends.where("first > 0.5").select(key, F.lit(0.0).alias("start"), F.col("first").alias("end"), none)
    tail = ends.where("last < duration - 0.5").select(key, F.col("last").alias("start"), F.col("duration").alias("end"), none)
    return chunks.unionByName(head).unionByName(tail)
