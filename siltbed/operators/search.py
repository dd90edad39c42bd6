"""Searches of record tables, the best of a sweep, and traffic at a moment."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.functions import arrays as ar
from siltbed.operators import series


def matches(blob: Column, query: str, area: str | None = None) -> Column:
    """Whether a record's text holds every word of the query and the whole area, in any case; a null text holds nothing."""
    text, test = F.lower(F.coalesce(blob, F.lit(""))), F.lit(True)
    for word in query.lower().split():
        test = test & F.contains(text, F.lit(word))
    return test & F.contains(text, F.lit((area or "").strip().lower()))


def registry_search(records: DataFrame, texts: list[str], query: str, order: str, top_k: int, area=None, window=None, valid=("valid_from", "valid_to")):
    """The first ``top_k`` records by ``order`` that match; an answer of at most so many rows is what is asked for.

    With a window (low, high), records whose stated validity misses it go; an open or absent end reaches for ever.
    """
    hit = matches(F.concat_ws(" ", *texts), query, area)
    if window is not None:
        hit = hit & ar.validity_overlaps(F.col(valid[0]), F.col(valid[1]), *[F.lit(x) for x in window])
    return records.where(hit).orderBy(order).limit(top_k)


def best_sweep(sweeps: DataFrame, key: str, order: str) -> DataFrame:
    """key and the best row of each (as ``best``): inlier_ratio, then match_count, then score; the first of equals.

    A missing ratio or score counts as -1, a missing count as 0.
    """
    rank = F.struct(
        F.coalesce("inlier_ratio", F.lit(-1.0)), F.coalesce(F.col("match_count").cast("long"), F.lit(0).cast("long")),
        F.coalesce("score", F.lit(-1.0)), -F.col(order),
    )
    return sweeps.groupBy(key).agg(F.max_by(F.struct(*[c for c in sweeps.columns if c != key]), rank).alias("best"))


def nearby_traffic(states: DataFrame, key: str, ts: str, at: str, freshness: int, box: tuple[float, float, float, float]) -> DataFrame:
    """States (key, ts, lat, lon, ...) inside the box (west, south, east, north) at a moment, one for each key."""
    west, south, east, north = box
    now = series.snapshot(states, [key], ts, at, freshness)
    return now.where(F.col("lon").between(west, east) & F.col("lat").between(south, north))


# Quotation marks around a quoted piece of evidence, and the rule's lengths, ratio and number of windows.
QUOTED = "[\"'“「『](.*?)[\"'”」』]"
LEAST_NEEDLE, LEAST_HELD, LEAST_RATIO, WINDOWS = 6, 8, 0.33, 4


@F.pandas_udf(T.DoubleType())
def matching_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """Twice the share of matching blocks."""
    return pd.Series([SequenceMatcher(None, a, b).ratio() for a, b in zip(left, right, strict=True)], dtype=float)


def evidence_windows(evidence: DataFrame, transcript: DataFrame, key: str) -> DataFrame:
    """(key, evidence_id, rank, start, end): the first four segments in which evidence is found.

    evidence: key, evidence_id, evidence; transcript: key, start, end, text. White space does not count. The whole evidence
    and its quoted pieces, of six characters or more, are found in a segment that holds them, or that they hold if it has
    eight characters; a quoted piece also where both have eight and their matching ratio is 0.33 or more. What lengths
    alone rule out never reaches the ratio. Segments of fewer than six characters and null texts are left out.
    """
    def squeezed(text: Column) -> Column:
        return F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", "")

    quoted = F.array_distinct(F.transform(F.regexp_extract_all("evidence", F.lit(QUOTED), F.lit(1)), squeezed))
    needle = F.concat(F.array(F.struct(squeezed(F.col("evidence")).alias("text"), F.lit(False).alias("quoted"))), F.transform(quoted, lambda q: F.struct(q.alias("text"), F.lit(True).alias("quoted"))))
    needles = evidence.where("evidence IS NOT NULL").select(key, "evidence_id", F.explode(needle).alias("n")).where(F.char_length("n.text") >= LEAST_NEEDLE)
    needles = needles.groupBy(key, "evidence_id", F.col("n.text").alias("needle")).agg(F.max("n.quoted").alias("quoted"))
    segments = transcript.select(key, "start", "end", squeezed(F.col("text")).alias("held")).where(F.char_length("held") >= LEAST_NEEDLE)
    met = needles.join(segments, key)
    short = F.least(F.char_length("needle"), F.char_length("held"))
    held = F.contains("held", F.col("needle")) | ((F.char_length("held") >= LEAST_HELD) & F.contains("needle", F.col("held")))
    alike = F.col("quoted") & (short >= LEAST_HELD) & (short * 2.0 >= (F.char_length("needle") + F.char_length("held")) * LEAST_RATIO)
    columns = [key, "evidence_id", "start", "end"]
    found = met.where(held).select(*columns)
    rest = met.where(~held & alike).withColumn("ratio", matching_ratio("needle", "held")).where(F.col("ratio") >= LEAST_RATIO).select(*columns)
    order = Window.partitionBy(key, "evidence_id").orderBy("start", "end")
    ranked = found.unionByName(rest).distinct().withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= WINDOWS).select(key, "evidence_id", "rank", "start", "end")
