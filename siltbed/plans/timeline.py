"""Interval, episode and series queries over events and orders; the streaming extension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.functions import arrays as ar
from siltbed.functions import text as tx
from siltbed.operators import intervals as iv
from siltbed.operators import series as se
from siltbed.operators import trajectory as tr
from siltbed.sources import fixtures as fx
from siltbed.streaming import streams as st


def interval_merge(spark: SparkSession, sf: str) -> DataFrame:
    out = iv.merged(fx.segments(spark, sf), ["user_id"], "start", "end")
    return out.select("user_id", F.round("start", 3).alias("start"), F.round("end", 3).alias("end"), "members")


def segment_overlap_slice(spark: SparkSession, sf: str) -> DataFrame:
    """Segments that share time with a user's hour-long task windows."""
    seg = fx.segments(spark, sf)
    left = seg.select("user_id", "event_id", F.col("start").alias("start_l"), F.col("end").alias("end_l"))
    right = seg.where("kind = 'purchase'").select(
        "user_id", F.col("event_id").alias("task"), (F.col("start") - 1800).alias("start_r"), (F.col("start") + 1800).alias("end_r")
    )
    return iv.overlap_join(left, right, "user_id", 7200.0).select("user_id", "event_id", "task")


def role_at_time(spark: SparkSession, sf: str) -> DataFrame:
    """The first segment that is open at each view, by start and id."""
    seg = fx.segments(spark, sf)
    points = seg.where("kind = 'view'").select("user_id", F.col("event_id").alias("id"), (F.col("start") + 5).alias("at"))
    roles = seg.where("kind != 'view'").select("user_id", "start", (F.col("end") + 3600).alias("end"), F.struct("start", "event_id").alias("ord"), F.col("kind").alias("role"))
    return iv.role_at(points, roles, "user_id", 7200.0).select("user_id", "id", "role")


def tumbling_windows(spark: SparkSession, sf: str) -> DataFrame:
    docs = fx.table(spark, sf, "documents").select("doc_id", (F.col("n_chars") / 10.0).alias("duration"))
    out = iv.tumbling(docs, F.col("duration"), 30.0)
    return out.groupBy("doc_id").agg(F.count(F.lit(1)).alias("windows"), F.round(F.max(F.col("end") - F.col("start")), 6).alias("longest"), F.round(F.max("end"), 6).alias("last"))


def episode_best_frame(spark: SparkSession, sf: str) -> DataFrame:
    seg = fx.segments(spark, sf)
    out = iv.episodes(seg, ["user_id"], ["start", "event_id"], F.col("kind") != "error", [F.col("value").desc_nulls_last(), "start", "event_id"])
    return out.select("user_id", "episode", "event_id", "frames")


def even_subsample(spark: SparkSession, sf: str) -> DataFrame:
    return iv.even_subsample(fx.segments(spark, sf), ["user_id"], ["start", "event_id"], 6).select("user_id", "event_id")


def dense_sampling(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.segments(spark, sf).select("event_id", F.lit(0.0).alias("start"), ((F.col("event_id") % 400 + 1) / 7.0).alias("end"))
    out = iv.dense_samples(rows, ["event_id"], "start", "end", 10_000)
    return out.groupBy("event_id").agg(F.count(F.lit(1)).alias("samples"), F.max("at_ms").alias("last"))


def adjacent_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Turns of a conversation as segments, folded where one text holds its neighbour."""
    rows = fx.table(spark, sf, "conversations").select("conv_id", F.col("turn").cast("double").alias("start"), (F.col("turn") + 0.8).alias("end"), "text")
    return iv.adjacent_merged(rows, "conv_id")


def anchor_chunks(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.segments(spark, sf).select("user_id", "start", "end")
    ends = rows.groupBy("user_id").agg((F.max("end") + 3600.0).alias("duration"))
    return iv.chunked(rows.join(ends, "user_id"), "user_id", 7200.0)


def daily_mean_sum_mode(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.table(spark, sf, "events").select("event_type", "ts", F.round(F.col("value")).alias("value"), "event_id")
    out = se.daily(rows, ["event_type"], "ts", "value", "event_id")
    return out.select("event_type", "day", F.round("mean", 6).alias("mean"), F.round("sum", 4).alias("sum"), "mode")


def refine_condition(spark: SparkSession, sf: str) -> DataFrame:
    """Events of a span of dates whose value meets the condition."""
    rows = fx.table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    return se.refined(rows, "day", date(2024, 1, 5), date(2024, 1, 20), "value", "<=", 20.0).select("event_id", "value")


def align_hourly_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Each order day with the last event value of that day's month and day."""
    stamp = F.date_format("o_orderdate", "MM-dd").alias("stamp")
    targets = fx.table(spark, sf, "orders").select("o_orderkey", stamp)
    series = fx.table(spark, sf, "events").select(F.date_format("ts", "MM-dd").alias("stamp"), "event_id", "value")
    return se.aligned(targets, series, "stamp", "event_id", "value").select("o_orderkey", "stamp", "value")


def scene_select(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as scenes of a customer: the earliest, the latest and the least cloudy."""
    scenes = fx.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", (F.floor("o_totalprice") % 5 * 10.0).alias("cloud"))
    out = None
    for mode in ("earliest", "latest", "least_cloud"):
        one = se.chosen_scenes(scenes, ["o_custkey"], mode, "o_orderdate", "cloud", "o_orderkey").select("o_custkey", F.lit(mode).alias("mode"), "o_orderkey")
        out = one if out is None else out.unionByName(one)
    return out


def nearest_record(spark: SparkSession, sf: str) -> DataFrame:
    """For each purchase the user's view nearest in time."""
    rows = fx.table(spark, sf, "events").select("user_id", "event_id", fx.micros(F.col("ts")).alias("us"), "event_type")
    points = rows.where("event_type = 'purchase'").select("user_id", F.col("us").alias("at"), F.col("event_id").alias("point_id"))
    others = rows.where("event_type = 'view'").select("user_id", F.col("us").alias("view_at"), F.col("event_id").alias("view_id"))
    return se.nearest(points, others, ["user_id"], "at", "view_at", "point_id", "view_id")


def interleave_providers(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.table(spark, sf, "documents").select("doc_id", "source", "n_chars")
    return se.interleaved(rows, "source", "source", [F.col("n_chars").desc(), "doc_id"], 50).select("position", "doc_id", "source")


def top_k_clamped(spark: SparkSession, sf: str, k: int = 500, most: int = 100) -> DataFrame:
    rows = fx.table(spark, sf, "part").select("p_partkey", "p_retailprice")
    return rows.orderBy(F.col("p_retailprice").desc(), "p_partkey").limit(min(max(1, k), most))


def validity_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Orders valid from their date, for a hundred days or (every fifth) for ever, against one window."""
    start, end = (F.lit(d).cast("timestamp_ntz") for d in ("1996-01-01", "1996-02-01"))
    high = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderdate") + F.expr("INTERVAL 100 DAYS"))
    hit = ar.validity_overlaps(F.col("o_orderdate"), high, start, end)
    return fx.table(spark, sf, "orders").where(hit).select("o_orderkey")


def month_circular_delta(spark: SparkSession, sf: str) -> DataFrame:
    months = F.month("o_orderdate")
    return fx.table(spark, sf, "orders").select("o_orderkey", ar.month_delta(months, F.lit(11)).alias("months"))


def threshold_crossing(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.table(spark, sf, "events").select("user_id", (fx.micros(F.col("ts")) / 1e6).alias("t"), "value")
    first = rows.groupBy("user_id", "t").agg(F.min("value").alias("value"))
    up, down = (se.crossings(first, ["user_id"], "t", "value", 50.0, r) for r in (True, False))
    up, down = (x.select("user_id", F.round("crossed_at", 2).alias(n)) for x, n in ((up, "rises"), (down, "falls")))
    return up.join(down, "user_id", "full")


def state_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    at = "2024-01-05 00:00:00"
    return se.snapshot(rows, ["user_id"], "ts", at, 86400 * 5).select("user_id", "event_id", "event_type")


def running_context(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.table(spark, sf, "events").select("user_id", "event_id", "ts", F.when(F.col("event_type") == "purchase", F.col("event_id")).alias("bought"))
    return tr.running_last(rows, ["user_id"], ["ts", "event_id"], "bought", "last_bought").select("event_id", "last_bought")


def timecodes(spark: SparkSession, sf: str) -> DataFrame:
    return fx.table(spark, sf, "documents").select("doc_id", tx.timecode(F.col("n_chars") * 1.5).alias("timecode"))


def stream_tumbling(spark: SparkSession, sf: str) -> DataFrame:
    """Extension: counts of hourly windows, from a stream of the events."""
    rows = st.timed(st.source(spark, sf, "events"), "ts", "10 minutes")
    out = st.completed(st.tumbling_counts(rows, "ts", "1 hour", ["event_type"], "event_id"), "complete")
    return out.select(F.col("window.start").cast("timestamp_ntz").alias("start"), "event_type", "n", "total")


def stream_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Extension: sessions of users, from a stream of the events."""
    rows = st.timed(st.source(spark, sf, "events"), "ts", "10 minutes")
    out = st.completed(st.session_counts(rows, "ts", "6 hours", ["user_id"]), "complete")
    return out.select(F.col("session_window.start").cast("timestamp_ntz").alias("start"), "user_id", "n")


def stream_first_calls(spark: SparkSession, sf: str) -> DataFrame:
    """Extension: repeats of a call within the watermark are dropped, from a stream of the events."""
    rows = st.timed(st.source(spark, sf, "events"), "ts", "3650 days").withColumn("call", F.col("event_id") % 500)
    out = st.completed(st.without_repeats(rows.select("call", "ts"), ["call"]), "append")
    return out.select("call")


S = f"WITH {fx.SEGMENTS_SQL}"
ORACLE_SQL = {
    "interval_merge": f"""{S}, r AS (SELECT *, max("end") OVER (PARTITION BY user_id ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM segments),
        i AS (SELECT *, sum(CASE WHEN seen IS NULL OR start > seen + 1e-3 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS island FROM r)
        SELECT user_id, round(min(start), 3) AS start, round(max("end"), 3) AS "end", count(*) AS members FROM i GROUP BY user_id, island""",
    "segment_overlap_slice": f"""{S} SELECT a.user_id, a.event_id, b.event_id AS task FROM segments a JOIN segments b ON a.user_id = b.user_id AND b.kind = 'purchase'
        AND a."end" > b.start - 1800 + 1e-6 AND a.start < b.start + 1800 - 1e-6""",
    "role_at_time": f"""{S}, p AS (SELECT user_id, event_id AS id, start + 5 AS at FROM segments WHERE kind = 'view')
        SELECT p.user_id, p.id, (SELECT s.kind FROM segments s WHERE s.user_id = p.user_id AND s.kind <> 'view' AND p.at >= s.start - 1e-6
        AND p.at <= s."end" + 3600 + 1e-6 ORDER BY s.start, s.event_id LIMIT 1) AS role FROM p""",
    "tumbling_windows": """WITH d AS (SELECT doc_id, n_chars / 10.0::DOUBLE AS duration FROM documents WHERE n_chars > 0),
        w AS (SELECT doc_id, duration, unnest(range(0, CAST(ceil(duration / 30) AS BIGINT))) AS i FROM d)
        SELECT doc_id, count(*) AS windows, round(max(least(duration, (i + 1) * 30.0::DOUBLE) - i * 30.0::DOUBLE), 6) AS longest,
        round(max(least(duration, (i + 1) * 30.0::DOUBLE)), 6) AS last FROM w GROUP BY doc_id""",
    "episode_best_frame": f"""{S}, b AS (SELECT *, sum(CASE WHEN kind <> 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY start, event_id ROWS UNBOUNDED PRECEDING) AS episode FROM segments),
        r AS (SELECT *, count(*) OVER (PARTITION BY user_id, episode) AS frames, row_number() OVER (PARTITION BY user_id, episode ORDER BY value DESC NULLS LAST, start, event_id) AS rank FROM b WHERE kind <> 'error')
        SELECT user_id, CAST(episode AS BIGINT) AS episode, event_id, frames FROM r WHERE rank = 1""",
    "even_subsample": f"""{S}, n AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY start, event_id) - 1 AS place, count(*) OVER (PARTITION BY user_id) AS n FROM segments),
        x AS (SELECT *, [round_even(i * (n - 1) / 5.0::DOUBLE, 0) FOR i IN range(0, 6)] AS steps FROM n)
        SELECT user_id, event_id FROM x WHERE n <= 6 OR list_contains(steps, place)""",
    "dense_sampling": """WITH e AS (SELECT event_id, CAST(round((event_id % 400 + 1) / 7.0::DOUBLE * 1000) AS BIGINT) AS high FROM events),
        t AS (SELECT event_id, unnest(list_distinct(list_append(range(0, high + 1, 10000), high))) AS at_ms FROM e)
        SELECT event_id, count(*) AS samples, max(at_ms) AS last FROM t GROUP BY event_id""",
    "daily_mean_sum_mode": """WITH e AS (SELECT event_type, CAST(ts AS DATE) AS day, ts, event_id, round(value) AS value FROM events),
        c AS (SELECT event_type, day, value, count(*) AS n, min((ts, event_id)) AS seen FROM e WHERE value IS NOT NULL GROUP BY ALL),
        m AS (SELECT event_type, day, value AS mode, row_number() OVER (PARTITION BY event_type, day ORDER BY n DESC, seen) AS rank FROM c),
        s AS (SELECT event_type, day, round(avg(value), 6) AS mean, round(sum(value), 4) AS sum FROM e GROUP BY ALL)
        SELECT s.event_type, s.day, mean, sum, mode FROM s LEFT JOIN m ON m.event_type = s.event_type AND m.day = s.day AND rank = 1""",
    "refine_condition": "SELECT event_id, value FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' AND value <= 20.0",
    "align_hourly_daily": """WITH s AS (SELECT strftime(ts, '%m-%d') AS stamp, arg_max(value, event_id) AS value FROM events GROUP BY 1)
        SELECT o_orderkey, strftime(o_orderdate, '%m-%d') AS stamp, value FROM orders LEFT JOIN s ON s.stamp = strftime(o_orderdate, '%m-%d')""",
    "scene_select": """WITH s AS (SELECT o_custkey, o_orderkey, o_orderdate, CAST(floor(o_totalprice) AS BIGINT) % 5 * 10.0::DOUBLE AS cloud FROM orders),
        f AS (SELECT *, CASE WHEN cloud = 0 THEN 100.0 ELSE cloud END AS falsy FROM s),
        r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, falsy, o_orderkey) AS a,
              row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, falsy, o_orderkey) AS b,
              row_number() OVER (PARTITION BY o_custkey ORDER BY cloud, o_orderdate DESC, o_orderkey) AS c FROM f)
        SELECT o_custkey, 'earliest' AS mode, o_orderkey FROM r WHERE a = 1 UNION ALL SELECT o_custkey, 'latest', o_orderkey FROM r WHERE b = 1
        UNION ALL SELECT o_custkey, 'least_cloud', o_orderkey FROM r WHERE c = 1""",
    "nearest_record": """WITH e AS (SELECT user_id, event_id, epoch_us(ts) AS us, event_type FROM events),
        p AS (SELECT * FROM e WHERE event_type = 'purchase'), v AS (SELECT * FROM e WHERE event_type = 'view'),
        r AS (SELECT p.user_id, p.us AS "at", p.event_id AS point_id, v.us AS view_at, v.event_id AS view_id,
              row_number() OVER (PARTITION BY p.event_id ORDER BY abs(p.us - v.us), v.us, v.event_id) AS rank FROM p LEFT JOIN v ON p.user_id = v.user_id)
        SELECT user_id, "at", point_id, view_at, view_id FROM r WHERE rank = 1""",
    "interleave_providers": """WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS turn FROM documents),
        p AS (SELECT doc_id, source, row_number() OVER (ORDER BY turn, source) AS position FROM r) SELECT position, doc_id, source FROM p WHERE position <= 50""",
    "top_k_clamped": "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 100",
    "validity_overlap": """SELECT o_orderkey FROM orders WHERE NOT (coalesce(CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate + INTERVAL 100 DAY END < TIMESTAMP '1996-01-01', false)
        OR coalesce(o_orderdate > TIMESTAMP '1996-02-01', false))""",
    "month_circular_delta": "SELECT o_orderkey, CAST(least(abs(month(o_orderdate) - 11) % 12, 12 - abs(month(o_orderdate) - 11) % 12) AS INT) AS months FROM orders",
    "threshold_crossing": """WITH e AS (SELECT user_id, epoch_us(ts) / 1e6::DOUBLE AS t, min(value) AS v FROM events GROUP BY ALL),
        l AS (SELECT *, lead(t) OVER w AS t2, lead(v) OVER w AS v2 FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t)),
        x AS (SELECT *, t + (t2 - t) * ((50.0::DOUBLE - v) / (v2 - v)) AS hit FROM l),
        u AS (SELECT user_id, round(min(hit), 2) AS rises FROM x WHERE v < 50 AND v2 >= 50 GROUP BY user_id),
        d AS (SELECT user_id, round(max(hit), 2) AS falls FROM x WHERE v > 50 AND v2 <= 50 GROUP BY user_id)
        SELECT coalesce(u.user_id, d.user_id) AS user_id, rises, falls FROM u FULL JOIN d ON u.user_id = d.user_id""",
    "state_snapshot": """WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rank FROM events
        WHERE ts <= TIMESTAMP '2024-01-05' AND ts >= TIMESTAMP '2024-01-05' - INTERVAL 432000 SECOND) SELECT user_id, event_id, event_type FROM r WHERE rank = 1""",
    "running_context": """SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS)
        OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_bought FROM events""",
    "timecodes": """WITH d AS (SELECT doc_id, CAST(floor(n_chars * 1.5::DOUBLE) AS BIGINT) AS s FROM documents)
        SELECT doc_id, CASE WHEN s >= 3600 THEN printf('%02d:%02d:%02d', s // 3600, s // 60 % 60, s % 60) ELSE printf('%02d:%02d', s // 60 % 60, s % 60) END AS timecode FROM d""",
    "stream_tumbling": "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS total FROM events GROUP BY 1, 2",
    "stream_sessions": """WITH l AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens FROM events),
        s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM l) SELECT min(ts) AS start, user_id, count(*) AS n FROM s GROUP BY user_id, session""",
    "stream_first_calls": "SELECT DISTINCT event_id % 500 AS call FROM events",
}

QUERIES = {
    f.__name__: f
    for f in (
        interval_merge, segment_overlap_slice, role_at_time, tumbling_windows, episode_best_frame, even_subsample, dense_sampling,
        adjacent_segments, anchor_chunks, daily_mean_sum_mode, refine_condition, align_hourly_daily, scene_select, nearest_record,
        interleave_providers, top_k_clamped, validity_overlap, month_circular_delta, threshold_crossing, state_snapshot,
        running_context, timecodes, stream_tumbling, stream_sessions, stream_first_calls,
    )
}
