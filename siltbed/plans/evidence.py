"""Queries over map elements, dates, the sun, tasks, scores and calls, each over its whole table, with DuckDB SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.functions import dates as dt
from siltbed.functions import geo, sky
from siltbed.functions import arrays as ar
from siltbed.functions import text as tx
from siltbed.operators import contract, dedup, elements, fusion, search, series, tasks
from siltbed.operators import trajectory as tr
from siltbed.sources import fixtures as fx


def _elements(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as map elements; every seventh has no brand, every fifth no size."""
    key = F.col("p_partkey")
    tags = F.map_from_entries(F.array_compact(F.array(
        F.struct(F.lit("kind").alias("k"), F.col("p_type").alias("v")),
        F.when(key % 7 != 0, F.struct(F.lit("brand").alias("k"), F.col("p_brand").alias("v"))),
        F.when(key % 5 != 0, F.struct(F.lit("size").alias("k"), F.col("p_size").cast("string").alias("v"))),
    )))
    kind = F.element_at(F.array(*map(F.lit, ("node", "way", "relation"))), (key % 3 + 1).cast("int"))
    return fx.table(spark, sf, "part").select(key.alias("id"), kind.alias("osm_type"), tags.alias("tags"))


ELEMENTS_SQL = """e AS (SELECT p_partkey AS id, CASE p_partkey % 3 WHEN 0 THEN 'node' WHEN 1 THEN 'way' ELSE 'relation' END AS osm_type,
    p_type AS kind, CASE WHEN p_partkey % 7 <> 0 THEN p_brand END AS brand,
    CASE WHEN p_partkey % 5 <> 0 THEN CAST(p_size AS VARCHAR) END AS size FROM part)"""


def tag_filter_wildcard(spark: SparkSession, sf: str) -> DataFrame:
    found = elements.tag_filtered(_elements(spark, sf), {"brand": "*", "kind": "ECONOMY"}, ("node", "way"))
    return found.select("id", "osm_type")


def tag_group_count(spark: SparkSession, sf: str) -> DataFrame:
    return elements.tag_counts(_elements(spark, sf), ["kind", "brand"])


def osm_count_conditional(spark: SparkSession, sf: str) -> DataFrame:
    return elements.type_counts(_elements(spark, sf))


def osm_count_groups(spark: SparkSession, sf: str) -> DataFrame:
    return elements.labelled_counts(_elements(spark, sf), ["kind", "brand"])


_pairs, PAIRS_SQL = fx.customer_supplier_pairs, fx.PAIRS_SQL


def planar_bearing(spark: SparkSession, sf: str) -> DataFrame:
    angle = geo.planar_bearing(*[F.col(x) for x in ("lat", "lon", "lat2", "lon2")])
    metres = geo.haversine(*[F.col(x) for x in ("lat", "lon", "lat2", "lon2")])
    return _pairs(spark, sf).select("id", F.round(angle, 6).alias("angle"), F.round(geo.in_unit(metres, "km"), 6).alias("km"), F.round(geo.in_unit(metres, "mile"), 6).alias("miles"))


def gcj02_inverse(spark: SparkSession, sf: str) -> DataFrame:
    """There and back again: the shifted place's inverse is the place."""
    lon, lat = geo.gcj02(F.col("lon"), F.col("lat"))
    moved = fx.customer_points(spark, sf).select("id", lon.alias("gcj_lon"), lat.alias("gcj_lat"))
    back = geo.gcj02_inverse(F.col("gcj_lon"), F.col("gcj_lat"))
    return moved.select("id", *[F.round(x, 8).alias(name) for x, name in zip(back, ("lon", "lat"), strict=True)])


def wkt_points(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("id") % 9 == 0, "none").otherwise(F.concat(F.lit("SRID=4326;POINT ("), F.col("lon").cast("decimal(9,2)").cast("string"), F.lit(" "), F.col("lat").cast("decimal(9,2)").cast("string"), F.lit(")")))
    lon, lat = geo.point_of_wkt(text)
    return fx.customer_points(spark, sf).select("id", F.round(lon, 2).alias("lon"), F.round(lat, 2).alias("lat"))


def sun_position(spark: SparkSession, sf: str) -> DataFrame:
    """The sun over each order's place at the hour of its key."""
    key = F.col("o_orderkey")
    at = F.unix_timestamp(F.col("o_orderdate").cast("timestamp")) + key % 24 * 3600
    up, turned = sky.sun_position(at.cast("double"), fx.latitude(key), fx.longitude(key))
    return fx.table(spark, sf, "orders").select(key.alias("id"), F.round(up, 5).alias("elevation"), F.round(turned, 4).alias("azimuth"))


def shadow_plane(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("p_partkey")
    height = F.when(key % 11 != 0, F.col("p_size").cast("double"))
    aspect = F.when(key % 4 != 0, (key * 7 % 360).cast("double"))
    found = sky.shadow((key * 13 % 360 + 0.5), (key % 100 - 10).cast("double"), height, (key % 50).cast("double"), aspect)
    names = ("status", "east", "north", "length", "azimuth")
    return fx.table(spark, sf, "part").select(key.alias("id"), *[(x if n == "status" else F.round(x, 4)).alias(n) for n, x in zip(names, found, strict=True)])


def scene_filter(spark: SparkSession, sf: str) -> DataFrame:
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    cloud = F.when(key % 6 != 0, (key % 100).cast("double"))
    keep = dt.scene_matches((key % 40).cast("double"), cloud, day, 30.0, 20.0, "1995-01-01", "1997-12-31")
    return fx.table(spark, sf, "orders").where(keep).select(key.alias("id"), day.cast("string").alias("captured"))


def _dates() -> dict:
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    return {
        "permit": F.when(key % 3 == 0, day), "started": F.when(key % 4 == 0, F.date_add(day, 30)), "completed": F.when(key % 8 == 0, F.date_add(day, 400)),
        "opened": F.when(key % 16 == 0, F.date_add(day, 500)), "recorded": F.when(key % 5 != 0, F.date_add(day, 700)),
    }


def any_date_in_window(spark: SparkSession, sf: str) -> DataFrame:
    low, high = F.lit("1996-01-01").cast("date"), F.lit("1996-12-31").cast("date")
    works, permits = (dt.any_in_window(dt.primary_dates(_dates(), permit), low, high) for permit in (False, True))
    return fx.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), works.alias("works"), permits.alias("permits"))


def captured_bounds(spark: SparkSession, sf: str) -> DataFrame:
    key, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    year = F.date_format("o_orderdate", "yyyy")
    note = (
        F.when(key % 5 == 0, F.concat(day, F.lit("T10:00:00Z"))).when(key % 5 == 1, year).when(key % 5 == 2, F.concat(F.lit("taken about "), year, F.lit(" or 2031")))
        .when(key % 5 == 3, F.lit("no date, lens 9999"))
    )
    low, high = dt.captured_bounds(note)
    return fx.table(spark, sf, "orders").select(key.alias("id"), low.cast("string").alias("first"), high.cast("string").alias("last"))


def split_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    """Events as tasks of their users' recordings."""
    e = F.col("event_id")
    start = (e % 100).cast("double")
    rows = fx.table(spark, sf, "events").select(
        "event_id", "user_id", start.alias("start"), (start + e % 13 - 1).alias("end"), F.lit(105.0).alias("duration"),
        F.when(e % 3 == 0, start + 20).alias("display_start"), F.when(e % 3 == 0, start + 20 + e % 5 - 1).alias("display_end"),
        F.when(e % 4 != 0, "resolved").otherwise("open").alias("status"), F.when(e % 9 != 0, F.concat("event_type", F.lit(" "), (e % 50).cast("string"))).alias("place"),
    )
    return tasks.split_flags(rows, "user_id", "duration", 2.0).select("event_id", F.concat_ws(",", "anomalies").alias("anomalies"))


def missed_action_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.table(spark, sf, "events").select("event_id", (F.col("event_id") % 2 == 0).alias("covered"), (F.col("event_id") % 101 / 100.0).alias("confidence"))
    return tasks.missed_actions(rows, "covered", "confidence").select("event_id")


def readiness_counts(spark: SparkSession, sf: str) -> DataFrame:
    level = F.element_at(F.array(*map(F.lit, ("ready", "ready", "context_resolvable", "repairable", "odd"))), (F.col("turn") * 7 % 5 + 1).cast("int"))
    calls = fx.table(spark, sf, "conversations").select("conv_id", F.when(F.col("turn") % 4 != 3, level).alias("level"))
    return tasks.readiness_summary(calls, "conv_id", "level", fusion.READINESS)


def flight_first_seen(spark: SparkSession, sf: str) -> DataFrame:
    """Flights by (aircraft, first seen), first record wins."""
    e = fx.table(spark, sf, "events").select("event_id", F.coalesce(F.col("user_id"), F.lit(0)).alias("aircraft"), F.coalesce(F.unix_timestamp(F.col("ts").cast("timestamp")) % 50, F.lit(0)).alias("seen"))
    return dedup.first_wins(e, ["aircraft", "seen"], ["event_id"]).select("event_id", "aircraft", "seen")


def credentials_redacted(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents, some with keys planted beside those they have."""
    planted = F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit(" key AIza"), F.md5("text"), F.lit(" Bearer\tabc.def-"), F.md5("text"))).otherwise(F.col("text"))
    rows = fx.table(spark, sf, "documents").select("doc_id", planted.alias("t"))
    return rows.select("doc_id", tx.has_credentials(F.col("t")).alias("found"), F.md5(tx.redacted(F.col("t"))).alias("clean_md5"))


def public_http_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Every page's url, and what it becomes with user info, as a private address and as IPv6."""
    n = F.col("page_id")
    url = (
        F.when(n % 5 == 1, F.concat(F.lit("http://user@"), F.regexp_replace("url", "^[a-z]+://", "")))
        .when(n % 5 == 2, F.concat(F.lit("http://"), (n % 256).cast("string"), F.lit("."), (n % 300).cast("string"), F.lit(".7.9:80/x")))
        .when(n % 5 == 3, F.lit("http://[::1]/")).otherwise(F.col("url"))
    )
    return fx.table(spark, sf, "pages").select("page_id", tx.public_http(url).alias("public"))


def page_titles(spark: SparkSession, sf: str) -> DataFrame:
    url = tx.clean_url(F.concat("url", F.lit("&utm_source=x#top")))
    return fx.table(spark, sf, "pages").select("page_id", tx.page_title(F.col("html")).alias("title"), F.md5(tx.untrusted(tx.page_title(F.col("html")))).alias("wrapped_md5"), url.alias("clean"))


def token_and_filter(spark: SparkSession, sf: str) -> DataFrame:
    return fx.table(spark, sf, "part").where(tx.tokens_all_in(F.concat_ws(" ", "p_name", "p_brand", "p_type"), "RED brand#1")).select(F.col("p_partkey").alias("id"))


def score_fusion(spark: SparkSession, sf: str) -> DataFrame:
    """Events as trajectories: weighted score, gates, cap, coverage, decision, priority and admission."""
    e = F.col("event_id")
    scores = {"a": e % 101 / 100.0, "b": e * 7 % 103 / 100.0, "c": e * 3 % 50 / 50.0}
    base = fusion.weighted(scores, {"a": 0.5, "b": 0.3, "c": 0.4})
    code = lambda test, name: F.when(test, F.struct(F.lit(name).alias("code"), F.lit("x").alias("evidence")))
    gates = F.array_compact(F.array(code(e % 10 == 0, "no_result"), code(e % 6 == 0, "observation_needs_repair"), code(e % 4 == 0, "task_needs_review"), code(e % 10 == 0, "no_result"), code(e % 7 == 0, " ")))
    first = fusion.first_by_code(gates)
    rows = fx.table(spark, sf, "events").select("event_id", base.alias("base"), fusion.gate_codes(first, "blocking").alias("blocking"), fusion.gate_codes(first, "soft").alias("soft"))
    present = {name: e % (i + 2) != 0 for i, name in enumerate(fusion.COVERAGE_WEIGHTS)}
    rows = rows.withColumn("quality", fusion.capped(F.col("base"), F.col("blocking"), F.col("soft"), e % 13 == 0, 0.4)).withColumn("coverage", fusion.coverage(present))
    worst = ar.worst(F.array(F.lit("ready"), F.when(e % 9 == 0, "repairable").otherwise("context_resolvable")), fusion.READINESS)
    rows = rows.withColumn("worst", worst).withColumn("decided", fusion.decision(F.col("quality"), F.col("blocking"), F.col("soft"), F.col("coverage"), F.col("worst")))
    skipped = fusion.admission(F.when(e % 17 != 0, F.col("quality")), F.col("decided"), e % 19 != 0)
    return rows.select("event_id", F.round("quality", 6).alias("quality"), F.round("coverage", 6).alias("coverage"), "worst", "decided", fusion.priority(F.col("decided"), F.col("quality"), 0.5, 0.8).alias("priority"), skipped.alias("skipped"))


def evidence_verdict(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_id")
    image = F.element_at(F.array(*map(F.lit, ("match", "weak", "none"))), (e % 3 + 1).cast("int"))
    text = F.element_at(F.array(*map(F.lit, ("match", "partial", "none", "none"))), (e % 4 + 1).cast("int"))
    matched, confidence = fusion.verdict(image, text)
    return fx.table(spark, sf, "events").select("event_id", matched.alias("verdict"), confidence.alias("confidence"))


def step_references(spark: SparkSession, sf: str) -> DataFrame:
    """Turns that point at the results of earlier, later and absent ones."""
    t = F.col("turn")
    text = F.concat(F.lit("see $step_"), F.greatest(t - 1, F.lit(0)).cast("string"), F.lit("_tool_result.a[0] and $step_"), (t + 50 * (t % 2)).cast("string"), F.lit("_tool_result"))
    rows = fx.table(spark, sf, "conversations").select("conv_id", "turn", text.alias("said"))
    return tr.references(rows, "conv_id", "turn", "said")


def tool_migration(spark: SparkSession, sf: str) -> DataFrame:
    calls = fx.table(spark, sf, "events").select("event_id", F.concat("event_type", F.lit("_v1")).alias("tool"))
    table = calls.select(F.col("tool").alias("old_tool")).distinct().where("old_tool != 'error_v1'").withColumn("new_tool", F.replace("old_tool", F.lit("_v1"), F.lit("_v2")))
    moved = tr.migrated(calls, table, "tool")
    return moved.groupBy("tool", "new_tool", "reason").agg(F.count(F.lit(1)).alias("calls"))


def unknown_tools(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_id")
    action = F.element_at(F.array(*map(F.lit, ("reasoning", "map", "new_operation", "new_executor"))), (e % 4 + 1).cast("int"))
    found = tr.unknown_tool_decision(action, e % 101 / 100.0, e % 3 == 0, e % 5 == 0, e % 7 != 0, e % 2 == 0, e % 4)
    return fx.table(spark, sf, "events").select("event_id", found.alias("decision"))


def skill_support(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_id")
    rows = fx.table(spark, sf, "events").select(
        F.col("user_id").alias("trajectory_id"), F.concat(F.lit("t"), (e % 40).cast("string")).alias("text"), F.lit("all").alias("applicability"),
        F.when(e % 3 == 0, "note").otherwise("tool").alias("kind"), F.col("event_type").alias("tool"), (e % 2).cast("string").alias("operation"),
    ).where("user_id IS NOT NULL AND event_type IS NOT NULL")
    catalog = rows.where("tool != 'error'").select("tool", "operation").distinct()
    return tr.skill_support(rows, catalog)[0].select("text", "kind", "tool", "operation", "support", "status")


def declared_names(spark: SparkSession, sf: str) -> DataFrame:
    return fx.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), contract.norm_name(F.concat("p_name", F.lit("-X "), "p_brand")).alias("name"))


def registry_search(spark: SparkSession, sf: str) -> DataFrame:
    """The first forty English pages of one domain, known or valid in January, that name both words."""
    start = F.when(F.col("page_id") % 3 != 0, F.make_date(F.lit(2024), (F.col("page_id") % 12 + 1).cast("int"), F.lit(1)))
    end = F.when(F.col("page_id") % 5 != 0, F.date_add(start, 20))
    rows = fx.table(spark, sf, "pages").select("page_id", "url", "html", start.alias("valid_from"), end.alias("valid_to"))
    window = (date(2024, 1, 5), date(2024, 1, 31))
    return search.registry_search(rows, ["url", "html"], "The /EN/", "page_id", 40, "example.com", window).select("page_id", "url")


def best_sweep(spark: SparkSession, sf: str) -> DataFrame:
    ratio = F.when(F.col("event_id") % 5 != 0, F.col("event_id") % 7 / 10.0)
    rows = fx.table(spark, sf, "events").select("user_id", "event_id", ratio.alias("inlier_ratio"), F.nullif(F.col("event_id") % 4, F.lit(3)).alias("match_count"), F.round("value").alias("score"))
    best = search.best_sweep(rows, "user_id", "event_id")
    return best.select("user_id", "best.event_id", "best.inlier_ratio", "best.match_count", "best.score")


def nearby_traffic(spark: SparkSession, sf: str) -> DataFrame:
    """Users whose last place of two days lies in a box, by kind."""
    key = F.col("event_id")
    rows = fx.table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", fx.latitude(key).alias("lat"), fx.longitude(key).alias("lon"))
    found = search.nearby_traffic(rows, "user_id", "ts", "2024-01-20 00:00:00", 172800, (102.0, 22.0, 116.0, 44.0))
    return found.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def twilight_times(spark: SparkSession, sf: str) -> DataFrame:
    """Sunset and the twilights' dawns and dusks over each supplier's place on a day of its key, in seconds."""
    key = F.col("s_suppkey")
    day = F.make_date(F.lit(2024), (key % 12 + 1).cast("int"), (key % 28 + 1).cast("int"))
    start = (F.unix_date(day) * 86400 - 28800).cast("double")
    rows = fx.table(spark, sf, "supplier").select(key.alias("id"), start.alias("start"), (fx.latitude(key) + 20.0).alias("lat"), fx.longitude(key).alias("lon"))
    levels = {name: (level, False) for name, level in sky.HORIZONS.items()}
    levels |= {f"{name}_dawn": (level, True) for name, level in sky.HORIZONS.items() if name != "sunset"}
    times = series.sun_crossings(rows, "id", levels)
    return times.select("id", *[F.round(c, 1).alias(c) for c in times.columns[1:]])


QUERIES = {
    f.__name__: f
    for f in (
        registry_search, best_sweep, nearby_traffic, twilight_times, tag_filter_wildcard, tag_group_count, osm_count_conditional, osm_count_groups, planar_bearing, gcj02_inverse, wkt_points, sun_position, shadow_plane,
        scene_filter, any_date_in_window, captured_bounds, split_anomalies, missed_action_filter, readiness_counts, flight_first_seen, credentials_redacted,
        public_http_gate, page_titles, token_and_filter, score_fusion, evidence_verdict, step_references, tool_migration, unknown_tools, skill_support, declared_names,
    )
}

D = "::DOUBLE"
ORDER_DATES = """d AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN day END AS permit, CASE WHEN o_orderkey % 4 = 0 THEN day + 30 END AS started,
    CASE WHEN o_orderkey % 8 = 0 THEN day + 400 END AS completed, CASE WHEN o_orderkey % 16 = 0 THEN day + 500 END AS opened,
    CASE WHEN o_orderkey % 5 <> 0 THEN day + 700 END AS recorded FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders))"""
BETWEEN = "BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'"
HALF = "power(sin(radians(lat2 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(lat2)) * power(sin(radians(lon2 - lon) / 2), 2)"

def _times_sql() -> str:
    falls = [(name, level, "max", "up > {0} AND after <= {0}") for name, level in sky.HORIZONS.items()]
    rises = [(f"{name}_dawn", level, "min", "up < {0} AND after >= {0}") for name, level in sky.HORIZONS.items() if name != "sunset"]
    hit = "t + ({0}::DOUBLE - up) / (after - up) * 120"
    return ", ".join(f"round({pick}({hit}) FILTER ({test}), 1) AS {name}".format(level) for name, level, pick, test in falls + rises)


ORACLE_SQL = {
    "twilight_times": f"""WITH p AS (SELECT s_suppkey AS id, epoch(make_date(2024, s_suppkey % 12 + 1, s_suppkey % 28 + 1)) - 28800{D} AS start,
            {fx.LAT_SQL.format('s_suppkey')} + 20 AS lat, {fx.LON_SQL.format('s_suppkey')} AS lon FROM supplier),
        o AS (SELECT id, lat, lon, unnest(range(720)) AS i, start + i * 120 AS t, t / 86400.0{D} - 10957.5{D} AS d FROM p),
        m AS (SELECT *, radians(357.528{D} + 0.9856003{D} * d) AS g, 280.460{D} + 0.9856474{D} * d AS q FROM o),
        l AS (SELECT *, radians(q + 1.915{D} * sin(g) + 0.020{D} * sin(2 * g)) AS ecl, radians(23.439{D} - 0.0000004{D} * d) AS tilt FROM m),
        a AS (SELECT *, asin(sin(tilt) * sin(ecl)) AS dec, radians((18.697374558{D} + 24.06570982441908{D} * d) * 15 + lon) - atan2(cos(tilt) * sin(ecl), cos(ecl)) AS ha FROM l),
        h AS (SELECT id, t, degrees(asin(sin(radians(lat)) * sin(dec) + cos(radians(lat)) * cos(dec) * cos(ha))) AS up FROM a),
        z AS (SELECT *, lead(up) OVER (PARTITION BY id ORDER BY t) AS after FROM h)
        SELECT id, {_times_sql()} FROM z GROUP BY id""",
    "registry_search": """WITH p AS (SELECT *, CASE WHEN page_id % 3 <> 0 THEN make_date(2024, page_id % 12 + 1, 1) END AS a FROM pages),
        v AS (SELECT *, CASE WHEN page_id % 5 <> 0 THEN a + 20 END AS b, lower(concat_ws(' ', url, html)) AS blob FROM p)
        SELECT page_id, url FROM v WHERE contains(blob, 'the') AND contains(blob, '/en/') AND contains(blob, 'example.com')
        AND NOT coalesce(b < DATE '2024-01-05', false) AND NOT coalesce(a > DATE '2024-01-31', false) ORDER BY page_id LIMIT 40""",
    "best_sweep": f"""WITH s AS (SELECT user_id, event_id, CASE WHEN event_id % 5 <> 0 THEN event_id % 7 / 10.0{D} END AS inlier_ratio,
        nullif(event_id % 4, 3) AS match_count, round(value) AS score FROM events),
        r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY coalesce(inlier_ratio, -1) DESC, coalesce(match_count, 0) DESC, coalesce(score, -1) DESC, event_id) AS rank FROM s)
        SELECT user_id, event_id, inlier_ratio, match_count, score FROM r WHERE rank = 1""",
    "nearby_traffic": f"""WITH r AS (SELECT *, {fx.LAT_SQL.format('event_id')} AS lat, {fx.LON_SQL.format('event_id')} AS lon,
        row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rank FROM events
        WHERE ts <= TIMESTAMP '2024-01-20' AND ts >= TIMESTAMP '2024-01-18')
        SELECT event_type, count(*) AS n FROM r WHERE rank = 1 AND lon BETWEEN 102 AND 116 AND lat BETWEEN 22 AND 44 GROUP BY event_type""",
    "tag_filter_wildcard": f"WITH {ELEMENTS_SQL} SELECT id, osm_type FROM e WHERE brand IS NOT NULL AND kind = 'ECONOMY' AND osm_type IN ('node', 'way')",
    "tag_group_count": f"WITH {ELEMENTS_SQL} SELECT coalesce(kind, '') AS kind, coalesce(brand, '') AS brand, count(*) AS \"count\" FROM e GROUP BY ALL",
    "osm_count_conditional": f"""WITH {ELEMENTS_SQL} SELECT count(*) FILTER (osm_type = 'node') AS nodes, count(*) FILTER (osm_type = 'way') AS ways,
        count(*) FILTER (osm_type = 'relation') AS relations, count(*) AS total FROM e""",
    "osm_count_groups": f"""WITH {ELEMENTS_SQL} SELECT 'kind=' || coalesce(kind, '<missing>') || ' | brand=' || coalesce(brand, '<missing>') AS "group", count(*) AS "count" FROM e GROUP BY ALL""",
    "planar_bearing": f"""WITH {PAIRS_SQL}, h AS (SELECT *, 2 * {geo.MEAN_RADIUS}{D} * asin(least(1.0, sqrt({HALF}))) AS m FROM p)
        SELECT id, round(degrees(atan2((lon2 - lon) * cos(radians((lat + lat2) / 2)), lat2 - lat)), 6) AS angle, round(m / 1000, 6) AS km, round(m / 1609.344{D}, 6) AS miles FROM h""",
    "gcj02_inverse": f"WITH {fx.POINTS_SQL} SELECT id, round(lon, 8) AS lon, round(lat, 8) AS lat FROM c",
    "wkt_points": f"WITH {fx.POINTS_SQL} SELECT id, CASE WHEN id % 9 <> 0 THEN round(lon, 2) END AS lon, CASE WHEN id % 9 <> 0 THEN round(lat, 2) END AS lat FROM c",
    "sun_position": f"""WITH o AS (SELECT o_orderkey AS id, {fx.LAT_SQL.format('o_orderkey')} AS lat, {fx.LON_SQL.format('o_orderkey')} AS lon,
            (epoch(o_orderdate) + o_orderkey % 24 * 3600) / 86400.0{D} - 10957.5{D} AS d FROM orders),
        m AS (SELECT *, radians(357.528{D} + 0.9856003{D} * d) AS g, 280.460{D} + 0.9856474{D} * d AS q FROM o),
        l AS (SELECT *, radians(q + 1.915{D} * sin(g) + 0.020{D} * sin(2 * g)) AS ecl, radians(23.439{D} - 0.0000004{D} * d) AS tilt FROM m),
        a AS (SELECT *, asin(sin(tilt) * sin(ecl)) AS dec, radians((18.697374558{D} + 24.06570982441908{D} * d) * 15 + lon) - atan2(cos(tilt) * sin(ecl), cos(ecl)) AS ha FROM l),
        z AS (SELECT id, degrees(asin(sin(radians(lat)) * sin(dec) + cos(radians(lat)) * cos(dec) * cos(ha))) AS h,
                     degrees(atan2(-sin(ha), tan(dec) * cos(radians(lat)) - sin(radians(lat)) * cos(ha))) AS az FROM a)
        SELECT id, round(h, 5) AS elevation, round(CASE WHEN az < 0 THEN az + 360 ELSE az END, 4) AS azimuth FROM z""",
    "shadow_plane": f"""WITH p AS (SELECT p_partkey AS id, p_partkey * 13 % 360 + 0.5{D} AS az, CAST(p_partkey % 100 - 10 AS DOUBLE) AS el,
            CASE WHEN p_partkey % 11 <> 0 THEN CAST(p_size AS DOUBLE) END AS h, CAST(p_partkey % 50 AS DOUBLE) AS sl, CASE WHEN p_partkey % 4 <> 0 THEN p_partkey * 7 % 360 ELSE 0 END AS asp FROM part),
        r AS (SELECT *, -sin(radians(az)) * cos(radians(el)) AS re, -cos(radians(az)) * cos(radians(el)) AS rn, -sin(radians(el)) AS ru,
            sin(radians(sl)) * sin(radians(asp)) AS ne, sin(radians(sl)) * cos(radians(asp)) AS nn, cos(radians(sl)) AS nu FROM p),
        t AS (SELECT *, ne * re + nn * rn + nu * ru AS den FROM r),
        k AS (SELECT *, CASE WHEN abs(den) >= 1e-12 THEN -(nu * coalesce(h, 1)) / den END AS t FROM t),
        s AS (SELECT *, CASE WHEN el <= 0 THEN 'below_horizon' WHEN h = 0 THEN 'ok' WHEN NOT coalesce(t > 0, false) THEN 'no_intersection' WHEN h IS NULL THEN 'direction_only' ELSE 'ok' END AS status FROM k)
        SELECT id, status, CASE WHEN status = 'ok' THEN round(t * re, 4) END AS east, CASE WHEN status = 'ok' THEN round(t * rn, 4) END AS north,
            CASE WHEN status = 'ok' THEN round(sqrt(t * re * t * re + t * rn * t * rn + power(h + t * ru, 2)), 4) END AS length,
            round(CASE WHEN status IN ('ok', 'direction_only') THEN CASE WHEN degrees(atan2(t * re, t * rn)) < 0 THEN degrees(atan2(t * re, t * rn)) + 360 ELSE degrees(atan2(t * re, t * rn)) END
                  ELSE CASE WHEN az + 180 >= 360 THEN az - 180 ELSE az + 180 END END, 4) AS azimuth FROM s""",
    "scene_filter": """SELECT o_orderkey AS id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS captured FROM orders WHERE o_orderkey % 40 <= 30
        AND (o_orderkey % 6 = 0 OR o_orderkey % 100 <= 20) AND CAST(o_orderdate AS DATE) BETWEEN DATE '1995-01-01' AND DATE '1997-12-31'""",
    "any_date_in_window": f"""WITH {ORDER_DATES} SELECT id,
        CASE WHEN coalesce(started, completed, opened) IS NOT NULL THEN coalesce(started {BETWEEN}, false) OR coalesce(completed {BETWEEN}, false) OR coalesce(opened {BETWEEN}, false)
             ELSE coalesce(recorded {BETWEEN}, true) END AS works,
        CASE WHEN permit IS NOT NULL THEN permit {BETWEEN} ELSE coalesce(recorded {BETWEEN}, true) END AS permits FROM d""",
    "captured_bounds": """SELECT o_orderkey AS id,
        CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-01-01') WHEN 2 THEN strftime(o_orderdate, '%Y-01-01') END AS "first",
        CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-12-31') WHEN 2 THEN '2031-12-31' END AS "last" FROM orders""",
    "split_anomalies": """WITH t AS (SELECT event_id, user_id, event_id % 100 AS s, event_id % 100 + event_id % 13 - 1 AS e, CASE WHEN event_id % 3 = 0 THEN event_id % 100 + 20 END AS ds,
            CASE WHEN event_id % 3 = 0 THEN event_id % 100 + 20 + event_id % 5 - 1 END AS de, event_id % 4 <> 0 AS resolved,
            CASE WHEN event_id % 9 <> 0 AND event_id % 4 <> 0 THEN event_type || (event_id % 50) END AS place FROM events),
        n AS (SELECT *, CASE WHEN place IS NOT NULL AND user_id IS NOT NULL THEN count(*) OVER (PARTITION BY user_id, place) ELSE 0 END AS same FROM t)
        SELECT event_id, concat_ws(',', CASE WHEN e < s THEN 'inverted_window' END, CASE WHEN s < 0 OR e > 105 THEN 'outside_recording' END, CASE WHEN de < ds THEN 'display_inverted' END,
            CASE WHEN de >= ds AND (de < least(s, e) - 2 OR ds > greatest(s, e) + 2) THEN 'display_contradicts' END, CASE WHEN resolved AND place IS NULL THEN 'resolved_without_place' END,
            CASE WHEN same > 1 THEN 'same_place' END) AS anomalies FROM n""",
    "missed_action_filter": "SELECT event_id FROM events WHERE event_id % 2 <> 0 AND event_id % 101 >= 85",
    "readiness_counts": """WITH c AS (SELECT conv_id, CASE WHEN turn % 4 = 3 THEN 'ready' ELSE ['ready', 'ready', 'context_resolvable', 'repairable', 'invalid'][CAST(turn * 7 % 5 + 1 AS INT)] END AS l FROM conversations)
        SELECT conv_id, count(*) AS total, count(*) FILTER (l = 'ready') AS ready, count(*) FILTER (l = 'context_resolvable') AS context_resolvable, count(*) FILTER (l = 'repairable') AS repairable,
            count(*) FILTER (l = 'invalid') AS invalid, ['ready', 'context_resolvable', 'repairable', 'invalid'][max(list_position(['ready', 'context_resolvable', 'repairable', 'invalid'], l))] AS worst FROM c GROUP BY conv_id""",
    "flight_first_seen": """SELECT min(event_id) AS event_id, coalesce(user_id, 0) AS aircraft, coalesce(CAST(floor(epoch(ts)) AS BIGINT) % 50, 0) AS seen FROM events GROUP BY 2, 3""",
    "credentials_redacted": r"""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text || ' key AIza' || md5(text) || ' Bearer' || chr(9) || 'abc.def-' || md5(text) ELSE text END AS t FROM documents),
        m AS (SELECT doc_id, t, '(sk-[A-Za-z0-9_-]{16,}|AIza[A-Za-z0-9_-]{20,}|Bearer\s+[A-Za-z0-9._-]{16,})' AS p FROM d)
        SELECT doc_id, coalesce(regexp_matches(t, p), false) AS found, md5(regexp_replace(t, p, '***REDACTED***', 'g')) AS clean_md5 FROM m""",
    "public_http_gate": """SELECT page_id, CASE page_id % 5 WHEN 1 THEN false WHEN 3 THEN false
        WHEN 2 THEN page_id % 300 < 256 AND page_id % 256 NOT IN (0, 10, 127) AND page_id % 256 < 224 AND NOT (page_id % 256 = 169 AND page_id % 300 = 254)
            AND NOT (page_id % 256 = 192 AND page_id % 300 = 168) AND NOT (page_id % 256 = 172 AND page_id % 300 BETWEEN 16 AND 31) AND NOT (page_id % 256 = 100 AND page_id % 300 BETWEEN 64 AND 127)
            AND NOT (page_id % 256 = 198 AND page_id % 300 IN (18, 19))
        ELSE coalesce(regexp_matches(url, '^https?://[a-z0-9.-]+[.][a-z]+(:[0-9]+)?(/|$|[?])'), false) END AS "public" FROM pages""",
    "page_titles": r"""WITH p AS (SELECT page_id, url, trim(regexp_replace(coalesce(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), ''), '\s+', ' ', 'g')) AS title, html FROM pages)
        SELECT page_id, CASE WHEN html IS NOT NULL THEN title END AS title, CASE WHEN html IS NOT NULL THEN md5('<untrusted>' || chr(10) || title || chr(10) || '</untrusted>') END AS wrapped_md5,
            regexp_replace(regexp_replace(regexp_replace(regexp_replace(url || '&utm_source=x#top', '#.*$', ''), '([?&])(utm_[a-z]+|fbclid|gclid)=[^&]*', '\1', 'g'), '[?&]+$', ''), '([?&])&+', '\1', 'g') AS clean FROM p""",
    "token_and_filter": "SELECT p_partkey AS id FROM part WHERE contains(lower(concat_ws(' ', p_name, p_brand, p_type)), 'red') AND contains(lower(concat_ws(' ', p_name, p_brand, p_type)), 'brand#1')",
    "score_fusion": f"""WITH e AS (SELECT event_id AS i FROM events), b AS (SELECT i,
            least(1, i % 101 / 100.0{D}) * (0.5{D} / 1.2{D}) + least(1, i * 7 % 103 / 100.0{D}) * (0.3{D} / 1.2{D}) + least(1, i * 3 % 50 / 50.0{D}) * (0.4{D} / 1.2{D}) AS base,
            i % 10 = 0 AS blocking, i % 6 = 0 AS soft,
            (CASE WHEN i % 2 <> 0 THEN 0.15 ELSE 0 END + CASE WHEN i % 3 <> 0 THEN 0.15 ELSE 0 END + CASE WHEN i % 4 <> 0 THEN 0.10 ELSE 0 END + CASE WHEN i % 5 <> 0 THEN 0.20 ELSE 0 END
             + CASE WHEN i % 6 <> 0 THEN 0.10 ELSE 0 END + CASE WHEN i % 7 <> 0 THEN 0.30 ELSE 0 END){D} AS coverage, CASE WHEN i % 9 = 0 THEN 'repairable' ELSE 'context_resolvable' END AS worst FROM e),
        q AS (SELECT *, least(base, CASE WHEN blocking THEN 0.4 ELSE 1 END, CASE WHEN soft THEN 0.82 ELSE 1 END, CASE WHEN i % 13 = 0 THEN 0.75 ELSE 1 END){D} AS quality FROM b),
        d AS (SELECT *, CASE WHEN blocking THEN 'reject' WHEN soft OR round(coverage, 9) < 0.85 THEN 'needs_review' WHEN worst = 'repairable' THEN 'parameter_repair'
            WHEN quality >= 0.9 THEN 'accept' WHEN quality >= 0.78 THEN 'provisional_pass' ELSE 'needs_review' END AS decided FROM q)
        SELECT i AS event_id, round(quality, 6) AS quality, round(coverage, 6) AS coverage, worst, decided,
            CASE WHEN decided = 'reject' OR quality < 0.5 THEN 'high' WHEN quality < 0.8 THEN 'medium' ELSE 'low' END AS priority,
            CASE WHEN i % 19 = 0 THEN 'parse_failed' WHEN i % 17 = 0 THEN 'missing_score' WHEN decided = 'reject' THEN 'rejected' WHEN quality < 0.85 THEN 'score_below_minimum' END AS skipped FROM d""",
    "evidence_verdict": f"""SELECT event_id, CASE WHEN event_id % 3 = 0 OR event_id % 4 = 0 THEN 'matched' ELSE 'no_match' END AS verdict,
        CASE WHEN event_id % 3 = 0 AND event_id % 4 = 0 THEN 0.85 WHEN event_id % 3 = 0 OR event_id % 4 = 0 THEN 0.70 WHEN event_id % 3 = 1 OR event_id % 4 = 1 THEN 0.30 ELSE 0.20 END{D} AS confidence FROM events""",
    "step_references": """WITH r AS (SELECT conv_id, turn AS step, greatest(turn - 1, 0) AS target, '.a[0]' AS path FROM conversations UNION SELECT conv_id, turn, turn + 50 * (turn % 2), '' FROM conversations)
        SELECT r.conv_id, step, target, path, CASE WHEN target >= step THEN 'forward' WHEN EXISTS (SELECT 1 FROM conversations c WHERE c.conv_id = r.conv_id AND c.turn = target) THEN 'ok' ELSE 'missing' END AS status FROM r""",
    "tool_migration": """SELECT event_type || '_v1' AS tool, CASE WHEN event_type IS NULL OR event_type = 'error' THEN 'unresolved' ELSE event_type || '_v2' END AS new_tool,
        CASE WHEN event_type IS NULL OR event_type = 'error' THEN 'no mapping' END AS reason, count(*) AS calls FROM events GROUP BY ALL""",
    "unknown_tools": """WITH e AS (SELECT event_id AS i, event_id % 101 / 100.0 AS c FROM events) SELECT i AS event_id, CASE
        WHEN i % 4 = 0 AND c >= 0.85 THEN 'reasoning' WHEN i % 4 = 1 AND i % 3 = 0 THEN 'mapped' WHEN i % 4 = 1 THEN 'ambiguous_unmapped' WHEN i % 4 = 2 AND i % 5 = 0 THEN 'mapped'
        WHEN i % 4 = 2 AND i % 7 = 0 THEN 'ambiguous_unmapped' WHEN i % 4 = 2 AND i % 2 = 0 AND c >= 0.9 THEN 'candidate_new_operation' WHEN i % 4 = 2 THEN 'temporary_operation'
        WHEN i % 4 = 3 AND i % 2 = 0 AND c >= 0.9 THEN 'candidate_new_executor' ELSE 'ambiguous_unmapped' END AS decision FROM e""",
    "skill_support": """WITH p AS (SELECT user_id, 't' || (event_id % 40) AS text, CASE WHEN event_id % 3 = 0 THEN 'note' ELSE 'tool' END AS kind, event_type AS tool, CAST(event_id % 2 AS VARCHAR) AS operation
            FROM events WHERE user_id IS NOT NULL AND event_type IS NOT NULL)
        SELECT text, kind, tool, operation, count(DISTINCT user_id) AS support, CASE WHEN count(DISTINCT user_id) >= 2 THEN 'skill' ELSE 'example' END AS status
        FROM p WHERE kind <> 'tool' OR tool <> 'error' GROUP BY ALL""",
    "declared_names": "SELECT p_partkey AS id, regexp_replace(regexp_replace(lower(trim(coalesce(p_name || '-X ' || p_brand, ''))), '[- ]', '_', 'g'), '_+', '_', 'g') AS name FROM part",
}
