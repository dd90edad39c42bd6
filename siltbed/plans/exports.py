"""Readers and sinks over whole tables: exports of elements, answers read back, components, manifests, results by content."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.sources import fixtures as fx
from siltbed.sources import readers, sinks


def _elements(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as nodes with a name, a segment and, two of three, a note with signs that exports must guard."""
    key = F.col("c_custkey")
    note = F.when(key % 3 == 0, F.concat(F.lit("-"), key.cast("string"))).when(key % 3 == 1, F.concat(F.lit('<A & "'), key.cast("string"), F.lit('">')))
    tags = F.map_filter(F.create_map(F.lit("name"), "c_name", F.lit("segment"), "c_mktsegment", F.lit("note"), note), lambda k, v: v.isNotNull())
    return fx.table(spark, sf, "customer").select(
        F.concat(F.lit("node/"), key.cast("string")).alias("result_id"), key.alias("id"), "c_nationkey", fx.latitude(key).alias("lat"), fx.longitude(key).alias("lon"), tags.alias("tags")
    )


def geojson_features(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.geojson(_elements(spark, sf))


def kml_placemarks(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.kml(_elements(spark, sf))


def osm_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.osm_xml(_elements(spark, sf))


def tag_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """Elements with a column for each tag key of the table."""
    elements = _elements(spark, sf)
    return sinks.csv_rows(elements, sinks.tag_columns(elements, "id"))


def tag_lines(spark: SparkSession, sf: str) -> DataFrame:
    """A row for each tag of each element."""
    return sinks.tag_rows(_elements(spark, sf))


def elements_read(spark: SparkSession, sf: str) -> DataFrame:
    """Answers, one for each nation's segment, read back: every third element is a way, whose middle point is its place."""
    way = F.col("id") % 3 == 2
    line = F.array(*[F.struct((F.col("lat") + d).alias("lat"), F.col("lon").alias("lon")) for d in (1.0, 0.0, 2.0)])
    element = F.struct(
        F.when(way, "way").otherwise("node").alias("type"), "id", F.when(~way, F.col("lat")).alias("lat"), F.when(~way, F.col("lon")).alias("lon"),
        "tags", F.when(way, line).alias("geometry"), F.lit("token").alias("secret"),
    )
    answers = _elements(spark, sf).groupBy("c_nationkey", F.col("tags")["segment"].alias("segment")).agg(F.collect_list(element).alias("elements"))
    found = readers.map_elements(answers.select(F.to_json(F.struct("elements", F.lit(0.6).alias("version"))).alias("value")))
    return found.select("result_id", "kind", "lat", "lon", F.col("tags")["name"].alias("name"), F.coalesce(F.size("points"), F.lit(0)).alias("points"))


def terrain_read(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings as grids of four columns: their cells, without those that have no data."""
    rows = F.transform(F.sequence(F.lit(1), F.size("embedding"), F.lit(4)), lambda i: F.transform(F.slice("embedding", i, F.lit(4)), lambda x: F.floor(x.cast("double") * 10)))
    grids = fx.table(spark, sf, "embeddings").where(F.size("embedding") > 0).select("vec_id", rows.alias("values"), F.when(F.col("vec_id") % 2 == 0, F.lit(0.0)).alias("nodata"))
    cells = readers.terrain_cells(grids, "vec_id", "values", "nodata")
    return cells.groupBy("row", "col").agg(F.count(F.lit(1)).alias("cells"), F.count("value").alias("known"), F.sum("value").cast("long").alias("total"))


def component_files(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as components of three roots: a later root's row replaces an earlier one's."""
    orders, key = fx.table(spark, sf, "orders"), F.col("o_orderkey")
    roots = [orders.where(key % (i + 1) == 0).select("o_orderkey", F.concat(F.lit(f"v{i}-"), "o_orderstatus").alias("state")) for i in range(3)]
    return readers.components(roots, "o_orderkey").select("o_orderkey", "state")


def recorded_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as requests whose answers are their orders' totals; without orders there is no recorded answer."""
    asked = fx.table(spark, sf, "customer").select("c_custkey")
    answers = fx.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    return readers.recorded(asked, answers, ["c_custkey"]).select("c_custkey", "n", "ok", "error_code")


def manifest_states(spark: SparkSession, sf: str) -> DataFrame:
    """States of stages by order, newer ones on top of older ones."""
    orders, key = fx.table(spark, sf, "orders"), F.col("o_orderkey")
    old = orders.where(key % 2 == 0).select("o_orderkey", F.create_map(F.lit("read"), F.lit("done"), F.lit("split"), F.lit("open")).alias("stages"))
    new = orders.where(key % 3 == 0).select("o_orderkey", F.create_map(F.lit("split"), "o_orderstatus", F.lit("check"), F.lit("open")).alias("stages"))
    states = F.transform(F.array_sort(F.map_entries("stages")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return sinks.manifest(old, new, "o_orderkey").select("o_orderkey", F.array_join(states, ",").alias("stages"))


def result_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as results stored under what their content gives."""
    return fx.table(spark, sf, "documents").select("doc_id", sinks.result_id("page", F.coalesce("text", F.lit(""))).alias("result_id"))


def rescored_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers' balances, replaced by their largest order's total where there is one."""
    best = fx.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("c_acctbal"))
    return sinks.rescored(fx.table(spark, sf, "customer").select("c_custkey", "c_acctbal"), best, "c_custkey", "c_acctbal")


ELEMENTS_SQL = f"""e AS (SELECT 'node/' || c_custkey AS result_id, c_custkey AS id, c_name AS name, c_mktsegment AS segment,
    CASE c_custkey % 3 WHEN 0 THEN '-' || c_custkey WHEN 1 THEN '<A & "' || c_custkey || '">' END AS note,
    {fx.LAT_SQL.format("c_custkey")} AS lat, {fx.LON_SQL.format("c_custkey")} AS lon FROM customer)"""


def _xml(column: str) -> str:
    return f"""replace(replace(replace(replace({column}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;')"""


def _tag(key: str) -> str:
    return f"""coalesce('<tag k="{key}" v="' || {_xml(key)} || '"/>', '')"""


SAFE_NOTE = "CASE WHEN id % 3 = 0 THEN '''' || note ELSE note END"

ORACLE_SQL = {
    "geojson_features": f"""WITH {ELEMENTS_SQL} SELECT result_id, '{{"type":"Feature","id":"' || result_id || '","geometry":{{"type":"Point","coordinates":[' || lon || ',' || lat
        || ']}},"properties":{{"name":"' || name || '","segment":"' || segment || '"' || coalesce(',"note":"' || replace(note, '"', '\\"') || '"', '') || '}}}}' AS feature FROM e""",
    "kml_placemarks": f"""WITH {ELEMENTS_SQL} SELECT result_id, '<Placemark><name>' || {_xml("name")} || '</name><Point><coordinates>' || lon || ',' || lat
        || '</coordinates></Point></Placemark>' AS placemark FROM e""",
    "osm_nodes": f"""WITH {ELEMENTS_SQL} SELECT result_id, '<node id="' || id || '" lat="' || lat || '" lon="' || lon || '">' || {_tag("name")} || {_tag("note")} || {_tag("segment")} || '</node>' AS node FROM e""",
    "tag_sheet": f"WITH {ELEMENTS_SQL} SELECT result_id, name, segment, coalesce({SAFE_NOTE}, '') AS note FROM e",
    "tag_lines": f"""WITH {ELEMENTS_SQL} SELECT result_id, 'name' AS key, name AS value FROM e UNION ALL SELECT result_id, 'segment', segment FROM e
        UNION ALL SELECT result_id, 'note', {SAFE_NOTE} FROM e WHERE note IS NOT NULL""",
    "elements_read": f"""WITH {ELEMENTS_SQL} SELECT CASE WHEN id % 3 = 2 THEN 'way/' ELSE 'node/' END || id AS result_id, CASE WHEN id % 3 = 2 THEN 'way' ELSE 'node' END AS kind,
        lat, lon, name, CASE WHEN id % 3 = 2 THEN 3 ELSE 0 END AS points FROM e""",
    "terrain_read": """WITH v AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings),
        c AS (SELECT vec_id, i // 4 AS "row", i % 4 AS col, CAST(floor(CAST(x AS DOUBLE) * 10) AS BIGINT) AS value FROM v)
        SELECT CAST("row" AS INTEGER) AS "row", CAST(col AS INTEGER) AS col, count(*) AS cells, count(*) FILTER (value IS NOT NULL AND (vec_id % 2 = 1 OR value <> 0)) AS known, CAST(sum(value) AS BIGINT) AS total FROM c GROUP BY 1, 2""",
    "component_files": """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'v2-' WHEN o_orderkey % 2 = 0 THEN 'v1-' ELSE 'v0-' END || o_orderstatus AS state FROM orders""",
    "recorded_answers": """SELECT c_custkey, nullif(count(o_orderkey), 0) AS n, count(o_orderkey) > 0 AS ok, CASE WHEN count(o_orderkey) = 0 THEN 'no_recorded_answer' END AS error_code
        FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""",
    "manifest_states": """SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderkey % 3 = 0 THEN 'check=open' END, CASE WHEN o_orderkey % 2 = 0 THEN 'read=done' END,
        'split=' || CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus ELSE 'open' END) AS stages FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0""",
    "result_ids": "SELECT doc_id, 'page_' || substring(sha256(coalesce(text, '')), 1, 16) AS result_id FROM documents",
    "rescored_answers": """SELECT c_custkey, coalesce(any_value(best), any_value(c_acctbal)) AS c_acctbal FROM customer
        LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS best FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey GROUP BY c_custkey""",
}

QUERIES = {
    f.__name__: f
    for f in (
        geojson_features, kml_placemarks, osm_nodes, tag_sheet, tag_lines, elements_read, terrain_read, component_files, recorded_answers, manifest_states, result_ids, rescored_answers,
    )
}
