"""Sinks: shards and their merge, exports of map elements, content-addressed results, manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltbed.functions import text as tx


def write_shards(rows: DataFrame, shard: str, path: str) -> None:
    """JSON lines, a folder for each shard."""
    rows.write.partitionBy(shard).json(path)


def merged_shards(rows: DataFrame, shard: str, order: str) -> DataFrame:
    """One table of all shards by shard and place, cut into ranges; written in that order its files concatenate."""
    return rows.repartitionByRange(shard, order).sortWithinPartitions(shard, order)


def rescored(rows: DataFrame, scores: DataFrame, key: str, score: str) -> DataFrame:
    """Rows with their new score where there is one; everything else stays as it is."""
    new = scores.select(key, F.col(score).alias("new score"))
    return rows.join(new, key, "left").withColumn(score, F.coalesce("new score", score)).drop("new score")


def geojson(elements: DataFrame) -> DataFrame:
    """result_id and a GeoJSON feature as text for each element (lat, lon, tags)."""
    feature = F.to_json(
        F.struct(
            F.lit("Feature").alias("type"),
            F.col("result_id").alias("id"),
            F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates")).alias("geometry"),
            F.col("tags").alias("properties"),
        )
    )
    return elements.select("result_id", feature.alias("feature"))


#: Most tag keys that become columns; with more, ``tag_rows`` has them all.
TAG_COLUMNS = 1000


def tag_columns(elements: DataFrame, order: str) -> list[str]:
    """All tag keys in the order in which they are first met; an error if they are more than ``TAG_COLUMNS``."""
    keys = elements.select(F.col(order).alias("n"), F.posexplode(F.map_keys("tags")).alias("k", "key"))
    first = keys.groupBy("key").agg(F.min(F.struct("n", "k")).alias("first"))
    found = [r["key"] for r in first.orderBy("first").limit(TAG_COLUMNS + 1).collect()]
    if len(found) > TAG_COLUMNS:
        raise ValueError(f"more than {TAG_COLUMNS} tag keys do not fit into columns; export tag_rows")
    return found


def tag_rows(elements: DataFrame) -> DataFrame:
    """result_id, key, value for each tag, whatever the number of keys, safe for spreadsheets."""
    tags = elements.select("result_id", F.explode("tags").alias("key", "value"))
    return tags.select("result_id", tx.formula_safe(F.col("key")).alias("key"), F.coalesce(tx.formula_safe(F.col("value")), F.lit("")).alias("value"))


def csv_rows(elements: DataFrame, columns: list[str]) -> DataFrame:
    """result_id and the tags as columns, safe for spreadsheets."""
    return elements.select("result_id", *[F.coalesce(tx.formula_safe(F.col("tags")[c]), F.lit("")).alias(c) for c in columns])


def kml(elements: DataFrame) -> DataFrame:
    """result_id and a KML placemark for each element."""
    name = tx.xml_escape(F.coalesce(F.col("tags")["name"], F.col("result_id")))
    point = F.concat_ws(",", "lon", "lat")
    mark = F.concat(F.lit("<Placemark><name>"), name, F.lit("</name><Point><coordinates>"), point, F.lit("</coordinates></Point></Placemark>"))
    return elements.select("result_id", mark.alias("placemark"))


def osm_xml(elements: DataFrame) -> DataFrame:
    """result_id and a map-data XML node with its tags in order of their keys."""
    tags = F.array_sort(F.map_entries("tags"))
    each = F.transform(tags, lambda t: F.concat(F.lit('<tag k="'), tx.xml_escape(t["key"]), F.lit('" v="'), tx.xml_escape(t["value"]), F.lit('"/>')))
    node = F.concat(F.lit('<node id="'), F.col("id").cast("string"), F.lit('" lat="'), F.col("lat").cast("string"), F.lit('" lon="'), F.col("lon").cast("string"), F.lit('">'), F.array_join(each, ""), F.lit("</node>"))
    return elements.select("result_id", node.alias("node"))


def result_id(namespace: str, payload: Column) -> Column:
    """An id from the content: namespace and the first 16 hex digits of its SHA-256."""
    return F.concat(F.lit(f"{namespace}_"), F.substring(F.sha2(payload, 256), 1, 16))


def manifest(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """key, stages (map): the newer stage states on top of the old."""
    both = old.withColumn("age", F.lit(0)).unionByName(new.withColumn("age", F.lit(1)))
    rows = both.select(key, "age", F.explode("stages").alias("stage", "state"))
    newest = rows.withColumn("place", F.row_number().over(Window.partitionBy(key, "stage").orderBy(F.col("age").desc()))).where("place = 1")
    entries = F.array_sort(F.collect_list(F.struct("stage", "state")))
    return newest.groupBy(key).agg(F.map_from_entries(entries).alias("stages"))
