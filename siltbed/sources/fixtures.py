"""The driver's tables in the shapes that the operators take. Coordinates come from integer keys by fixed rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def longitude(key: Column) -> Column:
    return F.lit(100.0) + (key * 37 % 2000) / 100.0


def latitude(key: Column) -> Column:
    return F.lit(20.0) + (key * 53 % 3000) / 100.0


LON_SQL = "(100.0::DOUBLE + ({0} * 37 % 2000) / 100.0::DOUBLE)"
LAT_SQL = "(20.0::DOUBLE + ({0} * 53 % 3000) / 100.0::DOUBLE)"


PAGE_TITLE = "<title>([^<]*)</title>"
PAGE_AUTHOR = r"://(?:m\.|www\.)?([^./?#]+)"
PAGE_SOURCE = r"://[^/?#]*\.([a-z]+)(?:[/?#:]|$)"
PAGE_LANG = '<html lang="([a-z]+)"'


def items(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as corpus items: id, author (of the host), source (0 to 2, by the host's ending), title, text_hash, size, duration, lang."""
    html = F.coalesce("html", F.lit(""))
    url = F.coalesce("url", F.lit(""))
    ending = F.regexp_extract(url, PAGE_SOURCE, 1)
    return table(spark, folder, "pages").select(
        F.col("page_id").alias("id"),
        F.regexp_extract(url, PAGE_AUTHOR, 1).alias("author"),
        F.when(ending == "com", "0").when(ending == "net", "1").otherwise("2").alias("source"),
        F.regexp_extract(html, PAGE_TITLE, 1).alias("title"),
        F.md5(html).alias("text_hash"),
        F.char_length(html).cast("long").alias("size"),
        F.when(F.col("page_id") % 7 != 0, (F.char_length(html) % 600).cast("double")).alias("duration"),
        F.regexp_extract(html, PAGE_LANG, 1).alias("lang"),
    )


ITEMS_SQL = f"""pages_known AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
    items AS (SELECT page_id AS id, regexp_extract(url, '{PAGE_AUTHOR}', 1) AS author,
    CASE regexp_extract(url, '{PAGE_SOURCE}', 1) WHEN 'com' THEN '0' WHEN 'net' THEN '1' ELSE '2' END AS source,
    regexp_extract(html, '{PAGE_TITLE}', 1) AS title, md5(html) AS text_hash, length(html) AS size,
    CASE WHEN page_id % 7 <> 0 THEN CAST(length(html) % 600 AS DOUBLE) END AS duration, regexp_extract(html, '{PAGE_LANG}', 1) AS lang FROM pages_known)"""


def files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files of a corpus: id, author (the document's source), source (0 to 2), text_hash, size."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("author"),
        (F.col("doc_id") % 3).cast("string").alias("source"),
        F.md5("text").alias("text_hash"),
        F.col("n_chars").alias("size"),
    )


FILES_SQL = """files AS (SELECT doc_id AS id, source AS author, CAST(doc_id % 3 AS VARCHAR) AS source, md5(text) AS text_hash,
    n_chars AS size FROM documents)"""


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def segments(spark: SparkSession, folder: str) -> DataFrame:
    """Segments of users: user_id, event_id, start, end (seconds), kind."""
    start = micros(F.col("ts")) / 1e6
    return table(spark, folder, "events").select(
        "user_id", "event_id", start.alias("start"), (start + F.col("event_id") % 400 + 1).alias("end"), F.col("event_type").alias("kind"), "value"
    )


SEGMENTS_SQL = """segments AS (SELECT user_id, event_id, epoch_us(ts) / 1e6::DOUBLE AS start,
    epoch_us(ts) / 1e6::DOUBLE + event_id % 400 + 1 AS "end", event_type AS kind, value FROM events)"""


def customer_points(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(key.alias("id"), latitude(key).alias("lat"), longitude(key).alias("lon"))


def supplier_points(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, folder, "supplier").select(key.alias("id"), latitude(key).alias("lat"), longitude(key).alias("lon"))


POINTS_SQL = (
    f"c AS (SELECT c_custkey AS id, {LAT_SQL.format('c_custkey')} AS lat, {LON_SQL.format('c_custkey')} AS lon FROM customer), "
    f"s AS (SELECT s_suppkey AS id, {LAT_SQL.format('s_suppkey')} AS lat, {LON_SQL.format('s_suppkey')} AS lon FROM supplier)"
)


def customer_supplier_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Each customer's place (id, lat, lon) with that of one of all suppliers (lat2, lon2), by turns."""
    s = supplier_points(spark, folder).select(F.col("id").alias("other"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    least, most = s.agg(F.min("other"), F.max("other")).first()
    if least is None:
        least, most = 0, 0
    return customer_points(spark, folder).withColumn("other", F.col("id") % (most - least + 1) + least).join(s, "other")


PAIRS_SQL = f"""{POINTS_SQL}, r AS (SELECT max(id) - min(id) + 1 AS most, min(id) AS least FROM s),
p AS (SELECT c.id, c.lat, c.lon, s.lat AS lat2, s.lon AS lon2 FROM c, r, s WHERE s.id = c.id % r.most + r.least)"""
