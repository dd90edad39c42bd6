"""Sources: job lists, transcripts, trajectories, inventories, registries, map elements, terrain and recorded answers.

Anything that a remote service or a model would answer is a table of recorded rows here, read like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SEGMENT = "start double, end double, text string"
JOB = "video_path string, transcript_path string, groundtruth array<double>, source_platform string, video_id string, gt_query string, gt_needs_review boolean"
STEP = "event_type string, thought string, tool string, params string, observation string"
TRAJECTORY = f"id string, system_prompt string, user_query string, image_paths array<string>, steps array<struct<{STEP.replace(' string', ': string')}>>"
ELEMENT = "type string, id long, lat double, lon double, tags map<string,string>, geometry array<struct<lat: double, lon: double>>"


def jobs(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of jobs; anything else fails."""
    return spark.read.schema(JOB).option("multiLine", True).option("mode", "FAILFAST").json(path)


def transcripts(spark: SparkSession, path: str) -> DataFrame:
    """video_id, ord, start, end, text of transcript files, be they a list of segments or an object that holds one."""
    raw = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select("value", F.col("_metadata.file_name").alias("file"))
    listed = F.from_json("value", f"array<struct<{SEGMENT.replace(' double', ': double').replace(' string', ': string')}>>")
    held = F.from_json("value", f"struct<segments: array<struct<{SEGMENT.replace(' double', ': double').replace(' string', ': string')}>>>")
    segments = F.when(F.startswith(F.trim("value"), F.lit("[")), listed).otherwise(held["segments"])
    video = F.regexp_replace("file", r"\.json$", "").alias("video_id")
    return raw.select(video, F.posexplode(segments).alias("ord", "s")).select("video_id", "ord", "s.start", "s.end", "s.text")


def trajectories(spark: SparkSession, folder: str, name: str = "stage3_trajectory.json") -> DataFrame:
    """Every file of one name at any depth, with its folder; sorted by path where it is written, not here."""
    files = spark.read.schema(TRAJECTORY).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", name)
    where = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1)
    return files.json(folder).select("*", where.alias("task_id"), F.col("_metadata.file_path").alias("path"))


def components(roots: list[DataFrame], key: str) -> DataFrame:
    """Rows of several roots by key; a later root's row replaces an earlier one's."""
    rows = None
    for rank, df in enumerate(roots):
        df = df.withColumn("root", F.lit(rank))
        rows = df if rows is None else rows.unionByName(df, allowMissingColumns=True)
    newest = Window.partitionBy(key).orderBy(F.col("root").desc())
    return rows.withColumn("place", F.row_number().over(newest)).where("place = 1").drop("place", "root")


def inventory(lines: DataFrame, path: str, source: str, pattern: str, names: list[str]) -> DataFrame:
    """Items from a column of file paths: the groups of a pattern under their names; paths that do not fit are left out."""
    groups = [F.regexp_extract(F.col(path), pattern, i + 1).alias(n) for i, n in enumerate(names)]
    return lines.where(F.col(path).rlike(pattern)).select(F.lit(source).alias("source"), F.col(path).alias("path"), *groups)


def all_inventories(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def registry(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A registry dump, CSV with a header (quotes doubled inside quotes, where lines may end too) or JSON lines."""
    if path.endswith(".csv"):
        return spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    return spark.read.schema(schema).json(path)


def map_elements(raw: DataFrame, column: str = "value") -> DataFrame:
    """Map elements from JSON text with an ``elements`` array: result_id, kind, id, tags, lat, lon, points.

    Only declared keys are read, so whatever else an answer carries does not survive.
    """
    fields = "type: string, id: bigint, lat: double, lon: double, tags: map<string,string>, geometry: array<struct<lat: double, lon: double>>"
    parsed = F.from_json(F.col(column), f"struct<elements: array<struct<{fields}>>>")
    e = raw.select(F.explode(parsed["elements"]).alias("e"))
    middle = F.get(F.col("e.geometry"), F.floor(F.size("e.geometry") / 2).cast("int"))
    return e.select(
        F.concat_ws("/", "e.type", "e.id").alias("result_id"),
        F.col("e.type").alias("kind"),
        F.col("e.id").alias("id"),
        F.col("e.tags").alias("tags"),
        F.coalesce("e.lat", middle["lat"]).alias("lat"),
        F.coalesce("e.lon", middle["lon"]).alias("lon"),
        F.col("e.geometry").alias("points"),
    )


def terrain_cells(grids: DataFrame, key: str, values: str, nodata: str) -> DataFrame:
    """key, row, col, value of grids held as arrays of rows; cells without data are null."""
    rows = grids.select(key, nodata, F.posexplode(values).alias("row", "line"))
    cells = rows.select(key, nodata, "row", F.posexplode("line").alias("col", "value"))
    known = F.when(F.col(nodata).isNull() | (F.abs(F.col("value") - F.col(nodata)) > 1e-6), F.col("value"))
    return cells.select(key, "row", "col", known.alias("value"))


def recorded(requests: DataFrame, answers: DataFrame, on: list[str]) -> DataFrame:
    """Requests with their recorded answers; a request without one gets ok = false and an error code, not a failure."""
    found = requests.join(answers.withColumn("ok", F.lit(True)), on, "left")
    return found.withColumn("error_code", F.when(F.col("ok").isNull(), "no_recorded_answer")).withColumn("ok", F.coalesce("ok", F.lit(False)))
