"""Written stages: where lineage is cut in the folder that the cluster shares."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast by hint only if it was counted and has at most this many narrow rows, of some 64 bytes.
BROADCAST_ROWS = 200_000


def stage_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; one of our own only where that setting is absent, as in local tests."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        sc = spark.sparkContext
        if sc.getCheckpointDir() is None:
            if not re.match(r"local(\[|$)", sc.master):
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="stages-"))
        named = sc.getCheckpointDir()
    return named.rstrip("/")


def staged(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends here and a lost executor costs a reread."""
    spark = df.sparkSession
    path = f"{stage_root(spark)}/tables/{label}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, columns: list[str], number: str, label: str) -> tuple[DataFrame, DataFrame]:
    """The distinct values of ``columns`` with a number, and ``df`` with that number instead of them; rows with a null in
    them are left out. Numbers are written once, so that both agree."""
    kinds = staged(df.select(*columns).dropna(subset=columns).distinct().withColumn(number, F.monotonically_increasing_id()), label)
    return kinds, staged(df.join(kinds, columns).drop(*columns), f"{label}-members")


def dropped(*frames: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in frames:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A staged narrow table, marked for broadcast only if its counted rows stay within the bound."""
    return F.broadcast(df) if df.count() <= rows else df


def hashed(df: DataFrame, key: str, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A staged narrow side of an equi-join by ``key``, marked for hash tables by partition only if counts show that those
    stay as small as a broadcast side: where many rows of both sides share a key, that is some five times as fast as the
    sorted join, which can spill."""
    held = df.groupBy(key).count().agg(F.coalesce(F.max("count"), F.lit(0)), F.coalesce(F.sum("count"), F.lit(0))).first()
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.hint("shuffle_hash") if held[0] <= rows and held[1] <= rows * parts else df


#: Most bytes of an Arrow batch on its way to Python.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Batches for Python by bytes, as rows differ in length: a setting of the session, lowered if it is higher."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(name).rstrip("b")) <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))
