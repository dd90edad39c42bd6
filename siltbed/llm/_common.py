"""What the operators of this subpackage share: written stages, normal forms of text and hashing of words."""

from __future__ import annotations

import contextlib
import ctypes
import itertools
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.stages import dropped, small, staged  # noqa: F401

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else. For pure ASCII text ``lower`` does just that, on a faster path."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def raw_words(raw: bytes | None) -> list[bytes]:
    """ASCII-lower-cased words of UTF-8 text; ``bytes`` methods know ASCII letters and ASCII white space only."""
    return raw.lower().split() if raw else []


def runs(texts: list[bytes | None], size: int = 1 << 20):
    """Runs of texts of about so many bytes."""
    run, total = [], 0
    for t in texts:
        if run and total + len(t or b"") > size:
            yield run
            run, total = [], 0
        run.append(t)
        total += len(t or b"")
    if run:
        yield run


def word_codes(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number of each token, first token of each text plus the end, 64-bit hash of each numbered word)."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    split = [raw_words(t) for t in texts]
    starts = np.zeros(len(split) + 1, np.int64)
    np.cumsum([len(s) for s in split], out=starts[1:])
    codes = np.fromiter(map(numbers.__getitem__, itertools.chain.from_iterable(split)), np.int64, starts[-1])
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, numbers), np.uint64, len(numbers))
    return codes, starts, hashes


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def chained(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hash of an ordered pair of hashes."""
    return mixed(first * np.uint64(0x9E3779B97F4A7C15) + second)


ARROW = {
    "int": pa.int32(),
    "long": pa.int64(),
    "double": pa.float64(),
    "float": pa.float32(),
    "string": pa.string(),
    "binary": pa.binary(),
    "boolean": pa.bool_(),
    "array<long>": pa.list_(pa.int64()),
}


#: Most bytes of an Arrow batch on its way to Python; the JVM and the worker each hold some of them.
BATCH_BYTES = 4 << 20


def trimmed() -> None:
    """Give memory that a task freed back to the system: a worker waits for its next task with what it holds."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def bounded_batches(spark: SparkSession) -> None:
    """Batches for Python by bytes, as texts differ in length: a setting of the session, lowered if it is higher."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(name).rstrip("b")) <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def scanned(df: DataFrame, column: str, keep: list[str], added: dict[str, str], fn, arrow=ARROW) -> DataFrame:
    """Columns ``keep`` of ``df``, untouched, and those that ``fn`` makes of a batch of ``column``'s values.

    fn(values) -> lists in the order of ``added`` (name -> type). It may also return, in front of them, the list of row
    numbers that its rows belong to: then it makes any number of rows from each row.
    """
    bounded_batches(df.sparkSession)
    source = df.select(*[F.col(c) for c in keep], F.col(column).alias("scanned value"))
    schema = T.StructType(source.schema.fields[:-1] + T.StructType.fromDDL(", ".join(f"{k} {v}" for k, v in added.items())).fields)
    kinds, n = [arrow[v] for v in added.values()], len(keep)

    def run(batches):
        for batch in batches:
            made = list(fn(batch.column(n).to_pylist()))
            own = batch.columns[:n]
            if len(made) > len(kinds):
                rows = pa.array(made.pop(0), pa.int64())
                own = [c.take(rows) for c in own]
            made = [pa.array(values, kind) for values, kind in zip(made, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(own + made, names=schema.names)
        trimmed()

    return source.mapInArrow(run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
