"""Exact dedup as a log-structured merge index, in DataFrame operations only.

Each scanning task is a memtable: it flushes one *run*, a file of (digest, id) rows sorted by digest, with min/max
statistics and a Bloom filter on the digest.
Compaction merges runs by digest, keeps one id of each digest (pre-aggregated before the shuffle) and writes the
next level range-partitioned and sorted, again with filters. A *hit* is a digest that occurs more than once. The hits
get a filter of fixed size, which the second pass over the texts probes before anything is joined; what passes is
verified on the bytes of their texts: rows with one digest and different bytes become different groups.

Defined results: null text counts as empty; null ids never stay while their group has an id; repeated rows (same id and
text) count in ``group_size`` and share one decision; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.llm._common import ascii_lower, dropped, small, staged

FILTER = {"parquet.bloom.filter.enabled#digest": "true", "parquet.bloom.filter.adaptive.enabled#digest": "true"}


#: Bits of the filter over hits, whatever their number; 64 of them are a row, so that it has at most 131,072 rows.
FILTER_BITS = 23


def places(digest: Column) -> list[Column]:
    """The two bits of a digest in the filter."""
    return [F.xxhash64(digest, F.lit(i)).bitwiseAND(F.lit((1 << FILTER_BITS) - 1)) for i in range(2)]


def filter_of(digests: DataFrame) -> DataFrame:
    """A Bloom filter as rows (word, bits)."""
    at = digests.select(F.explode(F.array(*places(F.col("digest")))).alias("at"))
    bit = F.expr("shiftleft(1L, CAST(at & 63 AS INT))")
    return staged(at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(bit).alias("bits")), "dedup-filter")


def probed(rows: DataFrame, words: DataFrame) -> DataFrame:
    """The rows whose ``digest`` the filter lets through: all that it was made of, and few others."""
    for i, at in enumerate(places(F.col("digest"))):
        own = F.broadcast(words.select(F.col("word").alias(f"word_{i}"), F.col("bits").alias(f"bits_{i}")))
        found = rows.withColumn(f"at_{i}", at).join(own, F.shiftright(f"at_{i}", 6) == F.col(f"word_{i}"))
        rows = found.where(f"bits_{i} & shiftleft(1L, CAST(at_{i} & 63 AS INT)) != 0").drop(f"at_{i}", f"word_{i}", f"bits_{i}")
    return rows


def sha256_of(norm: Column) -> Column:
    return F.unhex(F.sha2(norm, 256))


class DigestIndex:
    """Runs of (digest, id), their compaction, and verified groups of equal texts."""

    def __init__(self, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", digest=sha256_of):
        """keep: "min" or "max", which id of equal texts stays. digest: normalised text -> binary column."""
        self.id_col, self.text_col, self.digest = id_col, text_col, digest
        self.best = {"min": F.min, "max": F.max}[keep]
        #: Written tables that a decision reads.
        self.written: list[DataFrame] = []

    def keyed(self, docs: DataFrame) -> DataFrame:
        norm = ascii_lower(F.coalesce(F.col(self.text_col), F.lit("")))
        return docs.select(F.col(self.id_col).alias("id"), norm.alias("norm")).select(
            "id", "norm", self.digest(F.col("norm")).alias("digest")
        )

    def flush(self, docs: DataFrame) -> DataFrame:
        """Level 0: a sorted run for each task's memtable."""
        runs = self.keyed(docs).select("digest", "id").sortWithinPartitions("digest", "id")
        return staged(runs, "dedup-runs", **FILTER)

    def compact(self, *runs: DataFrame) -> DataFrame:
        """Level 1: one row for each digest of all runs, in sorted runs of disjoint ranges."""
        rows = runs[0]
        for more in runs[1:]:
            rows = rows.unionByName(more)
        merged = rows.groupBy("digest").agg(self.best("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
        return staged(merged.repartitionByRange("digest").sortWithinPartitions("digest"), "dedup-level1", **FILTER)

    def verify(self, docs: DataFrame, level: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Groups of hits by (digest, bytes), and the keyed rows of hits. Equal bytes meet before the shuffle."""
        hits = staged(level.where("n > 1").select("digest"), "dedup-hits")
        # The second pass over the texts probes the hits' filter, so that other texts are never dealt out for the join.
        rows = probed(self.keyed(docs), filter_of(hits)).join(small(hits), "digest", "left_semi")
        groups = rows.groupBy("digest", "norm").agg(
            self.best("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
        )
        return staged(groups, "dedup-verified"), rows

    def decide(self, docs: DataFrame) -> DataFrame:
        """A row for each row of ``docs``: id, digest, keep_id, group_size, kept."""
        runs = self.flush(docs)
        level = self.compact(runs)
        groups, rows = self.verify(docs, level)
        self.written += [runs, level, groups]
        collided = staged(groups.groupBy("digest").count().where("count > 1").select("digest"), "dedup-collided")
        plain = groups.select("digest", "keep_id", "group_size")
        if collided.isEmpty():
            found = runs.join(plain, "digest", "left")
        else:
            apart = (
                rows.join(collided, "digest", "left_semi")
                .join(groups, ["digest", "norm"])
                .select("digest", "id", "keep_id", "group_size")
            )
            found = (
                runs.join(collided, "digest", "left_anti")
                .join(plain.join(collided, "digest", "left_anti"), "digest", "left")
                .unionByName(apart)
            )
        return found.select(
            F.col("id").alias(self.id_col),
            "digest",
            F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        ).withColumn("kept", F.col(self.id_col).eqNullSafe(F.col("keep_id")))


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of repeated rows of one id and text, one."""
    index = DigestIndex(id_col, text_col, keep)
    decided = staged(index.decide(docs).select(F.col(id_col).alias("own_id"), "digest", "kept"), "dedup-decided")
    dropped(*index.written)
    rows = decided.groupBy("own_id", "digest").agg(F.min("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    gone = staged(rows.where(~F.col("kept")).select("own_id", "digest"), "dedup-gone")
    repeated = staged(rows.where("kept AND n > 1").select("own_id", "digest"), "dedup-repeated")
    dropped(decided)
    digest = index.digest(ascii_lower(F.coalesce(docs[text_col], F.lit(""))))

    def same(other: DataFrame):
        return docs[id_col].eqNullSafe(other["own_id"]) & (digest == other["digest"])

    left = docs.join(small(gone), same(gone), "left_anti")
    if repeated.isEmpty():
        return left
    once = docs.join(small(repeated), same(repeated), "left_semi").withColumn("dedup digest", digest)
    once = once.dropDuplicates([id_col, "dedup digest"]).drop("dedup digest")
    return left.join(small(repeated), same(repeated), "left_anti").unionByName(once)
