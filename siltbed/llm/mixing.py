"""Mixing sources to target weights, in DataFrame operations only.

Every document gets a hash-random key. Within its source, keys are cut into ranges of some thousand documents; the
ranges' token sums give each range its offset, and a window inside a range gives each document its exact prefix sum, so
that no task holds a source. A source's budget takes whole epochs first, then the documents below the cut; the document
at the cut gives the words that are missing.

Documents without words take nothing and stay out of the ranges, so that many of them with one key make no hot range.
``mixture`` needs no row of the plan but each source's cut: a document's key alone tells how often it is taken.

Defined results: null text has size 0; a null source is a source of its own, ordered last; documents without an id are
keyed by their text; repeated rows are documents of their own; an empty table gives an empty result; other columns stay
out of the decision.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltbed.llm._common import WORD, small, staged

#: Documents of a key range on average.
RANGE_ROWS = 4096


def source_targets(sizes: DataFrame, weights=(5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Targets of each source (columns source, size): ``share`` of all sizes by weight, none above ``most`` of its own.

    Filling in the order of cap / weight, a source is capped if the level of what is left reaches its cap; the others
    share the rest by weight, which is what repeated resharing converges to. One row a source, so one task will do.
    """
    stats = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("idx") % len(weights) + 1)
    filling = everything.orderBy("ratio", "idx")
    return (
        stats.withColumn("idx", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("pot", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("before", F.sum("cap").over(filling.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("left_weight", F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn(
            "capped",
            F.col("ratio") <= (F.col("pot") - F.coalesce("before", F.lit(0.0))) / F.col("left_weight"),
        )
        .withColumn("fixed", F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0.0)).over(everything))
        .withColumn("free", F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("weight"))).over(everything))
        .withColumn(
            "target",
            F.when(F.col("capped"), F.col("cap")).otherwise(
                F.col("weight") * ((F.col("pot") - F.col("fixed")) / F.col("free"))
            ),
        )
        .select("source", "idx", "source_size", "n", "target")
    )


def mix(
    docs: DataFrame,
    weights=(5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """A row for each document: id, source, key, text_hash, size, source_size, target, epochs, extra, taken.

    ``epochs`` whole copies are taken, then ``extra`` leading words; ``taken`` is the sum in words.
    """
    text = F.col(text_col)
    key, text_hash = place_of(seed, id_col, text_col)
    rows = staged(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            key.alias("key"),
            text_hash.alias("text_hash"),
        ),
        "mix-rows",
    )
    targets = staged(source_targets(rows, weights, share, most), "mix-targets")
    ranges = F.greatest(F.lit(1), F.ceil(F.col("n") / F.lit(RANGE_ROWS))).cast("long")
    place = F.shiftright(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * ranges, 32)
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    budgeted = rows.join(targets, rows["source"].eqNullSafe(targets["source"])).select(
        "id", rows["source"], "key", "text_hash", "size", "idx", "source_size", "target", epochs.alias("epochs"),
        (budget - epochs * F.col("source_size")).alias("rest"), place.alias("range"),
    )
    placed = budgeted.where("size > 0")
    within = Window.partitionBy("idx").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = staged(
        placed.groupBy("idx", "range")
        .agg(F.sum("size").alias("words"))
        .select("idx", "range", F.coalesce(F.sum("words").over(within), F.lit(0)).alias("offset")),
        "mix-offsets",
    )
    inside = Window.partitionBy("idx", "range").orderBy("key", "id", "size", "text_hash")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    cut = placed.join(offsets, ["idx", "range"]).withColumn("before", before)
    cut = cut.withColumn("extra", F.greatest(F.lit(0), F.least("size", F.col("rest") - F.col("before"))).cast("long"))
    return (
        cut.unionByName(budgeted.where("size = 0").withColumn("extra", F.lit(0).cast("long")), allowMissingColumns=True)
        .select(
            F.col("id").alias(id_col),
            F.col("source").alias(source_col),
            "key",
            "text_hash",
            "size",
            "source_size",
            "target",
            "epochs",
            "extra",
            (F.col("epochs") * F.col("size") + F.col("extra")).alias("taken"),
        )
    )


def place_of(seed: str, id_col: str, text_col: str) -> tuple[Column, Column]:
    """The key of a document and a hash of its text."""
    own = F.coalesce(F.col(id_col).cast("string"), F.md5(F.col(text_col)), F.lit(""))
    return F.md5(F.concat_ws(":", F.lit(seed), own)), F.xxhash64(text_col)


def mixture(
    docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", seed: str = "mix", **settings
) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, whole: the document at a cut if at least half of it is taken.

    Where several rows at a cut agree in id, source and text, what the cut takes of them are copies of one of the rows.
    A source without words is left out.
    """
    taken = staged(mix(docs, seed=seed, id_col=id_col, text_col=text_col, source_col=source_col, **settings), "mix-taken")
    taken = taken.select(F.col(source_col).alias("of"), F.struct("key", F.col(id_col).alias("id"), "text_hash").alias("at"), "size", "epochs", "extra")
    same = taken.where("extra > 0").groupBy("of", "at").agg(F.sum("extra").alias("extra"), F.first("size").alias("size"))
    cut = same.groupBy("of").agg(F.max(F.struct("at", (F.floor(F.col("extra") / F.col("size") + 0.5)).cast("int").alias("whole"))).alias("cut"))
    plan = staged(taken.where("size > 0").groupBy("of").agg(F.max("epochs").cast("int").alias("epochs")), "mix-epochs")
    plan = staged(plan.join(cut.withColumnRenamed("of", "cut_of"), F.col("of").eqNullSafe(F.col("cut_of")), "left").select(F.struct("of", "epochs", "cut").alias("mix plan")), "mix-plan")
    key, text_hash = place_of(seed, id_col, text_col)
    rows = docs.withColumn("mix place", F.struct(key.alias("key"), F.col(id_col).alias("id"), text_hash.alias("text_hash")))
    rows = rows.join(small(plan), docs[source_col].eqNullSafe(F.col("mix plan.of")))
    cut_at, whole = F.col("mix plan.cut.at"), F.coalesce(F.col("mix plan.cut.whole"), F.lit(0))
    below = F.coalesce(F.col("mix place") < cut_at, F.lit(False)).cast("int")
    often = F.explode(F.array_repeat(F.lit(0), F.col("mix plan.epochs") + below))
    sized = F.regexp_count(F.col(text_col), F.lit(WORD)) > 0  # others are taken 0 times, whatever their key
    plain = rows.where(sized).withColumn("mix copy", often).select(*[docs[c] for c in docs.columns])
    at_cut = rows.where(sized & (whole > 0) & (F.col("mix place") == cut_at)).dropDuplicates(["mix place", "mix plan"])
    at_cut = at_cut.withColumn("mix copy", F.explode(F.array_repeat(F.lit(0), whole)))
    return plain.unionByName(at_cut.select(*[docs[c] for c in docs.columns]))
