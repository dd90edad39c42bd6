"""Near copies by 64-bit hashes: an index of pieces of the hash, and the first of each neighbourhood kept in order."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.stages import dropped, staged


def piece(value: Column, low: int, high: int) -> Column:
    """Bits low to high (exclusive) of a long."""
    return F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << (high - low)) - 1))


def near_pairs(rows: DataFrame, key: str, distance: int) -> DataFrame:
    """(key, left, right): pairs of different hashes (key, hash, place) of a key at most ``distance`` bits apart, the one of
    the smaller place first; left and right are structs (place, hash).

    Of ``distance`` + 2 pieces of the hash two hashes in reach have two in common at least, so they meet by some two pieces
    and their values. A pair is kept where it meets by the first two that agree, so nothing has to be made distinct.
    """
    n = min(distance + 2, 64)
    cuts = [64 * i // n for i in range(n + 1)]
    chosen = list(combinations(range(n), 2)) if n <= distance + 2 else []

    def keys(value: Column) -> Column:
        return F.array(*[
            F.struct(F.lit(i).alias("way"), piece(value, cuts[a], cuts[a + 1]).alias("p"), piece(value, cuts[b], cuts[b + 1]).alias("q")) for i, (a, b) in enumerate(chosen)
        ])

    def agree(x: Column, y: Column, part: int) -> Column:
        return piece(x.bitwiseXOR(y), cuts[part], cuts[part + 1]) == 0

    sides = []
    for name in ("left", "right"):
        side = rows.select(F.col(key).alias("k"), F.struct("place", "hash").alias(name), F.explode(keys(F.col("hash"))).alias("m"))
        sides.append(side.select("k", name, "m.way", "m.p", "m.q"))
    x, y = F.col("left.hash"), F.col("right.hash")
    met = sides[0].join(sides[1], ["k", "way", "p", "q"]).where((F.col("left") < F.col("right")) & (F.bit_count(x.bitwiseXOR(y)) <= distance))
    first = F.coalesce(*[F.when(agree(x, y, a) & agree(x, y, b), F.lit(i)) for i, (a, b) in enumerate(chosen)])
    return met.where(F.col("way") == first).select(F.col("k").alias(key), "left", "right")


def near_dropped(rows: DataFrame, key: str, order: str, value: str, distance: int) -> DataFrame:
    """rows with ``kept``: whether no earlier kept row of the key has a hash (long) at most ``distance`` bits away.

    Rows come in the order of ``order``, ties by hash; of equal hashes the first decides, and later ones go. Rows without a
    hash stay, as nothing is known of them; a null key is a key. A row without an earlier neighbour stays for certain, and
    its neighbours go for certain; rounds of that give what the loop over all rows gives. A neighbourhood's chain makes as
    many rounds as it is long.
    """
    known = rows.where(F.col(value).isNotNull()).select(F.coalesce(F.col(key).cast("string"), F.lit("\0")).alias("k"), F.col(order).alias("place"), F.col(value).alias("hash"))
    firsts = staged(known.groupBy("k", "hash").agg(F.min("place").alias("place")), "hash-firsts")
    pairs = staged(near_pairs(firsts, "k", distance), "hash-pairs")
    gone = None
    while not pairs.isEmpty():
        heads = pairs.select("k", "left").join(pairs.select("k", F.col("right").alias("left")), ["k", "left"], "left_anti").distinct()
        lost = staged(pairs.join(heads, ["k", "left"], "left_semi").select("k", "right").distinct(), "hash-lost")
        gone = lost if gone is None else gone.unionByName(lost)
        rest = pairs.join(lost, ["k", "right"], "left_anti").join(lost.select("k", F.col("right").alias("left")), ["k", "left"], "left_anti")
        rest = staged(rest.select("k", "left", "right"), "hash-pairs")
        dropped(pairs)
        pairs = rest
    firsts = firsts.withColumn("stays", F.lit(True))
    if gone is not None:
        firsts = firsts.join(gone.select("k", F.col("right.hash").alias("hash"), F.lit(True).alias("lost")), ["k", "hash"], "left")
        firsts = firsts.withColumn("stays", F.col("lost").isNull())
    first = firsts.select(F.col("k").alias("own key"), F.col("hash").alias("own hash"), F.col("place").alias("own place"), "stays")
    met = rows.join(first, (F.coalesce(F.col(key).cast("string"), F.lit("\0")) == F.col("own key")) & (F.col(value) == F.col("own hash")), "left")
    kept = F.col(value).isNull() | (F.col("stays") & (F.col(order) == F.col("own place")))
    return met.withColumn("kept", kept).drop("own key", "own hash", "own place", "stays")
