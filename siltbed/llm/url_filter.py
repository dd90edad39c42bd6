"""URL filters: a Bloom filter cascade over the corpus's complete key universe, exact without joins.

A rule is (host, path prefix, action). The keys of a URL are the suffixes of its host, at label boundaries and of label
counts that rules have, each followed by the prefixes of its path of lengths that rules have; a rule fits the URL
exactly if its own key is among them. Level 1 of the cascade encodes the listed keys, level 2 the universe's other keys
that level 1 lets through, level 3 the listed keys that level 2 lets through, and so on until nothing is wrong. Level 1
is sized so that about as many keys pass wrongly as are listed; so all levels are bounded by the list, and only level 1
looks at the universe. A second cascade, over the rules' keys, tells blocking rules from allowing ones.

Lists of more than ``MAX_LISTED`` rules are not broadcast: then the same keys are joined with the rules.

Defined results: a null url, or one without ``://``, has empty host and path and no rule; without a rule the verdict is
``allow``; of several fitting rules the longest key wins, then the one with the longer host; repeated rows are judged
alike; an empty table gives an empty result; other columns are not carried.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.llm._common import ascii_lower, mixed, small, staged

MAX_LISTED = 2_000_000
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


class Bloom:
    def __init__(self, keys: np.ndarray, rate: float, salt: int):
        """keys: (n, 2) unsigned hashes. rate: share of other keys that may pass."""
        self.hashes, self.salt = max(1, round(-math.log2(rate))), np.uint64(salt)
        self.size = np.uint64(max(64, math.ceil(len(keys) * self.hashes / math.log(2))))
        self.bits = np.zeros((int(self.size) + 7) // 8, np.uint8)
        for at in self.places(keys):
            np.bitwise_or.at(self.bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))

    def places(self, keys: np.ndarray):
        first, step = mixed(keys[:, 0] ^ mixed(keys[:, 1] + self.salt)), mixed(keys[:, 1] + self.salt) | np.uint64(1)
        for i in range(self.hashes):
            yield mixed(first + np.uint64(i) * step) % self.size

    def has(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for at in self.places(keys):
            out &= (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out


class Cascade:
    """Exact membership for every key of the universe it was built over."""

    def __init__(self, levels: list[Bloom]):
        self.levels = levels

    @classmethod
    def closed(cls, first: Bloom | None, listed: np.ndarray, passed: np.ndarray) -> Cascade:
        """passed: the other keys of the universe that ``first`` lets through.

        An unlisted key with all 128 bits of a listed one could never be told from it: it counts as listed, so that the
        levels end.
        """
        pairs = [np.ascontiguousarray(x).view([("", np.uint64)] * 2).ravel() for x in (passed, listed)]
        passed = passed[~np.isin(*pairs)]
        levels, inside, outside = ([first] if first is not None else []), passed, listed
        while len(inside):
            levels.append(Bloom(inside, 0.5, 1000 + len(levels)))
            inside, outside = outside[levels[-1].has(outside)], inside
        return cls(levels)

    def has(self, keys: np.ndarray) -> np.ndarray:
        out, open_ = np.zeros(len(keys), bool), np.arange(len(keys))
        for i, level in enumerate(self.levels):
            through = level.has(keys[open_])
            out[open_[~through]] = i % 2 == 1
            open_ = open_[through]
        out[open_] = len(self.levels) % 2 == 1
        return out


def hashes(key: Column) -> Column:
    """Two numbers of 64 bits that do not depend on each other: seeding one with the other would give 64 bits in all."""
    return F.array(F.xxhash64(F.concat(F.lit("a:"), key)), F.xxhash64(F.concat(F.lit("b:"), key)))


def as_pairs(rows) -> np.ndarray:
    return np.array([list(r) for r in rows], np.int64).reshape(-1, 2).view(np.uint64)


def passing(universe: DataFrame, level: Bloom):
    shared = universe.sparkSession.sparkContext.broadcast(level)

    @F.pandas_udf("boolean")
    def passes(h: pd.Series) -> pd.Series:
        return pd.Series(shared.value.has(as_pairs(h)))

    return passes


def build(universe: DataFrame, listed: DataFrame) -> Cascade:
    """universe, listed: one string column ``key`` each. At most ``MAX_LISTED`` listed keys."""
    listed = staged(listed.dropDuplicates(["key"]).select("key", hashes(F.col("key")).alias("h")), "cascade-listed")
    n = listed.count()
    if n > MAX_LISTED:
        raise ValueError(f"{n} listed keys; at most {MAX_LISTED} fit a broadcast cascade")
    if not n:
        return Cascade([])
    keys = as_pairs(r["h"] for r in listed.select("h").toLocalIterator())
    others = universe.join(small(listed.select("key")), "key", "left_anti")
    s = others.agg(F.approx_count_distinct("key")).first()[0]
    rate = min(0.5, n / (math.sqrt(2) * max(s, 1)))
    while True:  # once, unless the universe was counted far too low
        first = Bloom(keys, rate, 1)
        wrong = staged(others.select(hashes(F.col("key")).alias("h")).where(passing(universe, first)("h")).distinct(), "cascade-wrong")
        if wrong.count() <= 8 * n + 1000:
            break
        rate /= 8
    return Cascade.closed(first, keys, as_pairs(r["h"] for r in wrong.toLocalIterator()))


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    found = [F.coalesce(F.regexp_extract(url, PARTS, i), F.lit("")) for i in (1, 2)]
    return ascii_lower(found[0]), found[1]


def keys_of(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The keys a rule of one of the shapes (labels, length of the path) could have, longest first: (size, host_size, key)."""
    labels = F.split(host, r"\.")
    suffix = {n: F.array_join(F.slice(labels, -n, n), ".") for n in {n for n, _ in shapes}}

    def key(n: int, length: int) -> Column:
        own = F.concat(suffix[n], F.substring(path, 1, length))
        fits = (F.size(labels) >= n) & (F.char_length(path) >= length)
        return F.when(fits, F.struct(F.char_length(own).alias("size"), F.char_length(suffix[n]).alias("host_size"), own.alias("key")))

    return F.sort_array(F.filter(F.array(*[key(*s) for s in shapes]), lambda k: k.isNotNull()), asc=False)


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, host, path, rule, verdict for each row. rules: columns host, path, action (``block`` or ``allow``)."""
    rules = staged(
        rules.select(F.concat("host", "path").alias("key"), F.size(F.split("host", r"\.")).alias("labels"),
                     F.char_length("path").alias("length"), "action"),
        "url-rules",
    )
    shapes = sorted(map(tuple, rules.select("labels", "length").distinct().collect())) or [(1, 0)]  # a row a shape
    host, path = url_parts(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    keyed = rows.withColumn("keys", keys_of(F.col("host"), F.col("path"), shapes))
    if rules.count() > MAX_LISTED:
        return judged_by_join(keyed, rules).withColumnRenamed("id", id_col)
    universe = keyed.select(F.explode("keys.key").alias("key")).distinct()
    universe = staged(universe, "url-keys")
    fits = build(universe, rules.select("key"))
    blocks = build(rules.select("key"), rules.where("action = 'block'").select("key"))
    shared = pages.sparkSession.sparkContext.broadcast((fits, blocks))

    @F.pandas_udf("struct<place: int, blocks: boolean>")
    def first_fitting(h: pd.Series) -> pd.DataFrame:
        fits, blocks = shared.value
        sizes = np.array([len(x) for x in h], np.int64)
        pairs = as_pairs(p for x in h for p in x)
        starts = np.cumsum(sizes) - sizes
        place = np.full(len(h), -1, np.int32)
        hit = np.flatnonzero(fits.has(pairs))[::-1]
        row = np.repeat(np.arange(len(h)), sizes)[hit]
        place[row] = hit - starts[row]  # the first hit of a row is written last
        stop = np.zeros(len(h), bool)
        some = place >= 0
        stop[some] = blocks.has(pairs[(starts + place)[some]])
        return pd.DataFrame({"place": place, "blocks": stop})

    found = keyed.withColumn("found", first_fitting(F.transform("keys.key", hashes)))
    return found.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.when(F.col("found.place") >= 0, F.get(F.col("keys.key"), F.col("found.place"))).alias("rule"),
        F.when(F.col("found.blocks"), "block").otherwise("allow").alias("verdict"),
    )


def judged_by_join(keyed: DataFrame, rules: DataFrame) -> DataFrame:
    """The same verdicts for lists beyond the bound: rows are numbered by content, keys joined, the longest hit kept."""
    distinct = staged(keyed.dropDuplicates(["host", "path"]).select("host", "path", "keys"), "url-distinct")
    hits = (
        distinct.select("host", "path", F.explode("keys").alias("k"))
        .join(rules, F.col("k.key") == rules["key"])
        .groupBy("host", "path")
        .agg(F.max(F.struct("k.size", "k.host_size", "k.key", "action")).alias("best"))
    )
    return keyed.join(hits, ["host", "path"], "left").select(
        "id",
        "host",
        "path",
        F.col("best.key").alias("rule"),
        F.coalesce("best.action", F.lit("allow")).alias("verdict"),
    )
