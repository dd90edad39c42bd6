"""Exact Jaccard self-join of word-shingle sets, by set-relation skipping, as connected groups.

Equal sets are one node. Relations between sets spare work twice. *Answers are derived.* A set's hashes fall into
``BINS`` bins and the least of each bin is a key; of all nodes with one key, each meets only the
key's leaders, so that a group of any size gives pairs in proportion to it: one by id or chance, and the one of fewest
rare shingles, which most of a large group is near. Every node's most alike of these is verified, then the others that
are in another component still; those that link become members of that leader at a known distance. What follows looks
only for links *between* components: members of one component have their answer. Leaders are looked up first, and a
leader's answer bounds its members' answers by the triangle inequality of Jaccard distance: only where that leaves room
do members meet the other leader, and then each other. *Blocks are skipped.* A node's shingles are ordered by a coarse
frequency level (a sketch of fixed size that counts every shingle of every text) and hash; the head of that order is
its prefix, and two linked nodes share a prefix shingle. Lists exist only for shingles that several components share,
hold one entry for each cluster, are cut into blocks by set size, meet only the two blocks a partner can be in, and
there only entries of another component whose positions leave room for the overlap required. Before sets travel, the
pair's counts of shingles by hash range bound its overlap from above; a pair whose bound is too low is ruled out.

Sets are compared exactly on 64-bit shingle hashes; a node is a 128-bit hash of its set. Copies are never expanded into
pairs. The texts are read four times (levels, signatures, sets that meet a leader, sets that meet another component).

Defined results: null text, and text without words, has an empty set and is a component of its own; fewer words than a
shingle make one shingle; repeated rows share their component; a component without any id has a null one; an empty table
gives an empty result; other columns are not carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.llm._common import ARROW, bounded_batches, chained, dropped, mixed, runs, scanned, small, staged, trimmed, word_codes
from siltbed.llm.components import components

#: The sketch has 2**BITS counters whatever the size of the corpus.
BITS = 18
#: Bins of a set's hashes, by their low bits; the least hash of each is a key under which nodes meet their leader.
BINS = 8
#: Bytes of texts whose shingles are made at once.
CHUNK = 1 << 19
#: Shingles of a hash range on average, up to twice as many: the ranges' counts bound the overlap of two sets.
RANGE_SHINGLES = 2


def shingle_sets(texts, width: int):
    """The sorted distinct shingle hashes of each text (UTF-8 bytes or None)."""
    for run in runs(texts, CHUNK):
        codes, starts, hashes = word_codes(run)
        words = hashes[codes]
        shingles = words
        for k in range(1, width):
            shingles = chained(shingles[: len(words) - k], words[k:])
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            if b - a >= width:
                yield np.unique(shingles[a : b - width + 1])
            elif b > a:
                whole = mixed(words[a : a + 1] + np.uint64(b - a))
                for k in range(a + 1, b):
                    whole = chained(whole, words[k : k + 1])
                yield whole
            else:
                yield words[:0]


def range_counts(s: np.ndarray) -> bytes:
    """How many hashes of a set fall into each of equal ranges, a byte each; empty if a range has more than a byte holds."""
    bits = max(4, (len(s) // RANGE_SHINGLES).bit_length() - 1)
    counts = np.bincount((s >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return counts.astype(np.uint8).tobytes() if counts.max(initial=0) < 256 else b""


def most_shared(one: bytes, two: bytes, sizes: tuple[int, int]) -> int:
    """An upper bound of the number of common hashes of two sets with these range counts."""
    if not one or not two:
        return min(sizes)
    x, y = (np.frombuffer(c, np.uint8).astype(np.int32) for c in (one, two))
    ranges = min(len(x), len(y))
    x, y = (c.reshape(ranges, -1).sum(axis=1) for c in (x, y))
    return int(np.minimum(x, y).sum())


def levels_of(docs: DataFrame, text: str, width: int) -> np.ndarray:
    """For each counter of the sketch, how many doublings its count is above the spread of the others; 0 for most."""

    def count(batches):
        total = np.zeros(1 << BITS, np.int64)
        for batch in batches:
            sets = list(shingle_sets(batch.column(0).to_pylist(), width))
            cells = np.concatenate([s >> np.uint64(64 - BITS) for s in sets]).astype(np.int64)
            total += np.bincount(cells, minlength=1 << BITS)
        some = np.flatnonzero(total)
        trimmed()
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["cell", "n"])

    cells = docs.select(F.col(text).cast("binary")).mapInArrow(count, "cell long, n long")
    found = cells.groupBy("cell").agg(F.sum("n").alias("n")).toPandas()  # at most 2**BITS rows
    counts = np.zeros(1 << BITS)
    counts[found["cell"]] = found["n"]
    # Rare shingles of one counter add up to about the median; what is clear of their spread has a frequent one.
    middle = np.median(counts)
    spread = max(1.0, middle**0.5, 1.5 * np.median(np.abs(counts - middle)))
    return np.clip(np.log2(np.maximum(counts - middle, 1) / (3 * spread)) + 1, 0, 60).astype(np.uint8)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text_hash and raw: by the first two, a text is found again."""
    raw = F.col(text_col).cast("binary")
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(raw).alias("text_hash"), raw.alias("raw"))


def bin_minima(s: np.ndarray) -> tuple[np.ndarray, int]:
    """The least hash of each bin that has any, and eight bits of each bin's least packed into one signed number."""
    low = s & np.uint64(BINS - 1)
    least = [part[0] for part in (s[low == k] for k in range(BINS)) if len(part)]  # the set is sorted
    packed = sum((int(x) >> 20 & 255) << 8 * (int(x) & BINS - 1) for x in least)
    return np.array(least, np.uint64).astype(np.int64), packed - (packed >> 63 << 64)


def signatures(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """id, text_hash, n, node (hash of the set), keys, sketch (of the keys), rare, prefix and range counts, for each row.

    Where most shingles are frequent ones, rare is what the others are fewer, as a negative number; else 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(levels_of(docs, text_col, width))

    def sign(texts):
        levels = shared.value
        n, node, keys, sketch, rare, prefix, counts = [], [], [], [], [], [], []
        for s in shingle_sets(texts, width):
            n.append(len(s))
            if not len(s):
                for column in (node, keys, sketch, rare, prefix, counts):
                    column.append(None)
                continue
            node.append(xxhash.xxh3_128_digest(s.tobytes()))
            least, packed = bin_minima(s)
            keys.append(least)
            sketch.append(packed)
            level = levels[(s >> np.uint64(64 - BITS)).astype(np.int64)]
            rare.append(min(0, 2 * int((level == 0).sum()) - len(s)))
            order = np.argsort(level, kind="stable")  # the set is sorted: ties by hash
            prefix.append(s[order[: len(s) - -(-percent * len(s) // 100) + 1]].astype(np.int64))
            counts.append(range_counts(s))
        return n, node, keys, sketch, rare, prefix, counts

    added = {"n": "long", "node": "binary", "keys": "array<long>", "sketch": "long", "rare": "long", "prefix": "array<long>", "counts": "binary"}
    return staged(scanned(keyed(docs, id_col, text_col), "raw", ["id", "text_hash"], added, sign), "jaccard-signatures")


def agreeing(one, two):
    """In how many bins two sketches agree."""
    apart = one.bitwiseXOR(two)
    return sum((F.shiftrightunsigned(apart, 8 * k).bitwiseAND(F.lit(255)) == 0).cast("int") for k in range(BINS))


def number(column: str) -> Column:
    """A number of 64 bits for a node, under the column's name."""
    return F.xxhash64(column).alias(column)


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (node, label: the least node reachable, where it is another) after more links (a, b) between any nodes."""
    known = small(labels)
    for side in "ab":
        of = known.select(F.col("node").alias(side), F.col("label").alias(f"label_{side}"))
        links = links.join(of, side, "left").withColumn(f"label_{side}", F.coalesce(f"label_{side}", side))
    moved = components(links.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")))
    renamed = small(moved).select(F.col("node").alias("label"), F.col("label").alias("now"))
    kept = labels.join(renamed, "label", "left").select("node", F.coalesce("now", "label").alias("label"))
    return staged(kept.unionByName(moved), "jaccard-labels")


class SetJoin:
    """Links between nodes of one table; see the module."""

    def __init__(self, docs: DataFrame, id_col="doc_id", text_col="text", width: int = 5, percent: int = 80):
        bounded_batches(docs.sparkSession)
        self.rows = keyed(docs, id_col, text_col)
        self.width, self.percent = width, percent
        self.signed = signatures(docs, id_col, text_col, width, percent)
        # Smaller sets link with nothing but their equals.
        self.least_size = -(-percent // (100 - percent)) if percent < 100 else 1 << 40
        first = F.min(F.struct("text_hash", "id", "n", "keys", "sketch", "rare", "counts")).alias("first")
        nodes = self.signed.where(F.col("n") >= self.least_size).groupBy("node").agg(first)
        self.nodes = staged(nodes.select("node", "first.*"), "jaccard-nodes")

    def linked(self):
        return F.col("shared") * 100 >= self.percent * (F.col("n_a") + F.col("n_b") - F.col("shared"))

    def sets_of(self, wanted: DataFrame) -> DataFrame:
        """node and its set for the wanted ones (node), made again from one of each node's texts and written once."""
        wanted = staged(wanted.distinct().join(self.nodes, "node").select("node", F.col("id").alias("some_id"), F.col("text_hash").alias("some_text")), "jaccard-wanted")
        near = small(wanted)
        same = self.rows["id"].eqNullSafe(near["some_id"]) & (self.rows["text_hash"] == near["some_text"])
        found = self.rows.join(near, same).select("raw", "node")
        width = self.width

        def resolve(texts):
            return [[s.tobytes() for s in shingle_sets(texts, width)]]

        sets = staged(scanned(found, "raw", ["node"], {"members": "binary"}, resolve), "jaccard-sets")
        # A row may be repeated as a whole; then its set was made for each.
        if sets.count() != wanted.count():
            sets, repeated = staged(sets.dropDuplicates(["node"]), "jaccard-sets"), sets
            dropped(repeated)
        dropped(wanted)
        return sets

    def apart(self):
        return 1 - F.col("shared") / (F.col("n_a") + F.col("n_b") - F.col("shared"))

    def plausible(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b, within) whose range counts do not rule out a distance of ``within``."""
        for side in "ab":
            own = self.nodes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("counts").alias(f"counts_{side}"))
            pairs = pairs.join(own, side)

        def choose(batches):
            for batch in batches:
                a, b, within, *sides = (c.to_pylist() for c in batch.columns)
                kept = []
                for i, (most, n_a, n_b, one, two) in enumerate(zip(within, *sides, strict=True)):
                    shared = most_shared(one, two, (n_a, n_b))
                    if 1 - shared / (n_a + n_b - shared) <= most + 1e-9:
                        kept.append(i)
                yield batch.select([0, 1]).take(pa.array(kept, pa.int64()))

        return pairs.select("a", "b", "within", "n_a", "n_b", "counts_a", "counts_b").mapInArrow(choose, "a binary, b binary")

    def verified(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """a, b, n_a, n_b, shared for each pair of nodes (a, b). The first one's set travels to the second one's, once."""
        written = staged(pairs.select("a", "b").distinct(), "jaccard-pairs")
        pairs = small(written)
        one = sets.select(F.col("node").alias("a"), F.col("members").alias("set_a")).join(pairs, "a")
        two = sets.select(F.col("node").alias("b"), F.col("members").alias("set_b"))
        two = two.join(pairs.select("b"), "b", "left_semi")
        schema = T.StructType.fromDDL("a binary, b binary, n_a long, n_b long, shared long")

        def compare(batches):
            for batch in batches:
                out = []
                for x, y in zip(batch.column(2), batch.column(3), strict=True):
                    x, y = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                    every = np.sort(np.concatenate([x, y]))
                    out.append((len(x), len(y), int((every[1:] == every[:-1]).sum())))
                columns = [pa.array([o[i] for o in out], ARROW["long"]) for i in range(3)]
                yield pa.RecordBatch.from_arrays(batch.columns[:2] + columns, names=schema.names)
            trimmed()

        # Sorted and merged, so that a task never has the Python of both steps at once.
        joined = one.hint("merge").join(two, "b").select("a", "b", "set_a", "set_b")
        found = staged(joined.mapInArrow(compare, schema), "jaccard-verified")
        dropped(written)
        return found

    def links_of(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        found = self.verified(pairs, sets)
        links = staged(found.where(self.linked()).select("a", "b", self.apart().alias("distance")), "jaccard-links")
        dropped(found)
        return links

    def stars(self) -> tuple[DataFrame, DataFrame]:
        """Labels after the links of nodes with the leader of a key; and members: node, leader, distance."""
        keys = self.nodes.select(F.col("node").alias("a"), "id", "n", "sketch", "rare", F.explode("keys").alias("key"))
        shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("count")).where("count > 1").select("key")
        shared = staged(shared, "jaccard-keys")
        keys = keys.join(small(shared), "key", "left_semi")
        # In most bins the least id leads, as a text mostly comes before what was made from it; in the others chance decides.
        early = F.col("key").bitwiseAND(F.lit(3)) != 3
        rank = F.struct(early & F.col("id").isNull(), F.when(early, F.col("id")), F.xxhash64("a", "key"), "a", "n", "sketch")
        # And the set of fewest rare shingles leads: what a large group was made from, whatever its id.
        central = F.struct("rare", F.xxhash64("a", "key"), "a", "n", "sketch")
        leaders = keys.groupBy("key").agg(F.min(rank).alias("first"), F.min(central).alias("central"))
        chosen = [(F.when(early, 0).otherwise(1), F.lit(0).cast("long"), "first"), (F.lit(2), -F.col("central.rare"), "central")]
        chosen = [F.struct(kind.alias("kind"), worth.alias("worth"), F.col(f"{of}.a").alias("b"), F.col(f"{of}.n").alias("n_b"), F.col(f"{of}.sketch").alias("sketch_b")) for kind, worth, of in chosen]
        leaders = leaders.select("key", F.inline(F.array(*chosen)))
        led = staged(leaders, "jaccard-leaders")
        leaders = small(led)
        alike = (F.col("n") * 100 >= F.col("n_b") * self.percent) & (F.col("n_b") * 100 >= F.col("n") * self.percent)
        agree = agreeing(F.col("sketch"), F.col("sketch_b"))
        # Agreement of bins only says which pairs are worth a try here; links that it misses are found later. A central
        # leader links with most of a large group, and what misses it meets all that group's members in the lists.
        likely = (agree + F.when(F.col("kind") == 2, 4).otherwise(2)) * 100 > BINS * self.percent
        pairs = keys.join(leaders, "key").where((F.col("a") != F.col("b")) & alike & likely)
        pairs = staged(pairs.select("a", "b", agree.alias("agree"), "kind", "worth").distinct(), "jaccard-star-pairs")
        dropped(shared, led)
        sets = self.sets_of(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))))
        best = pairs.groupBy("a", "kind").agg(F.max(F.struct("worth", "agree", "b")).alias("best")).select("a", "best.b")
        best = staged(best.distinct(), "jaccard-star-best")
        links = self.links_of(best, sets)
        labels = staged(components(links), "jaccard-labels")
        untried = pairs.join(small(best), ["a", "b"], "left_anti")
        more = self.apart_still(untried, labels).groupBy("a", "label_b").agg(F.max(F.struct("agree", "b")).alias("best"))
        more = self.links_of(more.select("a", "best.b"), sets)
        if not more.isEmpty():
            labels = merged(labels, more)
        dropped(sets, pairs, best, more)
        # Members of a leader that is a member itself stand alone: then every distance is to a cluster's own leader.
        moved = staged(links.select(F.col("a").alias("moved")).distinct(), "jaccard-moved")
        members = links.join(small(moved), F.col("b") == F.col("moved"), "left_anti").groupBy(F.col("a").alias("node"))
        members = members.agg(F.min(F.struct("distance", "b")).alias("own")).select("node", F.col("own.b").alias("leader"), "own.distance")
        members = staged(members, "jaccard-members")
        dropped(links, moved)
        return labels, members

    def apart_still(self, pairs: DataFrame, labels: DataFrame) -> DataFrame:
        """The pairs (a, b) that are in different components, with their labels."""
        labels = small(labels)
        for side in "ab":
            of = labels.select(F.col("node").alias(side), F.col("label").alias(f"label_{side}"))
            pairs = pairs.join(of, side, "left").withColumn(f"label_{side}", F.coalesce(f"label_{side}", side))
        return pairs.where("label_a != label_b")

    def lists(self, labels: DataFrame, members: DataFrame) -> DataFrame:
        """Index lists (token, cluster, label, low, high, at), clusters and labels by number: sizes and first position of a cluster's sets with the token.

        Only tokens that several components have; components are told apart by a hash of 64 bits.
        """
        nodes = self.signed.where(F.col("n") >= self.least_size).select("node", "n", "prefix")
        known = small(labels)
        labelled = nodes.join(known, "node", "left").select("prefix", F.xxhash64(F.coalesce("label", "node")).alias("of"))
        tokens = labelled.select(F.explode("prefix").alias("token"), "of")
        live = tokens.groupBy("token").agg(F.min("of").alias("low"), F.max("of").alias("high")).where("low != high")
        live = staged(live.select("token"), "jaccard-tokens")
        # Rows are many here: numbers of 64 bits stand for nodes, clusters and labels, and are resolved afterwards.
        found = nodes.select(number("node"), F.col("n").cast("int").alias("n"), F.posexplode("prefix").alias("position", "token"))
        entries = found = staged(found.join(small(live), "token", "left_semi"), "jaccard-entries")
        spent = [live, entries]
        for name, table in (("label", labels), ("leader", members)):
            spent.append(staged(table.select(number("node"), number(name)), "jaccard-numbers"))
            found = found.join(small(spent[-1]), "node", "left")
        found = found.groupBy("token", F.coalesce("leader", "node").alias("cluster"), F.coalesce("label", "node").alias("label")).agg(
            F.min("n").alias("low"), F.max("n").alias("high"), F.min("position").alias("at")
        )
        found = staged(found, "jaccard-lists")
        dropped(*spent)
        return found

    def room(self, n_a, n_b, most_a, most_b, at_a, at_b):
        """Whether a first common token at these positions leaves room for the overlap required."""
        return 1 + F.least(most_a - at_a - 1, most_b - at_b - 1) >= F.ceil(
            (n_a + n_b) * F.lit(self.percent) / F.lit(100 + self.percent)
        )

    def cluster_pairs(self, lists: DataFrame) -> DataFrame:
        """Written pairs of clusters (first < second, by number) of different components that may hold a link, from blocks of index lists."""
        step = F.lit(float(np.log(100 / self.percent)))

        def band(n):
            return F.floor(F.log(F.col(n)) / step)

        def side(name: str, beyond: int, entries: DataFrame) -> DataFrame:
            bands = F.explode(F.sequence(band("low"), band("high") + beyond)).alias("band")
            return entries.select("token", bands, *[F.col(c).alias(f"{c}_{name}") for c in ("cluster", "label", "low", "high", "at")])

        # Entry a has the smaller set of a link, so what follows its position holds the overlap of two of its size at least.
        smaller = lists.where((F.col("high") - F.col("at")) * (100 + self.percent) >= 2 * F.col("low") * self.percent)
        # The larger set of a link is in the smaller one's band or in the next; sets of equal size meet in one order only.
        met = side("a", 1, smaller).join(side("b", 0, lists), ["token", "band"]).where(
            (F.col("label_a") != F.col("label_b"))
            & (F.col("low_b") * self.percent <= F.col("high_a") * 100)
            & ((F.col("low_a") < F.col("high_b")) | (F.col("low_a") == F.col("high_b")) & (F.col("cluster_a") < F.col("cluster_b")))
            & self.room(*[F.col(c) for c in ("low_a", "low_b", "high_a", "high_b", "at_a", "at_b")])
        )
        pairs = met.select(
            F.least("cluster_a", "cluster_b").alias("first"), F.greatest("cluster_a", "cluster_b").alias("second")
        )
        return staged(pairs.distinct(), "jaccard-numbered-pairs")

    def named(self, pairs: DataFrame) -> DataFrame:
        """The nodes (a, b) of pairs of numbers (first, second)."""
        for side, own in (("first", "a"), ("second", "b")):
            pairs = pairs.join(self.nodes.select(number("node").alias(side), F.col("node").alias(own)), side)
        return pairs.select("a", "b")

    def leader_answers(self, near: DataFrame, members: DataFrame, reach: DataFrame, sets: DataFrame) -> DataFrame:
        """leader_a, leader_b, node, aim, own, other, n, linked: distances of a cluster's members to the other cluster's leader.

        A member that is too far from that leader for a link with any of its members is left out.
        """
        sides = []
        for own, other in (("a", "b"), ("b", "a")):
            far = reach.select(F.col("leader").alias(other), F.col("reach"))
            within = F.coalesce("reach", F.lit(0.0)) + (1 - self.percent / 100)
            side = near.join(members.withColumnRenamed("leader", own), own).join(far, other, "left").withColumn("within", within)
            side = side.where(F.col("apart") - F.col("distance") <= F.col("within") + 1e-9)
            sides.append(side.select(F.col("a").alias("leader_a"), F.col("b").alias("leader_b"), "node", F.col(other).alias("aim"), F.col("distance").alias("own"), "within"))
        asked = staged(sides[0].unionByName(sides[1]), "jaccard-asked")
        pairs = asked.groupBy(F.col("node").alias("a"), F.col("aim").alias("b")).agg(F.max("within").alias("within"))
        answers = self.verified(self.plausible(pairs), sets)
        found = answers.select(F.col("a").alias("node"), F.col("b").alias("aim"), F.col("n_a").alias("n"), self.apart().alias("other"), self.linked().alias("linked"))
        met = asked.join(found, ["node", "aim"]).where(F.col("other") <= F.col("within") + 1e-9)
        met = staged(met.select("leader_a", "leader_b", "node", "aim", "own", "other", "n", "linked"), "jaccard-leader-answers")
        dropped(asked, answers)
        return met

    def member_pairs(self, answers: DataFrame, near: DataFrame) -> DataFrame:
        """Pairs of members of cluster pairs ``near`` (a, b) that their distances to both leaders do not rule out."""
        least = 1 - self.percent / 100 + 1e-9
        open_ = near.select(F.col("a").alias("leader_a"), F.col("b").alias("leader_b"))
        of = answers.join(open_, ["leader_a", "leader_b"], "left_semi")
        one = of.where("aim = leader_b").select("leader_a", "leader_b", F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("own").alias("a_to_a"), F.col("other").alias("a_to_b"))
        two = of.where("aim = leader_a").select("leader_a", "leader_b", F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("own").alias("b_to_b"), F.col("other").alias("b_to_a"))
        met = one.join(two, ["leader_a", "leader_b"]).where(
            (F.col("n_a") * self.percent <= F.col("n_b") * 100)
            & (F.col("n_b") * self.percent <= F.col("n_a") * 100)
            & (F.abs(F.col("a_to_a") - F.col("b_to_a")) <= least)
            & (F.abs(F.col("a_to_b") - F.col("b_to_b")) <= least)
        )
        return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def labels(self) -> DataFrame:
        """node, label (the least node reachable) for every node that links reach a smaller one from."""
        labels, members = self.stars()
        # Members of two clusters can link only if the leaders' distance is within their own distances and a link's.
        least = 1 - self.percent / 100
        reach = small(staged(members.groupBy("leader").agg(F.max("distance").alias("reach")), "jaccard-reach"))
        lists = self.lists(labels, members)
        numbered = self.cluster_pairs(lists)
        dropped(lists)
        pairs = (
            self.named(numbered)
            .join(reach.select(F.col("leader").alias("a"), F.col("reach").alias("reach_a")), "a", "left")
            .join(reach.select(F.col("leader").alias("b"), F.col("reach").alias("reach_b")), "b", "left")
            .na.fill(0.0, ["reach_a", "reach_b"])
            .select("a", "b", (least + F.col("reach_a") + F.col("reach_b")).alias("within"))
        )
        pairs = staged(pairs, "jaccard-cluster-pairs")
        dropped(numbered)
        met = staged(self.plausible(pairs), "jaccard-plausible")
        if met.isEmpty():
            return labels
        leaders = met.select(F.col("a").alias("node")).unionByName(met.select(F.col("b").alias("node"))).distinct()
        leaders = staged(leaders, "jaccard-met")
        led = members.join(small(leaders.withColumnRenamed("node", "leader")), "leader", "left_semi").select("node")
        sets = self.sets_of(leaders.unionByName(led))
        dropped(leaders)
        answers = self.verified(met, sets)
        labels = merged(labels, answers.where(self.linked()).select("a", "b"))
        near = answers.where(~self.linked()).select("a", "b", self.apart().alias("apart")).join(pairs, ["a", "b"])
        wide = near.where(F.col("apart") <= F.col("within") + 1e-9).select("a", "b", "apart")
        near = staged(self.apart_still(wide, labels).select("a", "b", "apart"), "jaccard-open")
        dropped(answers, pairs, met)
        if near.isEmpty():
            dropped(sets)
            return labels
        # First members meet the other leaders, whose answers then limit which members meet each other.
        led = self.leader_answers(near, members, reach, sets)
        labels = merged(labels, led.where("linked").select(F.col("node").alias("a"), F.col("aim").alias("b")).distinct())
        near = staged(self.apart_still(near, labels).select("a", "b"), "jaccard-open")
        if near.isEmpty():
            return labels
        last = self.apart_still(self.member_pairs(led, near), labels).select("a", "b").withColumn("within", F.lit(least))
        last = staged(last, "jaccard-last")
        plausible = staged(self.plausible(last), "jaccard-last-plausible")
        dropped(last, led)
        if not plausible.isEmpty():
            labels = merged(labels, self.verified(plausible, sets).where(self.linked()).select("a", "b"))
        dropped(sets, plausible)
        return labels

    def groups(self) -> DataFrame:
        """id, n_shingles, component_id (the least id of the component) for each row."""
        labels = self.labels()
        nodes = self.signed.where("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("some_id"))
        nodes = nodes.join(small(labels), "node", "left").withColumn("label", F.coalesce("label", "node"))
        nodes = staged(nodes, "jaccard-labelled")
        least = staged(nodes.groupBy("label").agg(F.min("some_id").alias("component_id")), "jaccard-least")
        nodes = staged(nodes.join(least, "label").select("node", "component_id"), "jaccard-components")
        return self.signed.join(nodes, "node", "left").select(
            "id",
            F.col("n").alias("n_shingles"),
            F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        )

    def spare(self) -> DataFrame:
        """id and text_hash of all rows but one of each component: the least id stays, null last, and of its texts the least hash."""
        labels = self.labels()
        first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")).alias("first")
        nodes = self.signed.where("node IS NOT NULL").groupBy("node").agg(first, F.count(F.lit(1)).alias("rows"))
        nodes = nodes.join(small(labels), "node", "left").withColumn("label", F.coalesce("label", "node"))
        nodes = staged(nodes, "jaccard-labelled")
        best = nodes.groupBy("label").agg(F.min("first").alias("best"), F.sum("rows").alias("rows")).where("rows > 1")
        best = small(staged(best.select("label", "best"), "jaccard-best"))
        nodes = small(staged(nodes.join(best, "label").select("node", "best"), "jaccard-shared"))
        own = F.col("id").eqNullSafe(F.col("best.id")) & (F.col("text_hash") == F.col("best.text_hash"))
        return self.signed.join(nodes, "node").where(~own).select("id", "text_hash").distinct()


def without_near_copies(docs: DataFrame, id_col="doc_id", text_col="text", width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; repeated rows of one id and text stay or go together."""
    join = SetJoin(docs, id_col, text_col, width, percent)
    gone = small(staged(join.spare(), "near-gone"))
    dropped(join.signed, join.nodes)
    same = docs[id_col].eqNullSafe(gone["id"]) & (F.xxhash64(docs[text_col].cast("binary")) == gone["text_hash"])
    return docs.join(gone, same, "left_anti")


def near_duplicate_groups(docs: DataFrame, id_col="doc_id", text_col="text", width: int = 5, percent: int = 80):
    """id, n_shingles, component_id for each row."""
    return SetJoin(docs, id_col, text_col, width, percent).groups().withColumnRenamed("id", id_col)
