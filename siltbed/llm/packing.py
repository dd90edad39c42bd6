"""Best-fit packing of tokenised documents by a grouping genetic algorithm on islands.

Documents become token ids once, are cut into pieces of at most ``capacity`` and written as narrow rows. Pieces are
dealt at random into shards of bounded size. Each shard is solved by several islands: a population of packings that
starts from best-fit decreasing of perturbed orders; crossover injects whole well-filled bins of one parent into
another, removes the bins with duplicates and best-fits the displaced pieces. After each epoch the islands' elites move
to the next island of the shard. A shard stops at its lower bound. Poorly filled bins of all shards are then dissolved
and packed once more together, so that the shards' last bins do not add up.

Defined results: null or empty text is the end token alone; repeated rows and ids are pieces of their own; null ids stay
null; an empty table gives an empty result; other columns are not carried.
"""

from __future__ import annotations

import os
import random
import re
import zlib
from bisect import bisect_left, insort
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.llm._common import runs, scanned, staged

#: Pieces of a shard on average, islands of a shard, epochs between which elites move.
SHARD_PIECES, ISLANDS, EPOCHS = 1500, 2, 2
POPULATION, GENERATIONS, ELITES = 6, 10, 2
#: Bins that are filled less than this are dissolved after the first packing.
DISSOLVED = 0.97
#: Above the pieces of any shard, for numbering sequences.
MOST_BINS = 1 << 20
#: Words whose ids a task remembers.
REMEMBERED = 400_000


def gathered(flat: np.ndarray, ends: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches ``at`` of a flat array one behind the other, and where they end. ends: of the stretches, from 0."""
    begin, sizes = ends[at], ends[at + 1] - ends[at]
    to = np.cumsum(sizes)
    return flat[np.repeat(begin - to + sizes, sizes) + np.arange(int(sizes.sum()))], to


class Ragged(dict):
    """Numbered keys, each with a stretch of ids; ``new`` are those whose ids are not known yet."""

    def __init__(self):
        self.new: list = []
        self.flat, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def __missing__(self, key) -> int:
        self.new.append(key)
        number = self[key] = len(self)
        return number

    def add(self, flat: np.ndarray, to: np.ndarray) -> None:
        self.ends = np.concatenate([self.ends, self.ends[-1] + to])
        self.flat = np.concatenate([self.flat, flat])
        self.new = []


#: Letters, then ASCII punctuation without the apostrophe: two pre-tokens, whatever stands around them.
LETTERS_AND_SIGNS = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-`{-~]*)")
END_OF_WORD = "</w>"


class WordIds:
    """Ids of texts by a tokenizer whose pre-tokens never reach over ASCII white space.

    Words are looked up. Those not met before are taken apart into letters and signs where that is safe; parts of
    letters only are tokenised many at a time and told apart by the end-of-word mark of their last id. Bytes that are no
    UTF-8 count as the replacement character.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ending = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ending[[i for t, i in vocabulary.items() if t.endswith(END_OF_WORD)]] = True
        self.forget()

    def forget(self) -> None:
        self.words, self.letters, self.others = Ragged(), Ragged(), Ragged()

    def folded(self, text: bytes) -> bytes:
        """A-Z lower-cased, as the tokenizer does too; not where that could write the name of a special token."""
        return text if b"<|" in text else text.lower()

    def each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        to = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(to[-1]) if len(to) else 0), to

    def joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters."""
        flat, _ = self.each([" ".join(words[i : i + 512]) for i in range(0, len(words), 512)])
        to = np.flatnonzero(self.ending[flat]) + 1
        fits = len(to) == len(words) and (not len(to) or to[-1] == len(flat))
        return (flat, to) if fits else self.each(words)

    def learn(self) -> None:
        """Ids of the words numbered since the last call."""
        at, counts, letters, others = [], [], self.letters, self.others
        for raw in self.words.new:
            word = raw.decode(errors="replace")
            if word.isalpha() and (word.isascii() or word.lower().isalpha()):
                at.append(2 * letters[word])
                counts.append(1)
                continue
            found = LETTERS_AND_SIGNS.fullmatch(word)
            if found and found[1].isalpha() and (word.isascii() or found[1].lower().isalpha()):
                at.append(2 * letters[found[1]])
                at.append(2 * others[found[2]] + 1)
                counts.append(2)
            else:
                at.append(2 * others[word] + 1)
                counts.append(1)
        letters.add(*self.joined(letters.new))
        others.add(*self.each(others.new))
        parts = np.array(at, np.int64)
        flat = np.concatenate([letters.flat, others.flat])
        ends = np.concatenate([letters.ends, len(letters.flat) + others.ends[1:]])
        ids, to = gathered(flat, ends, parts // 2 + parts % 2 * (len(letters.ends) - 1))
        self.words.add(ids, np.concatenate([[0], to])[np.cumsum(counts, dtype=np.int64)])

    def of(self, texts: list[bytes | None], end: int = 0) -> list[np.ndarray]:
        """Each text's ids (of its UTF-8 bytes), with ``end`` behind."""
        if len(self.words) > REMEMBERED:
            self.forget()
        words = [self.folded(t).split() if t else [] for t in texts]
        counts = np.fromiter(map(len, words), np.int64, len(words))
        at = np.fromiter(map(self.words.__getitem__, chain.from_iterable(words)), np.int64, int(counts.sum()))
        self.learn()
        ids, to = gathered(self.words.flat, self.words.ends, at)
        bounds = np.concatenate([[0], to])[np.concatenate([[0], np.cumsum(counts)])]
        return [np.append(ids[a:b], np.uint32(end)) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


@lru_cache(1)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def shrunk(ids: np.ndarray) -> bytes:
    """Ids for a written table: two bytes each where they fit, compressed behind the width and the size."""
    width = 2 if ids.max(initial=0) < 1 << 16 else 4
    raw = ids.astype(f"<u{width}").tobytes()
    return bytes([width]) + len(raw).to_bytes(4, "little") + pa.compress(raw, "zstd", asbytes=True)


def unshrunk(held: bytes) -> bytes:
    """Little-endian unsigned 32-bit ids of what ``shrunk`` made."""
    raw = pa.decompress(held[5:], int.from_bytes(held[1:5], "little"), "zstd", asbytes=True)
    return np.frombuffer(raw, f"<u{held[0]}").astype("<u4").tobytes()


def pieces(docs: DataFrame, tokenizer: str, capacity: int, id_col: str, text_col: str, with_ids: bool = False):
    """id, doc_row, piece, start, length, ids_crc32, uid and the shrunk ids if wanted; doc_row tells equal rows apart, uid pieces."""

    def cut(texts):
        rows, at = [], 0
        for run in runs(texts):
            for ids in word_ids(tokenizer).of(run):
                for k, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    rows.append((at, k, start, len(part), zlib.crc32(part.astype("<u4").tobytes()), shrunk(part) if with_ids else None))
                at += 1
        return [list(c) for c in zip(*rows, strict=True)] if rows else [[]] * 6

    added = {"piece": "int", "start": "long", "length": "long", "ids_crc32": "long", "ids": "binary"}
    source = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("doc_row"), F.col(text_col).cast("binary").alias("raw"))
    cuts = scanned(source, "raw", ["id", "doc_row"], added, cut)
    return cuts.withColumn("uid", F.monotonically_increasing_id())


Packing = list[list[int]]


def best_fit(bins: Packing, free: list[int], items, sizes: list[int], capacity: int) -> None:
    """Put each item into the bin where least room is left, or into a new one. free: room of each bin."""
    order = sorted((f, i) for i, f in enumerate(free))
    for item in items:
        at = bisect_left(order, (sizes[item], -1))
        if at < len(order):
            room, i = order.pop(at)
            bins[i].append(item)
        else:
            room, i = capacity, len(bins)
            bins.append([item])
            free.append(capacity)
        free[i] = room - sizes[item]
        insort(order, (free[i], i))


def rooms(bins: Packing, sizes: list[int], capacity: int) -> list[int]:
    return [capacity - sum(sizes[x] for x in b) for b in bins]


def fitness(bins: Packing, sizes: list[int], capacity: int) -> float:
    """Mean squared fill: fewer and fuller bins are better."""
    return sum((1 - f / capacity) ** 2 for f in rooms(bins, sizes, capacity)) / max(1, len(bins))


def crossed(one: Packing, other: Packing, sizes: list[int], capacity: int, rng: random.Random) -> Packing:
    """``one`` with well-filled bins of ``other``; the items of bins that held duplicates are best-fitted."""
    ranked = sorted(zip(rooms(other, sizes, capacity), map(tuple, other), strict=True))
    good = ranked[: max(1, len(ranked) // 2)]
    chosen = [list(b) for _, b in rng.sample(good, max(1, len(good) // 2))]
    injected = set(chain.from_iterable(chosen))
    kept, displaced = [], []
    for b in one:
        if injected.isdisjoint(b):
            kept.append(list(b))
        else:
            displaced.extend(x for x in b if x not in injected)
    # One poorly filled bin more gives the displaced items something to fit with.
    if kept:
        free = rooms(kept, sizes, capacity)
        displaced.extend(kept.pop(free.index(max(free))))
    bins = chosen + kept
    best_fit(bins, rooms(bins, sizes, capacity), sorted(displaced, key=lambda x: -sizes[x]), sizes, capacity)
    return bins


def evolved(sizes: list[int], capacity: int, seed: int, elites: list[Packing]) -> list[tuple[float, Packing]]:
    """The best packings of an island after its generations, best first."""
    rng, bound = random.Random(seed), -(-sum(sizes) // capacity)
    found = [(fitness(b, sizes, capacity), b) for b in elites]
    while len(found) < POPULATION and not any(len(b) <= bound for _, b in found):
        shake = 0.0 if not found else 0.15
        order = sorted(range(len(sizes)), key=lambda x: -sizes[x] * (1 + shake * rng.uniform(-1, 1)))
        bins: Packing = []
        best_fit(bins, [], order, sizes, capacity)
        found.append((fitness(bins, sizes, capacity), bins))
    for _ in range(GENERATIONS):
        found.sort(key=lambda x: (len(x[1]), -x[0]))
        if len(found[0][1]) <= bound or len(found) < 2:
            break
        for _ in range(POPULATION // 2):
            one, other = rng.sample(found[: max(2, len(found) * 2 // 3)], 2)
            child = crossed(one[1], other[1], sizes, capacity, rng)
            found.append((fitness(child, sizes, capacity), child))
        found.sort(key=lambda x: (len(x[1]), -x[0]))
        del found[POPULATION:]
    found.sort(key=lambda x: (len(x[1]), -x[0]))
    return found[:ELITES]


def as_genome(bins: Packing, n: int) -> bytes:
    out = np.zeros(n, np.int32)
    for i, b in enumerate(bins):
        out[b] = i
    return out.tobytes()


def as_bins(genome: bytes) -> Packing:
    at = np.frombuffer(genome, np.int32)
    bins: Packing = [[] for _ in range(int(at.max(initial=-1)) + 1)]
    for x, i in enumerate(at.tolist()):
        bins[i].append(x)
    return bins


#: An order of a shard's rows that every reading agrees on.
ORDER = ["length", "uid"]
GENOMES = "shard long, island long, bins long, fitness double, genome binary"


def epoch(islands: DataFrame, elites: DataFrame, capacity: int, seed: int) -> DataFrame:
    """Evolve every (shard, island) from its elites."""

    def run(key, rows, found):
        sizes = rows.sort_values(ORDER)["length"].tolist()
        best = evolved(sizes, capacity, hash((seed, *map(int, key))), [as_bins(g) for g in found["genome"]])
        packed = [(*key, len(b), f, as_genome(b, len(sizes))) for f, b in best]
        return pd.DataFrame(packed, columns=["shard", "island", "bins", "fitness", "genome"])

    keys = ["shard", "island"]
    return islands.groupBy(*keys).cogroup(elites.groupBy(*keys)).applyInPandas(run, GENOMES)


def packed_shards(rows: DataFrame, capacity: int, seed: int) -> DataFrame:
    """rows (with uid and length) and their shard, bin in it, offset and the fill of the bin."""
    shards = max(1, -(-rows.count() // SHARD_PIECES))
    shard = F.pmod(F.xxhash64("uid", F.lit(seed)), F.lit(shards))
    dealt = rows.withColumn("shard", shard)
    narrow = dealt.select("shard", *ORDER)
    islands = narrow.withColumn("island", F.explode(F.array(*[F.lit(i).cast("long") for i in range(ISLANDS)])))
    genomes = rows.sparkSession.createDataFrame([], GENOMES)
    for e in range(EPOCHS):
        moved = genomes.withColumn("island", F.pmod(F.col("island") + 1, F.lit(ISLANDS)))
        start = genomes.unionByName(moved) if e else genomes
        genomes = staged(epoch(islands, start, capacity, seed * 100 + e), "pack-genomes")
    best = genomes.groupBy("shard").agg(
        F.max_by("genome", F.struct(-F.col("bins"), F.col("fitness"), F.col("island"))).alias("genome")
    )
    schema = T.StructType(dealt.schema.fields + T.StructType.fromDDL("bin int, offset long, fill long").fields)

    def place(key, rows, found):
        rows = rows.sort_by([(c, "ascending") for c in ORDER])
        at = np.frombuffer(found["genome"][0].as_py(), np.int32)
        by_bin = pd.DataFrame({"bin": at, "length": rows["length"].to_numpy()}).groupby("bin")["length"]
        offset, fill = by_bin.cumsum() - rows["length"].to_numpy(), by_bin.transform("sum")
        for name, values in (("bin", at), ("offset", offset), ("fill", fill)):
            rows = rows.append_column(name, pa.array(values))
        return rows

    return dealt.groupBy("shard").cogroup(best.groupBy("shard")).applyInArrow(place, schema)


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """id, piece, start, length, ids_crc32, sequence_id, offset, doc_row (and ids) for each piece.

    doc_row numbers the rows of ``docs``, so that the pieces of a repeated document can be told apart.

    tokenizer: path of a tokenizer file; its pre-tokens must not reach over white space.
    """
    rows = staged(pieces(docs, tokenizer, capacity, id_col, text_col, with_ids), "pack-pieces")
    whole = rows.where(F.col("length") >= capacity)
    first = staged(packed_shards(rows.where(F.col("length") < capacity).drop("ids"), capacity, 1), "pack-first")
    poor = F.col("fill") < capacity * DISSOLVED
    again = staged(first.where(poor).drop("shard", "bin", "offset", "fill"), "pack-poor")
    second = packed_shards(again, capacity, 2)
    columns = ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "doc_row"]

    def placed(df: DataFrame, kind: int) -> DataFrame:
        number = (F.col("shard") * MOST_BINS + F.col("bin")) * 3 + kind
        return df.withColumn("sequence_id", number.cast("long")).select(*columns, "uid")

    alone = whole.withColumn("offset", F.lit(0).cast("long")).withColumn(
        "sequence_id", F.monotonically_increasing_id() * 3 + 2
    )
    out = placed(first.where(~poor), 0).unionByName(placed(second, 1))
    if not with_ids:
        return out.select(*columns).unionByName(alone.select(*columns)).withColumnRenamed("id", id_col)
    # Ids stay in the first table while places are found, and travel once, shrunk.
    out = out.join(rows.where(F.col("length") < capacity).select("uid", "ids"), "uid")
    out = out.select(*columns, "ids").unionByName(alone.select(*columns, "ids"))
    return scanned(out, "ids", columns, {"ids": "binary"}, lambda held: [list(map(unshrunk, held))]).withColumnRenamed("id", id_col)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, length and ids (little-endian unsigned 32-bit) of each sequence of ``pack(..., with_ids=True)``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts")).select(
        "sequence_id", "length", F.expr("aggregate(parts, CAST('' AS BINARY), (a, p) -> concat(a, p.ids))").alias("ids")
    )
