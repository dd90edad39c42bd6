"""Source divergence audit: how the terms of each source of a language differ from its other sources and from the language.

A batch of texts is one buffer of UTF-8 bytes. A lookup table tells term bytes (ASCII letters and all bytes from 0x80)
from others, so boundaries are where the table's answer changes or a text ends; a second table lower-cases A-Z. Slices
are grouped by xxhash, and every slice is compared with the bytes of its group's first: slices of equal hash and other
bytes become groups of their own. Counts leave a batch summed by (lang, source, term), and Spark sums them on.

Terms in at least ``least_docs`` documents of a language are kept. They are dealt out by hash into blocks of some
``block_entries`` counts; a block is a sparse matrix (sources by terms, compressed rows), in which terms that a source
does not have cost nothing by themselves, since all of them share one probability. Sums over a source's terms are
``reduceat`` over its row. All arithmetic is on integers: a probability is 1 + floor(scale * (count + 1) / (N + V)), by
long division in three digits of 1000, exact for N up to 9 * 10**15.

Defined results: null text, lang or source count as empty, and the empty lang or source is one like others; repeated rows
count each; a language without kept terms has divergence 0 between its sources; ties go to the smaller item by bytes; an
empty table gives an empty result; bytes that are no UTF-8 pass as they are; other columns are ignored. A batch holds
some 4 MB of texts or one longer text, and some ten times its bytes while it is cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltbed.llm._common import bounded_batches, staged, trimmed

SCALE = 10**9
LETTERS = range(ord("A"), ord("Z") + 1)
#: Whether a byte belongs to a term, and its lower case.
IS_TERM, LOWERED = np.zeros(256, bool), np.arange(256, dtype=np.uint8)
IS_TERM[[*LETTERS, *(c + 32 for c in LETTERS), *range(128, 256)]] = True
LOWERED[[*LETTERS]] += 32


def slices(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of each term of the texts that ``data`` holds one after another; ends: where each text ends."""
    term = IS_TERM[data]
    begins, stops = term.copy(), term.copy()
    begins[1:] &= ~term[:-1]
    stops[:-1] &= ~term[1:]
    inner = ends[(ends > 0) & (ends < len(data))]
    begins[inner] = term[inner]
    stops[inner - 1] = term[inner - 1]
    start = np.flatnonzero(begins)
    return start, np.flatnonzero(stops) + 1, np.searchsorted(ends, start, "right")


def grouped(data: np.ndarray, start: np.ndarray, end: np.ndarray, digest=xxhash.xxh64_intdigest) -> tuple[np.ndarray, np.ndarray]:
    """(group of each slice, a slice of each group). Slices share a group if and only if their bytes are equal."""
    raw, size = data.tobytes(), end - start
    hashes = np.fromiter((digest(raw[s:e]) for s, e in zip(start.tolist(), end.tolist(), strict=True)), np.uint64, len(start))
    _, first, group = np.unique(hashes, return_index=True, return_inverse=True)
    if not len(start):
        return group, first
    own = first[group]
    wrong = size != size[own]
    length = np.where(wrong, 1, size)  # slices of another length are known to be wrong
    at = np.cumsum(length) - length
    offset = np.arange(length.sum()) - np.repeat(at, length)
    wrong |= np.add.reduceat(data[np.repeat(start, length) + offset] != data[np.repeat(start[own], length) + offset], at) > 0
    more: dict[bytes, int] = {}
    extra = []
    for i in np.flatnonzero(wrong).tolist():
        word = raw[start[i] : end[i]]
        if word not in more:
            more[word] = len(first) + len(extra)
            extra.append(i)
        group[i] = more[word]
    return group, np.concatenate([first, np.array(extra, np.int64)])


def counted(batch: pa.RecordBatch, schema: pa.Schema) -> pa.RecordBatch:
    """The batch (lang, source, text bytes) summed to (lang, source, term, n, docs)."""
    texts = batch.column(2).cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = LOWERED[np.frombuffer(held, np.uint8)[ends[0] : ends[-1]]] if held is not None else np.zeros(0, np.uint8)
    numbers: dict[tuple, int] = {}
    owner = np.array([numbers.setdefault(k, len(numbers)) for k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)])
    start, end, text = slices(data, ends[1:] - ends[0])
    term, first = grouped(data, start, end)
    width = max(1, len(first))
    in_text, n = np.unique(text * width + term, return_counts=True)
    key, back = np.unique(owner[in_text // width] * width + in_text % width if len(in_text) else in_text, return_inverse=True)
    keys, raw = list(numbers), data.tobytes()
    words = [raw[start[i] : end[i]] for i in first]
    group, word = (key // width).tolist(), (key % width).tolist()
    made = [
        [keys[g][0] for g in group], [keys[g][1] for g in group], [words[w] for w in word],
        np.bincount(back, weights=n, minlength=len(key)).astype(np.int64), np.bincount(back, minlength=len(key)).astype(np.int64),
    ]
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(made, schema, strict=True)], schema=schema)


COUNTED = "lang string, source string, term binary, n long, docs long"
COUNTED_ARROW = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, term (bytes), n occurrences, docs that have it: over all rows of ``docs``."""
    bounded_batches(docs.sparkSession)
    empty = F.lit("")
    rows = docs.select(
        F.coalesce(F.col(lang_col), empty).alias("lang"), F.coalesce(F.col(source_col), empty).alias("source"),
        F.coalesce(F.col(text_col), empty).cast("binary").alias("text"),
    )

    def count(batches):
        for batch in batches:
            if batch.num_rows:
                yield counted(batch, COUNTED_ARROW)
        trimmed()

    return rows.mapInArrow(count, COUNTED).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total), exactly: three digits of 1000 by long division."""
    rest, out = count + 1, np.zeros(np.broadcast(count, total).shape, np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class Block:
    """Counts of some terms of one language: compressed rows of sources by terms."""

    def __init__(self, source: np.ndarray, term: np.ndarray, n: np.ndarray, sizes: np.ndarray, width: int, kept: int):
        """source, term, n: entries; sizes: N of each source; width: terms of the block; kept: V of the language."""
        order = np.lexsort((term, source))
        self.source, self.term, self.n, self.width = source[order], term[order], n[order], width
        self.ends = np.searchsorted(self.source, np.arange(len(sizes) + 1))
        self.p = shares(self.n, sizes[self.source] + kept)
        self.absent = shares(np.zeros(len(sizes), np.int64), sizes + kept)
        self.whole, self.kept = sizes.sum(), kept

    def by_source(self, values: np.ndarray) -> np.ndarray:
        """The sum of the entries' values for each source."""
        out, have = np.zeros(len(self.absent), np.int64), np.flatnonzero(np.diff(self.ends))
        if len(have):
            out[have] = np.add.reduceat(values, self.ends[have])
        return out

    def against(self, s: int) -> np.ndarray:
        """Divergence of source ``s`` from each source, over the terms of the block."""
        own = slice(self.ends[s], self.ends[s + 1])
        p = np.full(self.width, self.absent[s])
        p[self.term[own]] = self.p[own]
        here, missing = p[self.term], self.absent[self.source]
        apart = self.by_source(divergence(here, self.p) - divergence(here, missing))
        apart += (self.width - (own.stop - own.start)) * divergence(self.absent[s], self.absent)
        for low in range(own.start, own.stop, 1 << 14):
            part = self.p[low : min(low + (1 << 14), own.stop), None]
            apart += divergence(part, self.absent).sum(axis=0)
        return apart

    def over(self) -> tuple[np.ndarray, np.ndarray]:
        """(entry, divergence from the language) of entries above the language's share."""
        total = np.zeros(self.width, np.int64)
        np.add.at(total, self.term, self.n)
        q = shares(total, self.whole + self.kept)[self.term]
        found = np.flatnonzero(self.p > q)
        return found, divergence(self.p[found], q[found])


FOUND = "lang string, source string, part string, item string, value long"
FOUND_ARROW = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def block_rows(entries: pa.Table, groups: pa.Table, top: int):
    """Batches of FOUND rows of one block: entries (lang, source, term, n); groups (lang, source, total, kept), all sources."""
    if not entries.num_rows or not groups.num_rows:
        return
    lang, sources = groups["lang"][0].as_py(), groups["source"].to_pylist()
    at = {s: i for i, s in enumerate(sources)}
    words: dict[bytes, int] = {}
    term = np.array([words.setdefault(t, len(words)) for t in entries["term"].to_pylist()])
    source = np.array([at[s] for s in entries["source"].to_pylist()])
    block = Block(source, term, entries["n"].to_numpy(), groups["total"].to_numpy(), len(words), groups["kept"][0].as_py())

    def rows(source, part, items, values):
        arrays = [[lang] * len(items), [source] * len(items), [part] * len(items), items, values]
        made = [pa.array(x, f.type) for x, f in zip(arrays[:3], FOUND_ARROW, strict=False)]
        text = pa.array(items, pa.binary()).view(pa.string()) if part == "term" else pa.array(items, pa.string())
        return pa.Table.from_arrays([*made, text, pa.array(values, pa.int64())], schema=FOUND_ARROW)

    names = list(words)
    rank = np.zeros(len(names), np.int64)
    rank[sorted(range(len(names)), key=names.__getitem__)] = np.arange(len(names))
    entry, value = block.over()
    for s, name in enumerate(sources):
        apart = block.against(s)
        others = [i for i in range(len(sources)) if i != s]
        yield rows(name, "pair", [sources[i] for i in others], apart[others])
        low, high = np.searchsorted(entry, block.ends[s : s + 2])
        mine = block.term[entry[low:high]]
        best = np.lexsort((rank[mine], -value[low:high]))[:top]
        yield rows(name, "term", [names[i] for i in mine[best]], value[low:high][best])


def audit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least_docs: int = 3,
    top: int = 200,
    block_entries: int = 1 << 18,
) -> DataFrame:
    """lang, source, part, item, value, rank: for each source of a language its divergence from each other one
    (``pair``), and the ``top`` terms by which it stands out from the language (``term``)."""
    empty = F.lit("")
    groups = docs.select(F.coalesce(F.col(lang_col), empty).alias("lang"), F.coalesce(F.col(source_col), empty).alias("source")).distinct()
    same = Window.partitionBy("lang", "term")
    counts = term_counts(docs, text_col, lang_col, source_col)
    counts = counts.withColumn("in_docs", F.sum("docs").over(same)).withColumn("least", F.min("source").over(same))
    counts = counts.where(F.col("in_docs") >= least_docs)
    entries = staged(counts.select("lang", "source", "term", "n", (F.col("source") == F.col("least")).cast("long").alias("once")), "audit-entries")
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum("once").alias("once"))
    groups = groups.join(totals, ["lang", "source"], "left").fillna(0, ["total", "once"])
    groups = groups.withColumn("kept", F.sum("once").over(Window.partitionBy("lang"))).drop("once")
    groups = staged(groups, "audit-groups")
    blocks = entries.count() // block_entries + 1
    dealt = entries.withColumn("block", F.pmod(F.xxhash64("term"), F.lit(blocks))).drop("once")
    # Cogroups deal both sides out by hash, and an int and a long of equal value have different hashes.
    profile = groups.withColumn("block", F.explode(F.sequence(*[F.lit(i).cast("long") for i in (0, blocks - 1)])))

    def solve(key, entries: pa.Table, groups: pa.Table) -> pa.Table:
        found = list(block_rows(entries, groups, top))
        return pa.concat_tables(found) if found else FOUND_ARROW.empty_table()

    found = dealt.groupBy("lang", "block").cogroup(profile.groupBy("lang", "block")).applyInArrow(solve, FOUND)
    found = staged(found, "audit-found")
    mine, other = groups.select("lang", "source"), groups.select("lang", F.col("source").alias("item"))
    sums = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = mine.join(other, "lang").where("source != item").join(sums, ["lang", "source", "item"], "left").fillna(0, ["value"])
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    terms = found.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.unionByName(terms)
