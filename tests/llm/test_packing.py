"""Packing: tokens by the tokenizer itself, gapless sequences, and counts near the lower bound."""

import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from siltbed.llm import packing, queries

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("word_bpe_49k.json")


def checked(rows, capacity):
    """Sequences are gapless from 0 and within capacity."""
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return by


def test_word_ids_are_the_tokenizer_s():
    plain, ours = Tokenizer.from_file(PATH), packing.WordIds(PATH)
    texts = ["abc, d.e. f== …. g…. h̸ x≠ ñandú! İx, ÉTÉ?! &amp; o_o a1b (z) l’été « x»", "Hello  wOrld's\n\tit'll été x y\x1cz <|endoftext|> 12 ab12!!", "", None, "A<|ENDOFTEXT|>B", "B <|endoftext|> C", "İ ΣΑΣ   a b", " ́a"]
    for text, ids in zip(texts, ours.of([t if t is None else t.encode() for t in texts]), strict=True):
        assert ids.tolist() == plain.encode(text or "", add_special_tokens=False).ids + [0]


def test_query(spark):
    plain = Tokenizer.from_file(PATH)
    texts = {r["doc_id"]: r["text"] for r in queries.table(spark, SF, "documents").collect()}
    rows = queries.op4_grouping_genetic(spark, SF).collect()
    expected = set()
    for doc_id, text in texts.items():
        ids = np.array(plain.encode(text, add_special_tokens=False).ids + [0], "<u4")
        for k, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            expected.add((doc_id, k, start, len(part), zlib.crc32(part.tobytes())))
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows} == expected
    assert len(rows) == len(expected)
    used = len(checked(rows, 2048))
    assert used <= -(-sum(r["length"] for r in rows) // 2048) + 2


def test_ids_are_written_once(spark, monkeypatch):
    written, staged = [], packing.staged
    monkeypatch.setattr(packing, "staged", lambda df, label, **options: written.append((label, df.columns)) or staged(df, label, **options))
    plain, words = Tokenizer.from_file(PATH), ["ab", "é", "word", "x!", "1999"]
    texts = {i: " ".join(words[(i * k) % 5] for k in range(i % 40)) for i in range(200)} | {900: "long " * 5000}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    rows = packing.pack(docs, PATH, with_ids=True).collect()
    assert [label for label, columns in written if "ids" in columns] == ["pack-pieces"]
    checked(rows, 2048)
    found = {}
    for r in sorted(rows, key=lambda r: r["start"]):
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        found.setdefault(r["doc_id"], []).extend(np.frombuffer(r["ids"], "<u4").tolist())
    assert found == {k: plain.encode(t, add_special_tokens=False).ids + [0] for k, t in texts.items()}


def test_shrunk_ids_come_back():
    for ids in ([], [0], [65535, 1], [65536, 3], list(range(49408))):
        assert packing.unshrunk(packing.shrunk(np.array(ids, np.uint32))) == np.array(ids, "<u4").tobytes()


def test_crossover_keeps_every_item():
    rng = random.Random(3)
    sizes = [rng.randint(1, 100) for _ in range(300)]
    parents = []
    for _ in range(2):
        bins, order = [], rng.sample(range(300), 300)
        packing.best_fit(bins, [], order, sizes, 100)
        parents.append(bins)
    child = packing.crossed(*parents, sizes, 100, rng)
    assert sorted(x for b in child for x in b) == list(range(300))
    assert all(sum(sizes[x] for x in b) <= 100 for b in child)


def test_evolution_beats_its_start():
    rng = random.Random(5)
    sizes = [rng.randint(25, 70) for _ in range(200)]
    bins = []
    packing.best_fit(bins, [], sorted(range(200), key=lambda x: -sizes[x]), sizes, 100)
    best = packing.evolved(sizes, 100, 1, [])
    assert len(best[0][1]) <= len(bins)
    assert packing.as_bins(packing.as_genome(best[0][1], 200)) == [sorted(b) for b in best[0][1]]


def test_odd_rows(spark):
    rows = [(1, None, 5), (1, None, 5), (None, "a b", 1), (2, "", None), (3, "word " * 30_000, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int")
    packed = packing.pack(docs, PATH, with_ids=True)
    got = packed.collect()
    checked(got, 2048)
    assert sum(r["length"] for r in got) == 1 + 1 + 3 + 1 + 30_001
    assert sorted(r["length"] for r in got if r["doc_id"] == 1) == [1, 1]
    whole = packing.sequences(packed).collect()
    assert all(len(r["ids"]) == 4 * r["length"] for r in whole)
    assert packing.pack(docs.limit(0), PATH).count() == 0
