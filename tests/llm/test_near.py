"""The pipeline's near-duplicate stage on copies that three words and 0.9 do not see, and on odd ids."""

import os
import random
from itertools import combinations

import corpus_pipeline
from siltbed.llm import queries
from tests.llm.test_jaccard import SF, WORD, brute_components
from siltbed.llm import exact_dedup, jaccard_join
from siltbed.stages import stage_root, staged

NEAR = [(name, stage) for name, stage in corpus_pipeline.STAGES if name == "jaccard_join"]


def five_words(texts):
    out = {}
    for i, text in texts.items():
        words = WORD.findall(text.lower())
        out[i] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())
    return out


def near_copies():
    rng = random.Random(4)
    texts = {}
    for i in range(0, 60, 3):
        words = [f"w{rng.randrange(10**6)}" for _ in range(300)]
        texts[i] = " ".join(words)
        texts[i + 1] = " ".join(words + [f"x{rng.randrange(10**6)}" for _ in range(300 * rng.choice((15, 20, 24)) // 100)])
        for k in range(20, 300, 50):  # 2 % of the words, apart
            words[k] = f"y{rng.randrange(10**6)}"
        texts[i + 2] = " ".join(words)
    texts[100] = " ".join(f"z{k}" for k in range(300))
    return texts


def test_five_words_and_a_fifth_apart(spark):
    texts = near_copies()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for _, stage in NEAR:
        docs = stage(spark, docs, SF)
    assert sorted(r["doc_id"] for r in docs.collect()) == [*range(0, 60, 3), 100]


def test_nothing_near_stays(spark):
    docs = queries.table(spark, SF, "documents")
    for name, stage in NEAR:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = corpus_pipeline.staged(stage(spark, docs, SF), "test")
        left = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert set(left) == set(brute_components(five_words(before), 80).values())
    sets = five_words(left)
    assert not any(5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) > 0 for a, b in combinations(sets, 2))


def test_null_and_repeated_ids(spark):
    long = " ".join(f"x{i}" for i in range(3000))
    low, high = " ".join(f"u{i}" for i in range(200)), " ".join(f"v{i}" for i in range(200))
    rows = [(9, long, "a"), (8, long + " tail", "b"), (None, long, "c"), (None, "alone here now", "d"),
            (5, low, "e"), (4, low + " tail", "f"), (5, "another text of five", "g"), (None, high, "h"), (None, high + " tail", "i"),
            (None, "", "j"), (None, None, "k"), (3, "", "l")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string")
    for _, stage in NEAR:
        left = stage(spark, docs, SF)
        assert left.columns == docs.columns
        got = "".join(sorted(r["digest"] for r in left.collect()))
        assert got in ("bdfghjkl", "bdfgijkl")


def test_stages_leave_no_wide_tables(spark):
    root = stage_root(spark).removeprefix("file:")
    held = lambda: {n for n in os.listdir(f"{root}/tables") if n.startswith(("jaccard-signatures", "jaccard-nodes", "dedup-runs", "dedup-level1", "dedup-verified", "dedup-decided"))}
    docs = spark.createDataFrame([(i, f"a b c d e f g {i % 9} h i j k l m") for i in range(30)], "doc_id long, text string")
    staged(docs, "near-test")
    before = held()
    left = exact_dedup.without_copies(docs, keep="max")
    assert sorted(r["doc_id"] for r in left.collect()) == list(range(21, 30))
    assert jaccard_join.without_near_copies(docs).count() == 9
    assert held() == before
