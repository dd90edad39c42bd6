"""The similarity join against all pairs, on driver tables and on built clusters."""

import random
import re
from itertools import combinations

from siltbed.llm import components, jaccard_join, queries

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_sets(texts):
    out = {}
    for i, text in texts.items():
        words = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
        grams = {tuple(words[k : k + 3]) for k in range(len(words) - 2)}
        out[i] = grams or ({tuple(words)} if words else set())
    return out


def brute_components(sets, percent=90):
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)) > 0 and 100 * len(x & y) >= percent * len(x | y):
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    return {i: root(i) for i in sets}


def compare(spark, texts, percent=90):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = jaccard_join.near_duplicate_groups(docs, width=3, percent=percent).collect()
    sets = brute_sets(texts)
    assert {r["doc_id"]: r["n_shingles"] for r in rows} == {i: len(s) for i, s in sets.items()}
    assert {r["doc_id"]: r["component_id"] for r in rows} == brute_components(sets, percent)
    assert len(rows) == len(texts)


def test_query(spark):
    texts = {r["doc_id"]: r["text"] for r in queries.table(spark, SF, "documents").collect()}
    rows = queries.op3_jaccard_join(spark, SF).collect()
    sets = brute_sets(texts)
    found = brute_components(sets)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == {i: (len(sets[i]), found[i]) for i in sets}
    assert any(i != c for i, c in found.items())


def drifting(seed, base, steps, each):
    """Texts that drift away from a base: links in chains, many near the threshold."""
    rng = random.Random(seed)
    words = [f"w{rng.randrange(10**6)}" for _ in range(base)]
    out = []
    for _ in range(steps):
        words = list(words)
        for _ in range(each):
            words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_chains_near_the_threshold(spark):
    texts = []
    for seed, base, steps, each in ((1, 60, 40, 1), (2, 150, 40, 2), (3, 300, 30, 4), (4, 90, 60, 1), (5, 12, 20, 1)):
        texts += drifting(seed, base, steps, each)
    rng = random.Random(9)
    for seed in range(6):  # stars: many variants of one text, some of them around variants
        base = drifting(50 + seed, 120, 1, 0)[0].split()
        for _ in range(25):
            words = list(base)
            for _ in range(rng.randrange(1, 4)):
                words[rng.randrange(len(words))] = f"v{rng.randrange(10**6)}"
            texts.append(" ".join(words))
    rng.shuffle(texts)
    compare(spark, dict(enumerate(texts)))
    compare(spark, dict(enumerate(texts)), percent=80)


def test_a_large_group_without_its_first_text_first(spark):
    """What the copies were made from has the largest id, so no least id is near them all; their pairs stay in proportion."""
    rng = random.Random(12)
    base = drifting(60, 150, 1, 0)[0].split()
    texts = []
    for _ in range(400):
        words = list(base)
        for _ in range(rng.choice((1, 2, 3, 3, 5, 7))):
            words[rng.randrange(len(words))] = f"v{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    texts = dict(enumerate([*texts, " ".join(base)]))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    join = jaccard_join.SetJoin(docs, width=5, percent=80)
    labels, members = join.stars()
    assert join.cluster_pairs(join.lists(labels, members)).count() < 3 * len(texts)
    grams = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t in texts.items())}
    rows = jaccard_join.near_duplicate_groups(docs, width=5, percent=80).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == brute_components(grams, 80)


def test_odd_rows(spark):
    long = " ".join(f"x{i}" for i in range(30_000))
    docs = spark.createDataFrame(
        [(5, None, "a"), (4, "", "a"), (3, "One two", "a"), (2, "one TWO", None), (2, "one TWO", None), (9, long, "b"),
         (8, long + " tail", "b"), (None, long, "b"), (None, "alone here now", "c")],
        "doc_id long, text string, node string",
    )
    rows = sorted(jaccard_join.near_duplicate_groups(docs, width=3, percent=90).collect(), key=str)
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in rows)
    assert got == sorted([("5", 0, "5"), ("4", 0, "4"), ("3", 1, "2"), ("2", 1, "2"), ("2", 1, "2"), ("9", 29_998, "8"),
                          ("8", 29_999, "8"), ("None", 29_998, "8"), ("None", 1, "None")])
    assert jaccard_join.near_duplicate_groups(docs.limit(0)).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 150), (7, 7)]
    random.Random(1).shuffle(chain)
    rows = components.components(spark.createDataFrame(chain, "a long, b long")).collect()
    found = {r["node"]: r["label"] for r in rows}
    assert found == {**{i: 0 for i in range(1, 61)}, 150: 100, 200: 100}
