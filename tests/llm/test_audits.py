"""Source divergence, distribution divergence and hard negatives against brute force."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltbed.llm import audit, divergence, negatives

TERM = re.compile(rb"[A-Za-z\x80-\xff]+")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("aB1 é{[`@Zz\n", max_size=12), min_size=1, max_size=6))
def test_slices_are_the_pattern(texts):
    raw = [t.encode() for t in texts]
    data = audit.LOWERED[np.frombuffer(b"".join(raw), np.uint8)]
    start, end, text = audit.slices(data, np.cumsum([len(r) for r in raw]))
    got = [(int(t), data[s:e].tobytes()) for s, e, t in zip(start, end, text)]
    assert got == [(i, m[0].lower()) for i, r in enumerate(raw) for m in TERM.finditer(r)]
    for digest in (audit.xxhash.xxh64_intdigest, len, lambda b: 0):
        group, first = audit.grouped(data, start, end, digest)
        words = [w for _, w in got]
        assert [words[int(first[g])] for g in group] == words and len(first) == len(set(words))


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**15), st.integers(1, 8 * 10**15))
def test_shares_are_exact(count, more):
    total = count + more
    assert audit.shares(np.array([count]), np.array([total]))[0] == 1 + 10**9 * (count + 1) // total


def brute_audit(rows, least=3, top=200):
    rows = [tuple("" if x is None else x for x in r) for r in rows]
    out = set()
    for lang in {r[1] for r in rows}:
        own = [(r[2], Counter(m[0].lower().decode() for m in TERM.finditer(r[0].encode()))) for r in rows if r[1] == lang]
        kept = {t for t in {t for _, c in own for t in c} if sum(t in c for _, c in own) >= least}
        counts = {s: Counter() for s, _ in own}
        for s, c in own:
            counts[s].update({t: n for t, n in c.items() if t in kept})
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in counts.items()}, share(sum(counts.values(), Counter()))
        for s in counts:
            parts = {
                "pair": [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in counts if o != s],
                "term": [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[s][t] and p[s][t] > q[t]],
            }
            for part, found in parts.items():
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, v, i + 1) for i, (v, item) in enumerate(ranked) if part == "pair" or i < top}
    return out


@pytest.mark.parametrize("block", [2, 1 << 18])
def test_audit_is_brute_force(spark, block):
    rng = np.random.default_rng(3)
    words = ["the", "The", "é", "ab", "x1y", "zz", "über", "q", "tie", "ti", "w"]
    rows = [(" ".join(rng.choice(words, rng.integers(0, 9))), ["en", "de", None][rng.integers(3)], ["a", "b", None, "c"][rng.integers(4)]) for _ in range(80)]
    rows += [(None, "en", "empty"), ("", "xx", "one"), ("lonely", "xx", "two"), (None, None, None), ("word " * 30_000, "en", "a")] + [("same row", "fr", "s")] * 3
    docs = spark.createDataFrame([(*r, 1, "t") for r in rows], "text string, lang string, source string, n long, term string")
    got = [tuple(r) for r in audit.audit(docs.repartition(5), top=4, block_entries=block).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_audit(rows, top=4)
    assert audit.audit(docs.limit(0)).count() == 0


def test_audit_is_brute_force_where_partitions_stay_apart(spark):
    rows = [(f"w{chr(97 + i % 7)} {chr(97 + i % 11)} the", ["en", "de", "fr"][i % 3], ["a", "b", "c", None][i % 4]) for i in range(120)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "13"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        for block in (4, 1 << 18):
            got = [tuple(r) for r in audit.audit(docs, top=4, block_entries=block).collect()]
            assert len(got) == len(set(got)) and set(got) == brute_audit(rows, top=4)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def brute_rules(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {g for g, n in Counter(grams).items() if n > 1}
    again = {i + k for i, g in enumerate(grams) if g in twice for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 50 or 100 * len(again) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(again), failed


ODD = [None, "", " \t\n", "a", "a b c", "a b c a b c", "x " * 60, "a b\na b\n\n \n \n", "é # * $ % & | < >\x0b\x0cz", "a\x01 b", "same line\nsame line\n", "Word9 " * 3]


def test_rules_are_brute_force(spark):
    rng = np.random.default_rng(4)
    texts = ODD + [" ".join(rng.choice(list("abcd"), rng.integers(1, 90))) for _ in range(60)] + ["long " * 20_000 + "end"]
    docs = spark.createDataFrame([(i, t, ["en", None][i % 2], "w") for i, t in enumerate(texts)], "doc_id long, text string, lang string, words string")
    rows = divergence.judge(docs, divergence.profiles(docs, least_words=10)).orderBy("doc_id").collect()
    got = [(r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in rows]
    assert got == [brute_rules(t) for t in texts]
    assert not any(r["kept"] for r in rows if r["base_failed"])
    assert all(r["class_distance"] is None and r["word_distance"] is None for i, r in enumerate(rows) if i % 2)
    assert divergence.judge(docs.limit(0), divergence.profiles(docs.limit(0))).count() == 0


def test_distance_is_the_formula(spark):
    p, q = [3.0, 0.0, 1.0], [1.0, 2.0, 1.0]
    a, b = np.array(p) / 4, np.array(q) / 4
    m = (a + b) / 2
    want = math.sqrt(sum(x * math.log2(x / z) / 2 for x, z in zip([*a, *b], [*m, *m]) if x))
    row = spark.createDataFrame([(p, q)], "p array<double>, q array<double>").select(divergence.jensen_shannon("p", "q"), divergence.jensen_shannon("p", "p"))
    assert row.first()[0] == pytest.approx(want) and row.first()[1] == 0


def test_junk_goes_and_clean_texts_stay(spark):
    rng = np.random.default_rng(6)
    vocabulary = ["".join(rng.choice(list("abcdefghilmnoprstu"), rng.integers(2, 8))) for _ in range(400)]
    weights = 1 / np.arange(1, 401)
    clean = [" ".join(rng.choice(vocabulary, 300, p=weights / weights.sum())) for _ in range(60)]
    junk = [clean[0].upper().replace(" ", "!! "), clean[1].replace(" ", "### "), " ".join("".join(rng.choice(list("xyz0123456789#%"), 6)) for _ in range(300))]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(clean + junk)], "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in divergence.judge(docs, divergence.profiles(docs)).where("kept").collect()}
    assert kept == set(range(60))


def brute_negatives(rows, step=50, positives=5, negatives_=3):
    good = [(i, int(label), [int(x) for x in v]) for i, label, v in rows if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, label, v) in enumerate(good):
        if i % step:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, other) for m, (j, other, w) in enumerate(good) if m != n]
        scored.sort()
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            below = [(t, j) for t, j, other in scored if other != label and 50 * -s <= 100 * -t <= 95 * -s][:negatives_]
            out += [(i, p, r + 1, j, -s, -t) for r, (t, j) in enumerate(below)]
    return sorted(out)


@pytest.mark.parametrize(("spread", "length", "turn"), [(3, 4, 1 << 15), (200, 9, 3), (0, 1, 1 << 15), (5000, 16, 1 << 15)])
def test_negatives_are_brute_force(spark, spread, length, turn):
    rng = np.random.default_rng(spread)
    rows = [(int(i), int(rng.integers(3)), [float(x) for x in rng.integers(-spread - 1, spread + 2, length)]) for i in range(400)]
    rows += [rows[0], rows[0], rows[50], rows[7], (800, 1, None), (850, None, [1.0] * length), (900, 1, [float("nan")] * length), (None, 1, [9.0] * length), (950, 1, [float("-inf")] * length),
             (1000, 0, []), (1001, 1, rows[3][2][:1]), (1050, 2, [None] * length), (-50, 1, rows[4][2])]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, label int, embedding array<double>, id string").repartition(3)
    got = sorted(tuple(r) for r in negatives.mine(table, lambda i: i % 50 == 0, round_anchors=turn).collect())
    assert got == brute_negatives(rows)
    assert negatives.mine(table.limit(0), lambda i: i % 50 == 0).count() == 0


def test_residual_bounds_hold():
    rng = np.random.default_rng(1)
    vectors, anchors = rng.integers(-150, 150, (3000, 10)), rng.integers(-150, 150, (20, 10))
    book = negatives.Codebook.fitted(vectors[:300])
    codes, residual = book.encoded(vectors)
    scores = negatives.looked_up(book.tables(anchors, np.int64), codes)
    assert (np.abs(scores - vectors @ anchors.T) <= residual[:, None] * negatives.norms(anchors)).all()
    assert residual.mean() < 0.2 * negatives.norms(vectors).mean()


def test_large_components_are_an_error(spark):
    table = spark.createDataFrame([(0, 1, [2.0**24])], "vec_id long, label int, embedding array<double>")
    with pytest.raises(Exception, match="2\\*\\*24"):
        negatives.mine(table, lambda i: i % 50 == 0).count()
