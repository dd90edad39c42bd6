"""Cross-entropy differences against a plain count of bigrams."""

from collections import Counter
from math import log

import pytest
from tokenizers import Tokenizer

from siltbed.llm import lm_scoring, queries

SF = "/root/testdata/sf0.01"


def brute(texts: dict, target: set):
    tokenizer = Tokenizer.from_file(queries.WORD_BPE)
    end, size = queries.WORD_BPE_END, queries.WORD_BPE_SIZE
    tokens = {i: [end, *tokenizer.encode(t or "", add_special_tokens=False).ids, end] for i, t in texts.items()}
    out = {}
    models = []
    for members in (target, set(texts)):
        pairs = Counter(p for i in members for p in zip(tokens[i], tokens[i][1:]))
        single = Counter(t for i in members for t in tokens[i][1:])
        models.append((pairs, single, sum(single.values())))
    for i, ids in tokens.items():
        loss = []
        for pairs, single, total in models:
            losses = [
                -log((pairs[a, b] + lm_scoring.CONTEXT * (single[b] + 1) / (total + size)) / (single[a] + lm_scoring.CONTEXT))
                for a, b in zip(ids, ids[1:])
            ]
            loss.append(sum(losses) / len(losses))
        out[i] = (len(ids) - 1, *loss)
    return out


def test_query(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "BLOCK_TOKENS", 50_000)
    texts = {r["doc_id"]: r["text"] for r in queries.table(spark, SF, "documents").collect()}
    target = {r["doc_id"] for r in queries.table(spark, SF, "labels").where("quality = 1").collect()} & set(texts)
    expected = brute(texts, target)
    rows = queries.op1_cross_entropy_difference(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, t, b = expected[r["doc_id"]]
        assert (r["n_tokens"], r["target_loss"], r["background_loss"]) == pytest.approx((n, t, b), rel=1e-9)
        assert r["score"] == pytest.approx(t - b, abs=1e-9)


def test_odd_rows(spark):
    rows = [(1, None, True, 1), (1, None, None, 1), (None, "a b a b", False, 2), (2, "", None, None), (3, "x " * 50_000, True, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, flag boolean, block int")
    got = lm_scoring.score(docs, "flag", queries.WORD_BPE, queries.WORD_BPE_END, queries.WORD_BPE_SIZE).collect()
    assert sorted(r["n_tokens"] for r in got) == [1, 1, 1, 5, 50_001]
    assert {r["doc_id"] for r in got} == {1, 2, 3, None}
    empty = lm_scoring.score(docs.limit(0), "flag", queries.WORD_BPE, queries.WORD_BPE_END, queries.WORD_BPE_SIZE)
    assert empty.count() == 0
