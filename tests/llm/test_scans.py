"""Media columns, personal data, language and quality: brute force, round trips and held-out accuracy."""

import hashlib
import re
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltbed.llm import langid, media, pii, quality, queries

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, media string, score double, id string"
ODD = [(1, None, "x", 1.0, "a"), (2, "", None, None, None), (None, "a b", "y", 0.0, "b"), (2, "", None, None, None),
       (3, "word " * 40_000, "z", 2.0, "c")]


def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


def reference_filtered(samples: np.ndarray, kinds: list[int], step: int) -> bytes:
    """The filters of the PNG specification, byte by byte."""
    out = bytearray()
    for y, kind in enumerate(kinds):
        out.append(kind)
        for x in range(samples.shape[1]):
            a = int(samples[y, x - step]) if x >= step else 0
            b = int(samples[y - 1, x]) if y else 0
            c = int(samples[y - 1, x - step]) if y and x >= step else 0
            p = a + b - c
            pa, pb, pc = abs(p - a), abs(p - b), abs(p - c)
            paeth = a if pa <= pb and pa <= pc else b if pb <= pc else c
            out.append((int(samples[y, x]) - (0, a, b, (a + b) // 2, paeth)[kind]) % 256)
    return bytes(out)


def png(rows: bytes, width: int, height: int, colour: int) -> bytes:
    header = struct.pack(">IIBBBBB", width, height, 8, colour, 0, 0, 0)
    return media.SIGNATURE + media.chunk(b"IHDR", header) + media.chunk(b"IDAT", zlib.compress(rows)) + media.chunk(b"IEND", b"")


@pytest.mark.parametrize(("colour", "step"), [(0, 1), (2, 3), (6, 4)])
def test_all_filters_decode(colour, step):
    samples = np.random.default_rng(step).integers(0, 256, (11, 7 * step), dtype=np.uint8)
    kinds = [0, 1, 2, 3, 4, 4, 3, 2, 2, 1, 0]
    assert (media.decoded(png(reference_filtered(samples, kinds, step), 7, 11, colour)).reshape(11, -1) == samples).all()


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=700))
def test_png_round_trip(raw):
    payload = raw.ljust(max(1, -(-len(raw) // 192)) * 192)
    assert media.decoded(media.encoded(payload)).tobytes() == payload


def test_damage_is_reported(spark):
    good = media.encoded(b" " * 192)
    files = [good, good[:-3], good[:40] + bytes([good[40] ^ 1]) + good[41:], b"GIF89a", None]
    rows = spark.createDataFrame([(i, f) for i, f in enumerate(files)], "doc_id long, media binary")
    found = {r["doc_id"]: r for r in media.image_features(rows).collect()}
    assert found[0]["error"] is None and found[0]["payload_bytes"] == 192
    assert all(found[i]["error"] and found[i]["feature"] is None for i in (1, 2, 3, 4))


def test_media_query(spark):
    texts = {r["doc_id"]: r["text"] for r in queries.table(spark, SF, "documents").collect()}
    rows = queries.op6_png_media(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        padded = raw.ljust(max(1, -(-len(raw) // 192)) * 192)
        assert (r["n_bytes"], r["payload_bytes"]) == (len(raw), len(padded))
        assert r["payload_sha256"] == hashlib.sha256(padded).hexdigest()
        assert r["tail_crc32"] == zlib.crc32(padded[-16:])


def test_media_odd_rows(spark):
    rows = media.image_features(media.with_images(odd(spark))).collect()
    assert sorted(r["n_bytes"] for r in rows) == [0, 0, 0, 3, 200_000]
    assert {r["doc_id"] for r in rows} == {1, 2, 3, None}
    assert media.image_features(media.with_images(odd(spark).limit(0))).count() == 0


BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain_luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def brute_base(text):
    found = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and plain_luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((m.start(), k, m.end()))
    return sorted(found)


@settings(max_examples=400, deadline=None)
@given(st.text("a1@.+-() 4%2\né", max_size=60))
def test_base_spans_are_the_patterns(text):
    assert pii.detected(text) == brute_base(text)


def test_pii_query_keeps_base(spark):
    texts = {r["doc_id"]: r["text"] for r in queries.table(spark, SF, "documents").collect()}
    for r in queries.op9_pii_spans(spark, SF).collect():
        base = brute_base(texts[r["doc_id"]])
        written = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert r["base_sha256"] == hashlib.sha256(written.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(x[1] == i for x in base) for i in range(4)]
        assert r["spans"] == written  # these documents hide nothing


@pytest.mark.parametrize(
    ("text", "kind", "found"),
    [
        ("mail jane.doe [at] example [dot] com now", "email", "jane.doe [at] example [dot] com"),
        ("write jane at mail dot example dot com please", "email", "jane at mail dot example dot com"),
        ("jаne@exаmple.com", "email", "jаne@exаmple.com"),
        ("to me​@foo​.com!", "email", "me​@foo​.com"),
        ("host 192.168.1[.]7 up", "ip", "192.168.1[.]7"),
        ("４111 1111 1111 1111", "card", "４111 1111 1111 1111"),
        ("call plus one seven four three five five five one two three four", "phone", "plus one seven four three five five five one two three four"),
        ("ring +1 (743) 555–3824 today", "phone", "+1 (743) 555–3824"),
    ],
)
def test_disguises(text, kind, found):
    assert [(s["kind"], text[s["start"] : s["end"]], s["added"]) for s in pii.spans_of(text)] == [(kind, found, True)]


@pytest.mark.parametrize("text", ["look at the dot on it", "one two three", "the point at last", "1990–1995", ""])
def test_clean_texts(text):
    assert pii.spans_of(text) == []


def test_long_runs_are_linear():
    for text in ("a" * 300_000, "1" * 300_000, "+1((((" * 50_000, "1." * 150_000, "@" * 300_000, "a@" * 150_000):
        pii.spans_of(text)


def test_pii_odd_rows(spark):
    assert [len(r["spans"]) for r in pii.find(odd(spark)).collect()] == [0] * 5
    assert pii.find(odd(spark).limit(0)).count() == 0


def test_language_held_out(spark):
    truth = queries.table(spark, SF, "documents").select("doc_id", "lang")
    rows = queries.op8_language_id(spark, SF).where("held_out").join(truth, "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "the and of", "en"), (2, "der und die", "de"), (3, None, "en"), (4, "12 !", None), (None, "und", None)],
        "doc_id long, text string, lang string",
    )
    rows = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs, langid.learn(docs)).collect()}
    assert rows == {1: "en", 2: "de", 3: "und", 4: "und", None: "de"}
    nothing = langid.learn(docs.limit(0))
    assert {r["lang_pred"] for r in langid.identify(docs, nothing).collect()} == {"und"}


def test_naive_bayes_is_the_formula(spark):
    docs = spark.createDataFrame([(1, "aab", "x"), (2, "abc ca", "y"), (3, "b", "y")], "doc_id long, text string, lang string")
    model = langid.learn(docs)
    grams = {}
    for r in docs.collect():
        t = f" {r['text']} "
        for n in langid.SIZES:
            for i in range(len(t) - n + 1):
                grams.setdefault(r["lang"], []).append(t[i : i + n])
    t, sums = " ab ", []
    for lang in ("x", "y"):
        total = np.log({"x": 1, "y": 2}[lang] / 3)
        for n in langid.SIZES:
            for i in range(len(t) - n + 1):
                total += np.log((grams[lang].count(t[i : i + n]) + 0.5) / (len(grams[lang]) + 0.5 * 2**langid.BITS))
        sums.append(total)
    share = np.exp(sums - max(sums)) / np.exp(sums - max(sums)).sum()
    names, scores = model.predict(["ab"])
    assert names == [("x", "y")[int(np.argmax(sums))]]
    assert scores[0] == pytest.approx(share.max(), rel=1e-4)


def test_quality_held_out(spark):
    truth = queries.table(spark, SF, "labels")
    rows = queries.op10_quality_neighbours(spark, SF).where("held_out").join(truth, "doc_id").collect()
    assert sum(r["quality"] == r["predicted"] for r in rows) >= 0.9 * len(rows)


def test_quality_neighbours_are_exact(spark):
    docs, labels = (queries.table(spark, SF, t) for t in ("documents", "labels"))
    model = quality.fit(docs, labels, sample_rows=100)
    assert len(model.labels) == 100
    texts = [r["text"] for r in docs.orderBy("doc_id").limit(40).collect()]
    for text, score in zip(texts, model.scores(texts), strict=True):
        [(_, counts, again)] = quality.counts_of([text])
        cosines = (model.refs @ model.vectors(counts, again)[0]).tolist()
        near = sorted(range(100), key=lambda i: -cosines[i])[: model.neighbours]
        weights = [max(0, cosines[i]) ** quality.SHARPNESS for i in near]
        assert score == pytest.approx(sum(w * model.labels[i] for w, i in zip(weights, near, strict=True)) / sum(weights), abs=1e-3)


def test_quality_odd_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit(odd(spark), none)
    assert {r["score"] for r in quality.classify(odd(spark), model).collect()} == {0.5}
    labels = spark.createDataFrame([(3, 1), (3, 0), (1, None), (None, 1)], "doc_id long, quality int")
    rows = quality.classify(odd(spark), quality.fit(odd(spark), labels)).collect()
    assert len(rows) == 5 and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.kept(odd(spark), model).select(F.count("*")).first()[0] == 5
    assert quality.classify(odd(spark).limit(0), model).count() == 0
