"""The registered queries of this subpackage: each operator over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.llm import audit, divergence, exact_dedup, jaccard_join, langid, lm_scoring, media, mixing, negatives, packing, pii, quality, url_filter
from siltbed.llm._common import small, staged, table


WORD_BPE, WORD_BPE_END, WORD_BPE_SIZE = public_tokenizers.path("word_bpe_49k.json"), 49407, 49408


def op1_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target is the documents labelled as of good quality, the background all documents."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    good = staged(labels.where("quality = 1").select(F.col("doc_id").alias("good_id")).distinct(), "lm-target")
    flagged = docs.join(small(good), docs["doc_id"] == good["good_id"], "left")
    flagged = flagged.select("doc_id", "text", F.col("good_id").isNotNull().alias("in_target"))
    return lm_scoring.score(flagged, "in_target", WORD_BPE, WORD_BPE_END, WORD_BPE_SIZE)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = exact_dedup.DigestIndex(keep="max").decide(table(spark, sf_dir, "documents"))
    return decided.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicate_groups(table(spark, sf_dir, "documents"), width=3, percent=90)


def op4_grouping_genetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), WORD_BPE)


#: Fixed values: (host, path, action).
URL_RULES = [
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
]


def op5_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def op6_png_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = media.image_features(media.with_images(table(spark, sf_dir, "documents")))
    return found.select(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"
    )


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def remainder(modulus: int):
    """crc32 of the id as text, modulo; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.learn(docs.where(remainder(3) != 1))
    held_out = F.coalesce(remainder(3) == 1, F.lit(False))
    return langid.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def listed(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.expr(f"concat_ws(',', transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)))")


def op9_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents")).withColumn("base", F.expr("filter(spans, s -> not s.added)"))
    counts = [
        F.expr(f"cast(size(filter(base, s -> s.kind = '{kind}')) as long) AS n_{kind}")
        for kind in pii.KINDS
    ]
    return found.select("doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


#: Least quality score of a document that stays.
GOOD_ENOUGH = 0.3


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.NeighbourModel:
    return quality.fit(docs, labels.where(remainder(5) != 0))


def op10_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder(5) == 0, F.lit(False))
    return quality.classify(docs, quality_model(docs, table(spark, sf_dir, "labels"))).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= GOOD_ENOUGH).cast("int").alias("predicted")
    )


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"))


def op12_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return divergence.judge(docs, divergence.profiles(docs))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of ids divisible by 7 move on; vectors as whole numbers; anchors are ids divisible by 50."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    # A cast of what is not finite to a whole number would be finite, so components stay doubles.
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256.0).cast("double"))
    rows = rows.select("vec_id", label.alias("label"), F.when(finite, whole).alias("embedding"))
    return negatives.mine(rows, lambda vec_id: vec_id % 50 == 0)


QUERIES = {
    f.__name__: f
    for f in (
        op1_cross_entropy_difference,
        op2_exact_dedup,
        op3_jaccard_join,
        op4_grouping_genetic,
        op5_url_cascade,
        op6_png_media,
        op7_source_mixing,
        op8_language_id,
        op9_pii_spans,
        op10_quality_neighbours,
        op11_source_divergence,
        op12_distribution_divergence,
        op13_hard_negatives,
    )
}

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

UPPER_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _without(pattern: str, text: str) -> str:
    return f"regexp_replace({text}, '{pattern}', '', 'g')"


def _distance(p: str, q: str) -> str:
    """The Jensen-Shannon distance of two lists of counts."""
    a, b = f"({p}[i] / list_sum({p}))", f"({q}[i] / list_sum({q}))"
    half = "CASE WHEN {0} > 0 THEN {0} * log2({0} * 2 / ({0} + {1})) ELSE 0 END"
    return f"sqrt(greatest(0, list_sum([({half.format(a, b)} + {half.format(b, a)}) / 2 FOR i IN range(1, len({p}) + 1)])))"


_TAKEN = divergence.CLASSES
RULES_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS uid, doc_id, lang, coalesce(text, '') AS l0 FROM documents),
l AS (SELECT *, {", ".join(f"{_without(p, f'l{i}')} AS l{i + 1}" for i, p in enumerate(_TAKEN.values()))} FROM d),
h AS (SELECT uid, doc_id, lang, l0 AS text, regexp_extract_all(l0, '[^\x20\x09-\x0D]+') AS words,
      [{", ".join(f"CAST(length(l{i}) - length(l{i + 1}) AS DOUBLE)" for i in range(len(_TAKEN)))}, CAST(length(l{len(_TAKEN)}) AS DOUBLE)] AS classes FROM l),
w AS (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(words) AS word FROM h WHERE lang IS NOT NULL) GROUP BY ALL),
wr AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS rank, sum(n) OVER (PARTITION BY lang) AS total FROM w),
pw AS (SELECT lang, list(word ORDER BY rank) AS common, list_append(list(CAST(n AS DOUBLE) ORDER BY rank), CAST(any_value(total) - sum(n) AS DOUBLE)) AS profile
       FROM wr WHERE rank <= 32 AND total >= 1000 GROUP BY lang),
pc AS (SELECT lang, [{", ".join(f"sum(classes[{i + 1}])" for i in range(len(_TAKEN) + 1))}] AS class_profile FROM h GROUP BY lang),
lines AS (SELECT uid, count(*) - count(DISTINCT line) AS n_dup_lines FROM (SELECT uid, unnest(string_split(text, chr(10))) AS line FROM h)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY uid),
x AS (SELECT uid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram FROM (SELECT uid, words, unnest(range(1, len(words) - 1)) AS i FROM h)),
twice AS (SELECT uid, gram FROM x GROUP BY ALL HAVING count(*) > 1),
again AS (SELECT uid, count(DISTINCT i + k) AS n_repeat_words FROM x JOIN twice USING (uid, gram), range(0, 3) r(k) GROUP BY uid),
own AS (SELECT h.*, common, profile, class_profile, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, len(words) AS n_words,
        CAST(list_sum(classes) - classes[2] AS BIGINT) AS word_chars, CAST(classes[4] AS BIGINT) AS n_symbols
        FROM h LEFT JOIN pw USING (lang) LEFT JOIN pc USING (lang) LEFT JOIN lines USING (uid) LEFT JOIN again USING (uid)),
cw AS (SELECT uid, list(n ORDER BY rank) AS own_words, sum(n) AS held FROM
       (SELECT o.uid, rank, count(t.word) AS n FROM own o JOIN wr ON wr.lang = o.lang AND rank <= 32
        LEFT JOIN (SELECT uid, unnest(words) AS word FROM h) t ON t.uid = o.uid AND t.word = wr.word WHERE o.n_words >= 100 AND o.profile IS NOT NULL GROUP BY o.uid, rank) GROUP BY uid),
j AS (SELECT own.*, list_append([CAST(n AS DOUBLE) FOR n IN own_words], CAST(n_words - held AS DOUBLE)) AS counts FROM own LEFT JOIN cw USING (uid)),
f AS (SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
      CASE WHEN profile IS NOT NULL AND word_chars >= 200 THEN {_distance("classes", "class_profile")} END AS cd,
      CASE WHEN profile IS NOT NULL AND n_words >= 100 THEN {_distance("counts", "profile")} END AS wd FROM j)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(cd <= 0.3, true) AND coalesce(wd <= 0.35, true) AS kept, round(cd, 6) AS class_distance, round(wd, 6) AS word_distance FROM f"""

ORACLE_SQL = {
    "op2_exact_dedup": f"""
WITH t AS (SELECT doc_id, {LOWERED} AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256
FROM t JOIN g USING (norm)""",
    "op5_url_cascade": r"""
WITH rules(host, path, action) AS (VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'),
    ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
p AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
m AS (SELECT page_id, r.host || r.path AS rule, action,
             row_number() OVER (PARTITION BY page_id ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS rank
      FROM p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM p LEFT JOIN (SELECT * FROM m WHERE rank = 1) USING (page_id)""",
    "op7_source_mixing": r"""
WITH t AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
                  md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), md5(text), '')) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM t GROUP BY source),
i AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS idx FROM s),
w AS (SELECT *, [5.0, 2.0, 1.0][CAST(idx % 3 + 1 AS INT)]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS cap FROM i),
r AS (SELECT *, cap / weight AS ratio, (SELECT CAST(sum(size) AS DOUBLE) * 1.5::DOUBLE FROM t) AS pot FROM w),
f AS (SELECT *, ratio <= (pot - coalesce(sum(cap) OVER (ORDER BY ratio, idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY ratio, idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS capped FROM r),
c AS (SELECT *, sum(CASE WHEN capped THEN cap ELSE 0 END) OVER () AS fixed,
             sum(CASE WHEN capped THEN 0 ELSE weight END) OVER () AS free FROM f),
g AS (SELECT source, source_size, CASE WHEN capped THEN cap ELSE weight * ((pot - fixed) / free) END AS target FROM c),
b AS (SELECT *, CAST(floor(target) AS BIGINT) AS budget,
             CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM g),
p AS (SELECT doc_id, size, source_size, target, budget, epochs,
             coalesce(sum(size) OVER (PARTITION BY t.source ORDER BY key, doc_id, size
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM t JOIN b ON t.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - before)) AS BIGINT) AS taken FROM p""",
    "op11_source_divergence": rf"""
WITH d AS (SELECT row_number() OVER () AS uid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (SELECT uid, lang, source, unnest(regexp_extract_all(translate(text, {UPPER_LOWER}), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT uid) >= 3),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
s AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT lang, source, term, coalesce(n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(n, 0) + 1) // (total + v)::HUGEINT AS p
      FROM s JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
q AS (SELECT lang, term, 1 + 1000000000::HUGEINT * (sum(n) + 1)::HUGEINT // (any_value(total) + any_value(v))::HUGEINT AS q
      FROM p JOIN (SELECT lang, sum(total) AS total FROM s GROUP BY lang) USING (lang) JOIN v USING (lang) GROUP BY lang, term),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(f, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS f
                 FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) f
      ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
r AS (SELECT *, 'pair' AS part, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
      UNION ALL BY NAME SELECT *, 'term' AS part, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM terms)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM r WHERE part = 'pair' OR rank <= 200""",
    "op12_distribution_divergence": RULES_SQL,
    "op13_hard_negatives": """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS x FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
      FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) AS place FROM s WHERE same QUALIFY place <= 5),
n AS (SELECT p.anchor, p.id AS positive, p.score AS positive_score, s.id, s.score,
             row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY s.score DESC, s.id) AS rank
      FROM p JOIN s ON p.anchor = s.anchor AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor AS anchor_id, positive AS positive_id, CAST(rank AS INT) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM n WHERE rank <= 3""",
}
