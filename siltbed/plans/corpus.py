"""Corpus queries: titles, authors, duplicates, keep and delete plans, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltbed.functions import arrays as ar
from siltbed.functions import text as tx
from siltbed.operators import dedup, graph
from siltbed.sources import fixtures as fx

AUTHOR_ALIASES = {"a1": "first", "a2": "second", "a3": "second"}


def dedup_keep_best(spark: SparkSession, sf: str) -> DataFrame:
    """Groups of equal normalised titles: rows kept and dropped by source."""
    items = fx.items(spark, sf).withColumn("norm", tx.title_norm(F.col("title")))
    best = dedup.keep_best(items, ["norm"], [F.col("source").desc(), F.col("size").desc(), F.col("id")])
    return best.groupBy("source").agg(
        F.count_if("keep").alias("kept"), F.count_if(~F.col("keep")).alias("dropped"), F.sum("size").alias("chars")
    )


def dedup_first_wins_nullkey(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.table(spark, sf, "events").select("event_id", "user_id", F.nullif("event_type", F.lit("view")).alias("kind"))
    return dedup.first_wins(rows, ["user_id", "kind"], ["event_id"])


def title_normalise(spark: SparkSession, sf: str) -> DataFrame:
    title = F.col("title")
    return fx.items(spark, sf).select(
        "id", tx.title_norm(title).alias("norm"), tx.episode_key(title).alias("episode"),
        tx.author_canonical(F.col("author"), AUTHOR_ALIASES).alias("author"), tx.slug(title).alias("slug"),
    )


def author_affix_top12(spark: SparkSession, sf: str) -> DataFrame:
    titles = fx.items(spark, sf).select(F.concat("lang", F.col("source")).alias("author"), "title")
    found = dedup.learned_affixes(titles, "author", "title", share=0.002)
    return found.select("author", F.array_join("affixes", "|").alias("affixes"))


def number_conflict_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Of all pairs of an author's pages whose addresses name numbers: how many share none."""
    rows = fx.items(spark, sf).select("id", "author").join(fx.table(spark, sf, "pages").select(F.col("page_id").alias("id"), "url"), "id")
    return dedup.number_conflict_counts(rows, "author", "url")


def duration_ok_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Of all pairs of an author's items: how many may be one by their durations."""
    return dedup.duration_counts(fx.items(spark, sf), "author", "duration")


def _comparable(spark: SparkSession, sf: str) -> DataFrame:
    title = F.regexp_replace("title", f"(?i){tx.EPISODE}", "")
    return fx.items(spark, sf).select("id", "author", "source", "title", tx.title_norm(title).alias("comparable"), "duration")


def title_pairs_blocked(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of an author's items across sources whose titles match."""
    return dedup.title_pairs(_comparable(spark, sf))


def greedy_title_matches(spark: SparkSession, sf: str) -> DataFrame:
    items = fx.items(spark, sf).select(F.col("id").alias("left"), F.col("author").alias("block"))
    pairs = dedup.title_pairs(_comparable(spark, sf)).join(items, "left")
    return dedup.greedy_matches(pairs.select("block", "left", "right", "similarity"))


def cluster_components(spark: SparkSession, sf: str) -> DataFrame:
    """Items linked by equal texts, or by equal titles from one source."""
    items = fx.items(spark, sf).withColumn("norm", tx.title_norm(F.col("title")))
    by_text = items.groupBy("text_hash").agg(F.min("id").alias("b"))
    by_title = items.groupBy("source", "norm").agg(F.min("id").alias("b"))
    links = items.join(by_text, "text_hash").select(F.col("id").alias("a"), "b")
    links = links.unionByName(items.join(by_title, ["source", "norm"]).select(F.col("id").alias("a"), "b"))
    labels = graph.components(links)
    return items.join(labels, F.col("id") == F.col("node"), "left").select("id", F.coalesce("label", "id").alias("cluster"))


def delete_plan_reasons(spark: SparkSession, sf: str) -> DataFrame:
    """Copies of a text that go, by kind and the reason for which they stay after all."""
    items = fx.files(spark, sf).withColumn("path", F.concat_ws("/", F.concat(F.lit("s"), "source"), "text_hash"))
    best = dedup.keep_best(items, ["text_hash"], [F.col("source").desc(), F.col("size").desc(), F.col("id")])
    keeps = best.where("keep").select("path", F.col("author").alias("item_id"), (F.col("source") == "2").alias("tutorial"))
    drops = best.where("NOT keep").select("id", "path", F.col("author").alias("item_id"), "source", "size")
    kind = F.when(F.col("source") == "2", "tutorial").when(F.col("source") == "1", "main").when(F.col("size") < 500, "other").otherwise("clip")
    return dedup.delete_reasons(drops, keeps, kind).groupBy("kind", "reason").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("chars"))


def author_platform_pivot(spark: SparkSession, sf: str) -> DataFrame:
    """Authors on two platforms or more, with their counts."""
    counts = fx.items(spark, sf).groupBy("author").pivot("source", ["0", "1", "2"]).count()
    names = {str(i): f"platform_{i}" for i in range(3)}
    filled = counts.select("author", *[F.coalesce(k, F.lit(0)).alias(v) for k, v in names.items()])
    platforms = sum((F.when(F.col(v) > 0, 1).otherwise(0) for v in names.values()), F.lit(0))
    return filled.where(platforms >= 2)


def unmatched_samples8(spark: SparkSession, sf: str) -> DataFrame:
    """Items whose text no other item has, by author: how many, and the first eight."""
    items = fx.items(spark, sf)
    shared = items.groupBy("text_hash").count().where("count > 1").select("text_hash")
    alone = items.join(shared, "text_hash", "left_anti")
    ranked = alone.withColumn("rank", F.row_number().over(Window.partitionBy("author").orderBy("id")))
    samples = F.array_sort(F.collect_list(F.when(F.col("rank") <= 8, F.col("id"))))
    return ranked.groupBy("author").agg(F.count(F.lit(1)).alias("unmatched"), F.array_join(samples, ",").alias("samples"))


def corpus_summary(spark: SparkSession, sf: str) -> DataFrame:
    items = fx.items(spark, sf)
    return items.groupBy("lang").agg(
        F.count(F.lit(1)).alias("items"), F.sum("size").alias("chars"), F.count("duration").alias("timed"),
        F.countDistinct("author").alias("authors"), F.array_join(F.sort_array(F.collect_set("source")), ",").alias("sources"),
    )


def _prints(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprints of 64 unsigned 32-bit numbers from embeddings."""
    number = F.transform("embedding", lambda x: F.floor(F.abs(x.cast("double")) * 1e9).cast("long") % F.lit(1 << 32))
    return fx.table(spark, sf, "embeddings").select("vec_id", number.alias("print"))


def fingerprint_similarity(spark: SparkSession, sf: str) -> DataFrame:
    """Each vector's fingerprint against the next one's, and against its own shifted by two."""
    prints = _prints(spark, sf)
    nxt = prints.select((F.col("vec_id") - 1).alias("vec_id"), F.col("print").alias("other"))
    shifted = F.slice("print", 3, 100)
    return prints.join(nxt, "vec_id").select(
        "vec_id", F.round(ar.fingerprint_similarity(F.col("print"), F.col("other")), 9).alias("next"),
        F.round(ar.fingerprint_similarity(F.col("print"), shifted), 9).alias("shifted"),
    )


def difference_hash(spark: SparkSession, sf: str) -> DataFrame:
    """Hashes of 9 x 7 grey grids cut from embeddings."""
    grey = F.slice("embedding", 1, 63)
    return fx.table(spark, sf, "embeddings").select("vec_id", ar.difference_hash(grey, 9, 7).alias("hash"))


PUNCTUATION = tx.TITLE_PUNCTUATION.replace("'", "''")


def norm_sql(column: str) -> str:
    plain = f"replace(replace(regexp_replace({column}, '#\\S+', ' ', 'g'), '图寻geoguessr', ' '), 'geoguessr', ' ')"
    return f"lower(regexp_replace({plain}, '{PUNCTUATION}', '', 'g'))"


NORM, EPISODE_SQL = norm_sql("title"), f"coalesce(regexp_extract(replace(lower(title), ' ', ''), '{tx.EPISODE}', 1), '')"

ORACLE_SQL = {
    "dedup_keep_best": f"""WITH {fx.ITEMS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY {NORM}
        ORDER BY source DESC, size DESC, id) = 1 AS keep FROM items)
        SELECT source, count(*) FILTER (keep) AS kept, count(*) FILTER (NOT keep) AS dropped, CAST(sum(size) AS BIGINT) AS chars FROM r GROUP BY source""",
    "dedup_first_wins_nullkey": """WITH e AS (SELECT event_id, user_id, nullif(event_type, 'view') AS kind FROM events),
        r AS (SELECT *, row_number() OVER (PARTITION BY user_id, kind ORDER BY event_id) AS rank FROM e)
        SELECT event_id, user_id, kind FROM r WHERE rank = 1 OR kind IS NULL OR user_id IS NULL""",
    "title_normalise": f"""WITH {fx.ITEMS_SQL} SELECT id, {NORM} AS norm, {EPISODE_SQL} AS episode,
        CASE author WHEN 'a1' THEN 'first' WHEN 'a2' THEN 'second' WHEN 'a3' THEN 'second' ELSE author END AS author,
        regexp_replace(regexp_replace(lower(trim(title, ' ')), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug FROM items""",
    "author_affix_top12": f"""WITH {fx.ITEMS_SQL}, n AS (SELECT lang || source AS author, {NORM} AS norm FROM items),
        k AS (SELECT * FROM n WHERE norm <> ''), t AS (SELECT author, count(*) AS total FROM k GROUP BY author HAVING count(*) >= 5),
        l AS (SELECT author, norm, unnest([8,10,12,14,16,18,20,24,28,32,36,40]) AS size FROM k WHERE length(norm) >= 12),
        a AS (SELECT author, unnest([substring(norm, 1, size), right(norm, size)]) AS affix FROM l WHERE length(norm) > size + 3),
        f AS (SELECT author, affix, count(*) AS n FROM a GROUP BY ALL),
        g AS (SELECT f.author, affix, row_number() OVER (PARTITION BY f.author ORDER BY length(affix) DESC, affix) AS rank
              FROM f JOIN t USING (author) WHERE f.n >= greatest(4, floor(total * 0.002)))
        SELECT author, string_agg(affix, '|' ORDER BY rank) AS affixes FROM g WHERE rank <= 12 GROUP BY author""",
    "number_conflict_pairs": f"""WITH {fx.ITEMS_SQL}, p AS (SELECT id, author, regexp_extract_all(url, '\\d+') AS nums FROM items JOIN pages ON page_id = id)
        SELECT a.author, count(*) AS pairs, count(*) FILTER (NOT list_has_any(a.nums, b.nums)) AS conflicts FROM p a JOIN p b ON a.author = b.author AND a.id < b.id AND len(a.nums) > 0 AND len(b.nums) > 0 GROUP BY 1
        UNION ALL SELECT author, 0, 0 FROM p WHERE len(nums) > 0 GROUP BY author HAVING count(*) = 1""",
    "duration_ok_pairs": f"""WITH {fx.ITEMS_SQL} SELECT author, count(b) AS pairs, count(b) FILTER (coalesce(greatest(x, y) <= 0 OR abs(x - y) <= greatest(x, y) * 0.2::DOUBLE, true)) AS compatible
        FROM (SELECT a.author, a.duration AS x, b.duration AS y, b.id AS b, a.duration IS NULL OR b.duration IS NULL AS unknown FROM items a LEFT JOIN items b ON a.author = b.author AND a.id < b.id)
        GROUP BY author""",
    "cluster_components": f"""WITH RECURSIVE {fx.ITEMS_SQL}, i AS (SELECT id, text_hash, source, {NORM} AS norm FROM items),
        e AS (SELECT a.id AS a, b.id AS b FROM i a JOIN i b ON a.text_hash = b.text_hash
              UNION SELECT a.id, b.id FROM i a JOIN i b ON a.source = b.source AND a.norm = b.norm),
        r AS (SELECT id, id AS reach FROM i UNION SELECT r.id, e.b FROM r JOIN e ON r.reach = e.a)
        SELECT id, min(reach) AS cluster FROM r GROUP BY id""",
    "delete_plan_reasons": f"""WITH {fx.FILES_SQL}, r AS (SELECT *, 's' || source || '/' || text_hash AS path,
        row_number() OVER (PARTITION BY text_hash ORDER BY source DESC, size DESC, id) = 1 AS keep FROM files),
        d AS (SELECT *, CASE source WHEN '2' THEN 'tutorial' WHEN '1' THEN 'main' ELSE CASE WHEN size < 500 THEN 'other' ELSE 'clip' END END AS kind
              FROM r WHERE NOT keep),
        x AS (SELECT kind, size, CASE WHEN kind = 'other' THEN 'path outside allowed prefixes'
              WHEN path IN (SELECT path FROM r WHERE keep) THEN 'title-cluster keep' WHEN kind = 'tutorial' THEN 'tutorials stay'
              WHEN kind = 'main' AND author NOT IN (SELECT author FROM r WHERE keep AND source = '2') THEN 'same title, other episode' END AS reason FROM d)
        SELECT kind, reason, count(*) AS n, CAST(sum(size) AS BIGINT) AS chars FROM x GROUP BY kind, reason""",
    "author_platform_pivot": f"""WITH {fx.ITEMS_SQL} SELECT author, count(*) FILTER (source = '0') AS platform_0,
        count(*) FILTER (source = '1') AS platform_1, count(*) FILTER (source = '2') AS platform_2
        FROM items GROUP BY author HAVING count(DISTINCT source) >= 2""",
    "unmatched_samples8": f"""WITH {fx.ITEMS_SQL}, u AS (SELECT *, count(*) OVER (PARTITION BY text_hash) AS n FROM items),
        r AS (SELECT author, id, row_number() OVER (PARTITION BY author ORDER BY id) AS rank FROM u WHERE n = 1)
        SELECT author, count(*) AS unmatched, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) FILTER (rank <= 8) AS samples FROM r GROUP BY author""",
    "corpus_summary": f"""WITH {fx.ITEMS_SQL} SELECT lang, count(*) AS items, CAST(sum(size) AS BIGINT) AS chars, count(duration) AS timed,
        count(DISTINCT author) AS authors, string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM items GROUP BY lang""",
    "fingerprint_similarity": """WITH p AS (SELECT vec_id, [CAST(floor(abs(CAST(x AS DOUBLE)) * 1e9::DOUBLE) AS BIGINT) % 4294967296 FOR x IN embedding] AS print FROM embeddings),
        q AS (SELECT a.vec_id, a.print AS x, b.print AS y, list_slice(a.print, 3, 102) AS z FROM p a JOIN p b ON b.vec_id = a.vec_id + 1),
        o AS (SELECT unnest(range(-12, 13)) AS o),
        s AS (SELECT vec_id, list_slice(x, greatest(o, 0) + 1, 1000) AS a, list_slice(y, greatest(-o, 0) + 1, 1000) AS b,
                     list_slice(z, greatest(-o, 0) + 1, 1000) AS c FROM q, o),
        m AS (SELECT vec_id, least(len(a), len(b)) AS nb, least(len(a), len(c)) AS nc, a, b, c FROM s),
        v AS (SELECT vec_id, CASE WHEN nb >= 16 THEN 1 - list_sum([bit_count(xor(a[i], b[i])) FOR i IN range(1, nb + 1)]) / (nb * 32.0::DOUBLE) ELSE 0 END AS sb,
                     CASE WHEN nc >= 16 THEN 1 - list_sum([bit_count(xor(a[i], c[i])) FOR i IN range(1, nc + 1)]) / (nc * 32.0::DOUBLE) ELSE 0 END AS sc FROM m)
        SELECT vec_id, round(greatest(0, max(sb)), 9) AS next, round(greatest(0, max(sc)), 9) AS shifted FROM v GROUP BY vec_id""",
    "difference_hash": """SELECT vec_id, CAST(list_sum([CASE WHEN embedding[(k // 8) * 9 + k % 8 + 1] > embedding[(k // 8) * 9 + k % 8 + 2]
        THEN CAST(1 AS BIGINT) << (55 - k) ELSE 0 END FOR k IN range(0, 56)]) AS BIGINT) AS hash FROM embeddings""",
}

QUERIES = {
    f.__name__: f
    for f in (
        dedup_keep_best, dedup_first_wins_nullkey, title_normalise, author_affix_top12, number_conflict_pairs, duration_ok_pairs,
        title_pairs_blocked, greedy_title_matches, cluster_components, delete_plan_reasons, author_platform_pivot,
        unmatched_samples8, corpus_summary, fingerprint_similarity, difference_hash,
    )
}
