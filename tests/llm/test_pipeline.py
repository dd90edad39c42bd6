"""The native operators against SQL, and every stage of the pipeline against a brute-force version on its own input."""

import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from siltbed.llm import exact_dedup, mixing, queries, url_filter
from tests.llm.test_jaccard import brute_components
from tests.llm.test_near import five_words
from tests.llm.test_packing import checked

SF = "/root/testdata/sf0.01"
TABLES = ("documents", "pages", "labels", "embeddings")


def plain(rows):
    return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = queries.QUERIES[name](spark, SF)
    names = sorted(found.columns)
    sql = con.sql(f"SELECT {', '.join(names)} FROM ({queries.ORACLE_SQL[name]})").fetchall()
    assert plain(found.select(*names).collect()) == plain(sql)


ODD = [(1, None, "s", "a"), (1, None, "s", "a"), (2, "", None, "b"), (None, "Aa b", "s", None), (None, "aA b", "t", "x"),
       (7, "aa B", "t", "x"), (8, "w " * 40_000, "t", "x"), (9, "é É", "t", "x"), (10, "é é", "t", "x")]
SCHEMA = "doc_id long, text string, source string, digest string"


def test_dedup_odd_rows(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    rows = exact_dedup.DigestIndex(keep="max").decide(docs).collect()
    got = Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in rows)
    assert got == Counter({(1, 2, 3, False): 2, (2, 2, 3, True): 1, (None, 7, 3, False): 2, (7, 7, 3, True): 1,
                           (8, 8, 1, True): 1, (9, 9, 1, True): 1, (10, 10, 1, True): 1})
    left = exact_dedup.without_copies(docs.where("doc_id IS NULL OR doc_id != 2"), keep="max")
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 7, 8, 9, 10]
    assert left.columns == docs.columns
    assert exact_dedup.DigestIndex().decide(docs.limit(0)).count() == 0


def test_dedup_verifies_bytes(spark):
    """With a digest of two values, bytes alone tell texts apart."""
    docs = spark.createDataFrame([(i, f"t{i % 7}") for i in range(40)], "doc_id long, text string")
    weak = exact_dedup.DigestIndex(digest=lambda norm: F.encode((F.crc32(norm) % 2).cast("string"), "utf-8"))
    rows = weak.decide(docs).collect()
    assert {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in rows} == {
        i: (i % 7, len(range(i % 7, 40, 7))) for i in range(40)
    }


def test_dedup_index_takes_more_runs(spark):
    index = exact_dedup.DigestIndex()
    old = index.compact(index.flush(spark.createDataFrame([(5, "a"), (6, "b")], "doc_id long, text string")))
    new = index.flush(spark.createDataFrame([(1, "A"), (9, "c")], "doc_id long, text string"))
    merged = index.compact(old.select("digest", F.col("keep_id").alias("id")), new)
    assert sorted(r["keep_id"] for r in merged.collect()) == [1, 6, 9]


def test_mixing_odd_rows(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(ODD)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    taken, target = defaultdict(int), {}
    for r in rows:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert taken == {s: int(t) for s, t in target.items()}
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mixture_of_odd_rows(spark):
    """Columns named like the operator's own, rows without id, repeated rows: whole rows, and no copy is lost."""
    rows = [(i, "w " * (i % 7), "ab"[i % 2], i, 1) for i in range(200)] + [(500, "x y z", "c", 1, 1)] * 6
    rows += [(None, f"only {i}", "a", 2, 2) for i in range(40)] + [(None, None, "a", 3, 3), (None, "", None, 4, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int, copy int")
    wanted = defaultdict(int)
    for r in mixing.mix(docs).collect():
        wanted[r["source"]] += r["taken"]
    got, whole = defaultdict(int), Counter(rows)
    for r in mixing.mixture(docs).collect():
        assert tuple(r) in whole
        got[r["source"]] += len((r["text"] or "").split())
    assert all(abs(got[s] - n) <= 4 for s, n in wanted.items())
    assert Counter(map(tuple, mixing.mixture(docs).collect())) == Counter(map(tuple, mixing.mixture(docs.repartition(3)).collect()))


def test_targets_are_resharing(spark):
    sizes = {"a": 10, "b": 1000, "c": 500, "d": 30, "e": 4000, "f": 1, None: 70, "g": 0}
    rows = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, target, open_ = 1.5 * sum(sizes.values()), {}, set(sizes)
    while True:
        give = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if give[s] >= 2 * sizes[s]}
        if not above:
            break
        target |= {s: 2.0 * sizes[s] for s in above}
        left, open_ = left - sum(2 * sizes[s] for s in above), open_ - above
    assert {r["source"]: r["target"] for r in rows} == pytest.approx(target | give)


def brute_verdict(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fit = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fit, key=lambda r: (len(r[0] + r[1]), len(r[0])), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


@pytest.mark.parametrize("bound", [2_000_000, 0])
def test_urls(spark, bound, monkeypatch):
    monkeypatch.setattr(url_filter, "MAX_LISTED", bound)
    urls = ["http://A.Example.com/en/7?x=/de/", "https://x.y.net/de/81#q", "org/es/", "ftp://org/es/", None, "", "://", "a://b://c/d",
            "http://notcom/en/", "http://com/en/", "http://u@h.com:80/en/", "http://x.com.:80", "http://example.net/de/8", "http://q\n.com/en/\nz",
            *[f"http://s{i}.example.{t}/{p}/{i}" for i in range(60) for t in ("com", "net", "org") for p in ("en", "de", "es")]]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(1, urls[1], "h")], "page_id long, url string, host string")
    rules = [*queries.URL_RULES, *[(f"s{i}.example.org", "/", ("block", "allow")[i % 2]) for i in range(40)]]
    rows = url_filter.judge(pages, spark.createDataFrame(rules, "host string, path string, action string")).collect()
    assert len(rows) == len(urls) + 1
    for r in rows:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute_verdict(urls[r["page_id"]], rules)
    assert url_filter.judge(pages.limit(0), spark.createDataFrame(rules, "host string, path string, action string")).count() == 0


def test_cascade_is_exact(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    cascade = url_filter.build(keys, keys.where("key LIKE '%7'"))
    rows = keys.select("key", url_filter.hashes(F.col("key")).alias("h")).collect()
    assert cascade.has(url_filter.as_pairs(r["h"] for r in rows)).tolist() == [r["key"].endswith("7") for r in rows]
    assert len(cascade.levels) > 2


def test_stages(spark):
    docs = queries.table(spark, SF, "documents")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        count = Counter(r["doc_id"] for r in docs.collect())
        docs = corpus_pipeline.staged(stage(spark, docs, SF), "test")
        rows = docs.collect()
        kept[name] = rows
        ids = [r["doc_id"] for r in rows]
        if name != "packing":
            assert docs.columns == columns
            assert all(r == before[r["doc_id"]] for r in rows)
        if name == "quality":
            scored = queries.op10_quality_neighbours(spark, SF).where("predicted = 1").select("doc_id").collect()
            assert sorted(ids) == sorted(r["doc_id"] for r in scored) and len(ids) < len(before)
        if name == "exact_dedup":
            best = {}
            for i, r in before.items():
                low = re.sub("[A-Z]+", lambda m: m[0].lower(), r["text"])
                best[low] = max(i, best.get(low, i))
            assert sorted(ids) == sorted(best.values()) and len(ids) < len(before)
        if name == "jaccard_join":
            found = brute_components(five_words({i: r["text"] for i, r in before.items()}), 80)
            assert sorted(ids) == sorted(set(found.values())) and len(ids) < len(before)
        if name == "mixing":
            size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for i, r in before.items()}
            target = {r["source"]: r["target"] for r in mixing.mix(spark.createDataFrame(list(before.values()))).collect()}
            taken, longest = Counter(), Counter()
            for i, n in Counter(ids).items():
                assert n <= 2
                taken[before[i]["source"]] += n * size[i]
            for i, r in before.items():
                longest[r["source"]] = max(longest[r["source"]], size[i])
            assert all(abs(taken[s] - t) <= longest[s] / 2 + 1 for s, t in target.items())
        if name == "packing":
            checked(rows, 2048)
            assert Counter(r["doc_id"] for r in rows if r["piece"] == 0) == count


def test_run_is_its_stages(spark):
    assert "pipeline" in __import__("__spark_entry__").queries()
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    checked(rows, 2048)
