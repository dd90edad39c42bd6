"""Every query of the library that SQL can express, against DuckDB on the smallest tables."""

import importlib
import os

import pytest

from siltbed import catalog

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the test tables are not here")


def plain(value):
    """A value as text that both engines write alike; floats to nine digits."""
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(plain, value)) + "]"
    if isinstance(value, dict):
        return "{" + ",".join(f"{k}:{plain(v)}" for k, v in sorted(value.items())) + "}"
    return str(value)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_same_rows(spark, duck, name):
    df = catalog.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    answer = duck.execute(catalog.ORACLE_SQL[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    want = sorted(tuple(plain(row[i]) for i in places) for row in answer.fetchall())
    got = sorted(tuple(map(plain, row)) for row in df.select(*[f"`{c}`" for c in columns]).collect())
    assert got == want


#: Queries that SQL cannot express, and the tests that hold them, or their operators on built rows, against plain loops.
HELD = {
    "title_pairs_blocked": "test_pairs.test_title_queries_run_the_rule", "greedy_title_matches": "test_pairs.test_title_queries_run_the_rule",
    "evidence_windows": "test_pairs.test_evidence_windows_are_the_loop", "patched_bank": "test_reviews.test_patches_are_the_loop",
    "near_shapes": "test_shapes.test_near", "way_crossings": "test_choices.test_crossings_are_the_loop", "shape_widths": "test_shapes.test_widths",
    "fingerprint_matches": "test_prints.test_matches_are_the_loop", "fingerprint_summary": "test_prints.test_matches_are_the_loop",
    "adjacent_segments": "test_rules.test_adjacent_segments_are_the_fold", "anchor_chunks": "test_rules.test_chunks_are_the_rule",
}


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_held_elsewhere(name):
    module, test = HELD[name].split(".")
    assert callable(getattr(importlib.import_module(f"tests.{module}"), test))


def test_every_sql_has_a_query():
    assert set(catalog.ORACLE_SQL) <= set(catalog.QUERIES)
