"""Every registered query of the library and its DuckDB SQL, gathered from the modules of ``siltbed.plans``."""

from __future__ import annotations

from importlib import import_module

MODULES = ("corpus", "timeline", "places", "evidence", "relations", "scenes", "reviews", "selections", "prints", "exports")
FLAGSHIP = "dedup_keep_best"

QUERIES, ORACLE_SQL = {}, {}
for _name in MODULES:
    _module = import_module(f"siltbed.plans.{_name}")
    QUERIES.update(_module.QUERIES)
    ORACLE_SQL.update(_module.ORACLE_SQL)
