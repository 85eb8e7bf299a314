"""All bound queries and their oracle SQL, merged from the plan modules."""

from __future__ import annotations

import importlib

MODULES = ["ingest", "shaping", "profiles", "dependence", "mining", "models"]


def _load():
    queries, oracle = {}, {}
    for m in MODULES:
        try:
            mod = importlib.import_module(f"sifter.plans.{m}")
        except ModuleNotFoundError as e:
            if e.name == f"sifter.plans.{m}":
                continue
            raise
        queries.update(mod.QUERIES)
        oracle.update(mod.ORACLE)
    return queries, oracle


def queries():
    return _load()[0]


def oracle_sql():
    return _load()[1]
