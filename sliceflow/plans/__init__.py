"""Registered queries: each key maps to a Spark job over the driver tables and
to an equivalent DuckDB SQL statement used as the correctness oracle."""

from __future__ import annotations

import importlib

_MODULES = ("slice_queries", "history_queries", "ordered_queries", "source_queries",
            "stream_queries")


def _load():
    queries, oracle = {}, {}
    for name in _MODULES:
        m = importlib.import_module(f"{__name__}.{name}")
        dup = set(queries) & set(m.QUERIES)
        if dup:
            raise RuntimeError(f"duplicate query keys {dup}")
        queries.update(m.QUERIES)
        oracle.update(getattr(m, "ORACLE", {}))
    return queries, oracle


def all_queries():
    return _load()[0]


def all_oracles():
    return _load()[1]
