"""Driver contract: entry() runs, every query has an oracle, and every query
returns the oracle's rows on the smallest driver tables."""

from __future__ import annotations

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from conftest import SF0001
from sliceflow.plans import all_oracles, all_queries

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


def _norm(df: pd.DataFrame):
    df = df[sorted(df.columns)]
    out = []
    for r in df.itertuples(index=False):
        row = []
        for v in r:
            if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
                row.append(None)
            elif isinstance(v, float):
                row.append(float(f"{v:.10g}"))
            elif isinstance(v, pd.Timestamp):
                row.append(v.to_pydatetime())
            elif hasattr(v, "item"):
                row.append(v.item())
            else:
                row.append(v)
        out.append(tuple(row))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["partition_index", "region", "total_revenue", "avg_revenue",
                          "row_count"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(all_queries()))
def test_query_matches_oracle(spark, con, key):
    got = all_queries()[key](spark, SF0001).toPandas()
    want = con.execute(all_oracles()[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _norm(got) == _norm(want)
