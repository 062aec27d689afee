"""Differential test of the per-slice rollup (P4), and plan checks."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

import __spark_entry__ as E
from conftest import SF0001
from sliceflow.operators import rollup


def by_accumulator(rows: list, total: int) -> dict:
    """(slice, region) -> (total, mean, count), one row after the other: a slice
    takes rows until it has its share, the last takes what is left."""
    share, slice_, taken, sums = max(1, len(rows) // total), 0, 0, {}
    for _, region, revenue in sorted(rows):
        if taken == share and slice_ < total - 1:
            slice_, taken = slice_ + 1, 0
        taken += 1
        if region is not None:
            t, n = sums.get((slice_, region), (0.0, 0))
            known = revenue is not None and not math.isnan(revenue)
            sums[slice_, region] = (t + revenue, n + 1) if known else (t, n)
    return {k: (t, t / n if n else None, n) for k, (t, n) in sums.items()}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 100])
@pytest.mark.parametrize("total", [1, 3, 5, 8])
def test_rollup_by_slice_matches_accumulator(spark, n, total):
    rnd = random.Random(n * 31 + total)
    rows = []
    for i in range(n):
        region = rnd.choice(["IN", "US", "EU", None])
        rev = rnd.choice([float(rnd.randint(1, 50)), None, float("nan")])
        rows.append((i, region, rev))
    want = by_accumulator(rows, total)
    df = spark.createDataFrame(rows, "idx long, region string, revenue double")
    got = {(r.partition_index, r.region): (r.total_revenue, r.avg_revenue, r.row_count)
           for r in rollup.region_rollup_by_slice(df, "idx", total).collect()}
    assert got.keys() == want.keys()
    for k, (t, a, c) in want.items():
        gt, ga, gc = got[k]
        assert math.isclose(gt, t) and gc == c
        assert (ga is None and a is None) or math.isclose(ga, a)


def _plan(df, capsys) -> str:
    df.explain()
    return capsys.readouterr().out


@pytest.mark.parametrize("key", ["region_rollup_by_slice", "region_rollup", "run_progress",
                                 "queue_depth", "duration_histogram", "admission_check",
                                 "failure_streaks", "list_newest_first"])
def test_native_operators_have_no_python_node(spark, capsys, key):
    plan = _plan(E.queries()[key](spark, SF0001), capsys)
    for node in ("ArrowEvalPython", "BatchEvalPython", "FlatMapGroupsInPandas",
                 "MapInPandas"):
        assert node not in plan, (key, node)


def test_scans_prune_columns_and_push_filters(spark, capsys):
    plan = _plan(E.queries()["stale_rows"](spark, SF0001), capsys)
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string," \
           "o_orderdate:timestamp_ntz>" in plan


def test_nan_is_missing_not_a_number(spark):
    df = spark.createDataFrame([("EU", float("nan")), ("EU", 4.0)], "region string, revenue double")
    r = rollup.region_rollup(df).first()
    assert (r.total_revenue, r.avg_revenue, r.row_count) == (4.0, 4.0, 1)
    assert not np.isnan(r.total_revenue)
