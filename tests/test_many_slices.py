"""P1 with many slices and P2 streamed: the same as the small forms."""

import pandas as pd
import pytest

from sliceflow.operators import slices


@pytest.fixture()
def rows(spark):
    return spark.range(5000).selectExpr("(id * 7919) % 100003 as k", "id as v").repartition(6)


@pytest.mark.parametrize("total", [1, 3, 64, 5000, 100_000])
def test_ranks_give_the_slices(spark, rows, total):
    got = slices.slice_rows_by_rank(rows, "k", total, rows_per_bucket=700)
    assert got.columns == ["k", "v", "partition_index"]
    order = sorted(r["k"] for r in rows.collect())
    size = max(1, 5000 // total)
    assert {r["k"]: r["partition_index"] for r in got.collect()} == {k: min(i // size, total - 1) for i, k in enumerate(order)}


def test_same_as_boundaries(spark, rows):
    a = slices.assign_slices(rows, slices.plan_slices(rows, "k", 7)).collect()
    b = slices.slice_rows_by_rank(rows, "k", 7).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_bad_keys(spark):
    twice = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    with pytest.raises(ValueError, match="repeats"):
        slices.slice_rows_by_rank(twice, "k", 100)
    with pytest.raises(ValueError, match="nulls"):
        slices.slice_rows_by_rank(twice.selectExpr("nullif(k, 1) as k"), "k", 100)
    assert slices.slice_rows(twice.limit(0), "k", 100).collect() == []


def running(frames, params):
    top, n = None, 0
    for f in frames:
        for k in f["k"]:
            assert top is None or k > top
            top, n = k, n + 1
    yield pd.DataFrame({"label": [params["label"]], "n": [n], "top": pd.array([top], dtype="Int64")})


def first_only(frames, params):
    for f in frames:
        yield f.head(1)[["k"]]
        return


@pytest.mark.parametrize("total,tasks", [(3, 2), (7, None), (70, 4)])
def test_streamed_slices(spark, rows, total, tasks):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 97)
    try:
        got = slices.slice_stream(rows, running, "label string, n long, top long", "k", total, {"label": "x"}, tasks).collect()
        first = slices.slice_stream(rows, first_only, "k long", "k", total, tasks=tasks).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = slices.slice_apply(rows, lambda pdf, p: pd.DataFrame({"n": [len(pdf)], "top": [pdf["k"].max()], "low": [pdf["k"].min()]}), "n long, top long, low long", "k", total).collect()
    assert sorted((r["partition_index"], r["n"], r["top"]) for r in got) == sorted((r["partition_index"], r["n"], r["top"]) for r in want)
    assert sorted(map(tuple, first)) == sorted((r["partition_index"], r["low"]) for r in want)


def test_empty_slices_are_called(spark):
    few = spark.createDataFrame([(5,), (1,)], "k long")
    got = slices.slice_stream(few, running, "label string, n long, top long", "k", 4, {"label": "y"}).collect()
    assert sorted(tuple(r) for r in got) == [(0, "y", 1, 1), (1, "y", 1, 5), (2, "y", 0, None), (3, "y", 0, None)]
    short = lambda frames, params: iter([pd.DataFrame({"n": [1]})])
    with pytest.raises(Exception, match="lacks columns"):
        slices.slice_stream(few, short, "n long, top long", "k", 2).collect()
