"""Chunked scans: rows of a null key are a key like others; as-of joins and dense gauges."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sliceflow.operators import changes as M
from sliceflow.operators import history as H
from sliceflow.operators import ordered as W

OPTS = {"rows_per_chunk": 7, "min_chunks": 5}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    return [(rng.choice([None, None, None, 1, 2]), rng.choice([None, "a"]), t // 2, i, rng.choice([True, False, None, True]), rng.choice(["s", "r", "o"]))
            for i, t in enumerate(rng.sample(range(120), 90))]


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "k int, g string, t int, id int, f boolean, kind string")


def _by_key(rows):
    keys = {}
    for r in sorted(rows, key=lambda r: (r[2], r[3])):
        keys.setdefault((r[0], r[1]), []).append(r)
    return keys.values()


def test_scans(df, rows):
    total, before, after, streak, known = {}, {}, {}, {}, {}
    for seq in _by_key(rows):
        run = length = 0
        last = None
        for i, r in enumerate(seq):
            run += r[2]
            length = length + 1 if r[4] else 0
            last = r[2] if r[4] is False else last
            total[r[3]], streak[r[3]], known[r[3]] = run, length, last
            before[r[3]] = seq[i - 1][2] if i else None
            after[r[3]] = seq[i + 1][2] if i + 1 < len(seq) else None
    keys, order = ["k", "g"], ["t", "id"]
    got = lambda out: {r["id"]: r["out"] for r in out.collect()}
    assert got(W.running_sum(df, keys, order, F.col("t"), "out", **OPTS)) == total
    assert got(W.previous_value(df, keys, order, "t", "out", **OPTS)) == before
    assert got(W.next_value(df, keys, order, "t", "out", **OPTS)) == after
    assert got(W.true_streak(df, keys, order, F.col("f"), "out", **OPTS)) == streak
    assert got(W.last_known(df, keys, order, F.when(~F.col("f"), F.col("t")), "out", **OPTS)) == known
    assert set(W.running_sum(df, keys, order, F.col("t"), "out", **OPTS).columns) == {*df.columns, "out"}


def test_admission(df, rows):
    want = {}
    for seq in _by_key(rows):
        c = 0
        for r in seq:
            want[r[3]] = (c, c < 3 if r[5] == "s" else None)
            c += (c < 3) if r[5] == "s" else -(r[5] == "r")
    got = W.admission_fold(df, ["k", "g"], ["t", "id"], F.col("kind") == "s", F.col("kind") == "r", 3, **OPTS)
    assert {r["id"]: (r["running_before"], r["admitted"]) for r in got.collect()} == want


def test_list_newest_first(spark, rows):
    t0 = dt.datetime(2024, 1, 1)
    data = [(r[0], t0 + dt.timedelta(hours=r[2]), r[3]) for r in rows]
    got = H.list_newest_first(spark.createDataFrame(data, "k int, at timestamp_ntz, id int"), "k", "at", "id", **OPTS).collect()
    want = {}
    for k in {r[0] for r in data}:
        for n, r in enumerate(sorted((r for r in data if r[0] == k), key=lambda r: (-r[1].timestamp(), r[2])), 1):
            want[r[2]] = n
    assert {r["id"]: r["pos"] for r in got} == want


def test_state_as_of_and_intervals(spark, df, rows):
    log = df.where("kind = 'o'").selectExpr("k", "g", "t", "id as seq", "f as state", "t as since")
    asked = df.where("kind <> 'o'").select("k", "g", "t", "id")
    want = {}
    for r in rows:
        if r[5] != "o":
            known = [x for x in rows if x[5] == "o" and x[:2] == r[:2] and x[2] <= r[2]]
            x = max(known, key=lambda x: (x[2], x[3])) if known else None
            want[r[3]] = (x[4], x[2]) if x else (None, None)
    got = M.state_as_of(asked, log, ["k", "g"], "t", "seq", ["state", "since"], **OPTS)
    assert got.columns == ["k", "g", "t", "id", "state", "since"]
    assert {r["id"]: (r["state"], r["since"]) for r in got.collect()} == want
    ends = {r["seq"]: (r["valid_from"], r["valid_to"]) for r in M.validity(log, ["k", "g"], "t", "seq", **OPTS).collect()}
    for seq in _by_key([r for r in rows if r[5] == "o"]):
        for a, b in zip(seq, [*seq[1:], None]):
            assert ends[a[3]] == (a[2], b[2] if b else None)


def test_sampled_gauges(spark):
    t0 = dt.datetime(2024, 1, 1)
    data = [(None, 0, 2), ("a", 61, 1), ("a", 125, -3), (None, 400, 5), ("a", 401, 1)]
    deltas = spark.createDataFrame([(s, t0 + dt.timedelta(seconds=t), d) for s, t, d in data], "s string, at timestamp_ntz, d int")
    got = H.sampled_gauges(deltas, "at", "s", "d", 60, ticks_per_chunk=3, rows_per_chunk=2).collect()
    want = {(s, k): sum(d for x, t, d in data if x == s and t // 60 <= k) for s in (None, "a") for k in range(7)}
    assert {(r["series"], (r["tick"] - t0).seconds // 60): r["value"] for r in got} == want and len(got) == 14
    assert H.sampled_gauges(deltas.limit(0), "at", "s", "d", 60).collect() == []
