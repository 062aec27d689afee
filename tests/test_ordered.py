"""Chunked per-key scans against a sequential pandas fold, with a hot key."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sliceflow.operators import ordered as W


def make_events(n=600, seed=7):
    rnd = random.Random(seed)
    rows = []
    t0 = pd.Timestamp("2024-01-01")
    for i in range(n):
        # key 0 holds about a third of all rows
        key = 0 if rnd.random() < 0.34 else rnd.randint(1, 9)
        ts = t0 + pd.Timedelta(seconds=rnd.randint(0, 5000))  # many equal timestamps
        kind = rnd.choice(["submitted", "completed", "failed", "other"])
        rows.append((key, i, ts, kind))
    return pd.DataFrame(rows, columns=["k", "event_id", "ts", "kind"])


@pytest.fixture(scope="module")
def ev(spark):
    pdf = make_events()
    df = spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return pdf.sort_values(["k", "ts", "event_id"]).reset_index(drop=True), df


OPTS = dict(rows_per_chunk=40, min_chunks=8)


def test_running_sum(ev):
    pdf, df = ev
    d = F.when(F.col("kind") == "submitted", 1).when(F.col("kind") == "completed", -1).otherwise(0)
    got = {r.event_id: r.run for r in
           W.running_sum(df, ["k"], ["ts", "event_id"], d, "run", **OPTS).collect()}
    a = np.where(pdf.kind == "submitted", 1, np.where(pdf.kind == "completed", -1, 0))
    want = pd.Series(a).groupby(pdf.k).cumsum()
    assert got == dict(zip(pdf.event_id, want))


def test_previous_value(ev):
    pdf, df = ev
    got = {r.event_id: r.prev for r in
           W.previous_value(df, ["k"], ["ts", "event_id"], "event_id", "prev", **OPTS).collect()}
    want = pdf.groupby("k")["event_id"].shift(1)
    assert got == {e: (None if pd.isna(p) else int(p)) for e, p in zip(pdf.event_id, want)}


def test_true_streak(ev):
    pdf, df = ev
    got = {r.event_id: r.s for r in
           W.true_streak(df, ["k"], ["ts", "event_id"], F.col("kind") == "failed", "s",
                         **OPTS).collect()}
    want = {}
    for _, g in pdf.groupby("k"):
        s = 0
        for e, kind in zip(g.event_id, g.kind):
            s = s + 1 if kind == "failed" else 0
            want[e] = s
    assert got == want


@pytest.mark.parametrize("limit", [1, 2, 3])
def test_admission_fold(ev, limit):
    pdf, df = ev
    out = W.admission_fold(df, ["k"], ["ts", "event_id"], F.col("kind") == "submitted",
                           F.col("kind") == "completed", limit, **OPTS).collect()
    got = {r.event_id: (r.running_before, r.admitted) for r in out}
    want = {}
    for _, g in pdf.groupby("k"):
        c = 0
        for e, kind in zip(g.event_id, g.kind):
            if kind == "submitted":
                want[e] = (c, c < limit)
                if c < limit:
                    c += 1
            elif kind == "completed":
                want[e] = (c, None)
                c -= 1
            else:
                want[e] = (c, None)
    assert got == want


def test_first_and_last_per_key(ev):
    pdf, df = ev
    first = {r.k: r.event_id for r in
             W.first_per_key(df, ["k"], ["ts", "event_id"], ["event_id"]).collect()}
    last = {r.k: r.event_id for r in
            W.first_per_key(df, ["k"], ["ts", "event_id"], ["event_id"], last=True).collect()}
    assert first == pdf.groupby("k").event_id.first().to_dict()
    assert last == pdf.groupby("k").event_id.last().to_dict()


def test_chunked_plan_has_no_unpartitioned_window(ev, capsys):
    _, df = ev
    W.running_sum(df, ["k"], ["ts", "event_id"], F.lit(1), "run", **OPTS).explain()
    plan = capsys.readouterr().out
    assert "Window" in plan and "SinglePartition" not in plan


def test_running_jobs_release_on_cancel(spark):
    rows = [(1, i, f"2024-01-01 00:00:0{i}", k) for i, k in
            enumerate(["submitted", "submitted", "cancelled", "completed", "submitted"])]
    df = spark.createDataFrame(rows, "k long, event_id long, ts string, kind string") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    keep = [r.running for r in W.running_jobs(df, "k", ["ts", "event_id"]).orderBy("event_id")
            .collect()]
    free = [r.running for r in W.running_jobs(df, "k", ["ts", "event_id"], release_on_cancel=True)
            .orderBy("event_id").collect()]
    assert keep == [1, 2, 1, 2]
    assert free == [1, 2, 1, 0, 1]


def test_many_chunks(ev):
    """Very many chunks give the same running sums."""
    pdf, df = ev
    got = {r.event_id: r.run for r in
           W.running_sum(df, ["k"], ["ts", "event_id"], F.lit(1), "run",
                         rows_per_chunk=2, min_chunks=8).collect()}
    want = pdf.groupby("k").cumcount() + 1
    assert got == dict(zip(pdf.event_id, want))


def test_ties_are_split_and_zones_play_no_part(spark):
    """All rows of one time, on a day when clocks change; some flags are null."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        kinds = ["failed", None, "failed", "failed", "other"]
        rows = [(0 if i % 3 else 1, i, "2024-03-10 02:30:00" if i < 2000 else f"2024-03-10 0{1 + i % 3}:{i % 60:02d}:00", kinds[i % 5]) for i in range(4000)]
        df = spark.createDataFrame(rows, "k long, event_id long, t string, kind string").withColumn("ts", F.col("t").cast("timestamp_ntz"))
        chunked = W.add_chunks(df, ["ts", "event_id"], rows_per_chunk=100)
        assert chunked.groupBy("_c").count().agg(F.max("count")).first()[0] <= 300
        order = sorted(rows, key=lambda r: (r[0], r[2], r[1]))
        total, streak, prev, want = {}, {}, {}, {}
        for k, i, _, kind in order:
            total[k] = total.get(k, 0) + i
            streak[k] = streak.get(k, 0) + 1 if kind == "failed" else 0
            want[i] = (total[k], streak[k], prev.get(k))
            prev[k] = i
        keys = (["k"], ["ts", "event_id"])
        a = {r.event_id: r.x for r in W.running_sum(df, *keys, F.col("event_id"), "x", rows_per_chunk=100).collect()}
        b = {r.event_id: r.x for r in W.true_streak(df, *keys, F.col("kind") == "failed", "x", rows_per_chunk=100).collect()}
        c = {r.event_id: r.x for r in W.previous_value(df, *keys, "event_id", "x", rows_per_chunk=100).collect()}
        assert {i: (a[i], b[i], c[i]) for i in a} == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
