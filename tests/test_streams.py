"""Stream = batch: each stateful stream replayed over 1 and 3 files equals
its batch twin."""

from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from sliceflow.functions.exprs import ntz_micros
from sliceflow.operators import ordered as W
from sliceflow.plans import stream_queries as Q, views
from sliceflow.session import scratch_path
from sliceflow.streaming import jobs as S

ORDER = ["ts", "event_id"]


def _stream(spark, df, files):
    path = S.replay_files(df, scratch_path(spark, "t-src"), "ts", files)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _run(spark, stream_df):
    out = scratch_path(spark, "t-out")
    S.run_available(lambda: S.to_parquet_sink(stream_df, out, scratch_path(spark, "t-ck")))
    return spark.read.parquet(out)


@pytest.fixture(scope="module")
def jev(spark):
    return views.job_events(spark, SF0001).select("workspace_id", "event_id", "ts", "kind")


@pytest.mark.parametrize("files,buckets", [(1, 256), (3, 256), (3, 2)])
def test_streak_stream_equals_batch(spark, jev, files, buckets):
    got = _run(spark, S.streak_stream(_stream(spark, jev, files), "failed", 3, buckets))
    want = (W.true_streak(jev, ["workspace_id"], ORDER, F.col("kind") == "failed", "streak")
            .where(F.col("streak") >= 3).select("workspace_id", "event_id", "ts", "streak"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("files,buckets", [(1, 256), (3, 256), (3, 2)])
def test_admission_stream_equals_batch(spark, jev, files, buckets):
    ev = jev.where(F.col("kind").isin("submitted", "completed"))
    got = _run(spark, S.admission_stream(_stream(spark, ev, files), "submitted", "completed", 2,
                                         buckets))
    want = W.admission_fold(ev, ["workspace_id"], ORDER, F.col("kind") == "submitted",
                            F.col("kind") == "completed", 2).select(
        "workspace_id", "event_id", "running_before", "admitted")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("files", [1, 3])
def test_missed_heartbeats_equals_batch_gaps(spark, jev, files):
    beats = jev.where(F.col("kind") == "heartbeat")
    limit = 24 * 3600 * 1_000_000
    res = _run(spark, S.missed_heartbeats(_stream(spark, beats, files), limit, "1 day"))
    got = res.where(~F.col("open")).select("workspace_id", "from_ts", "to_ts")
    # open gaps: keys whose last beat + limit lies before the final watermark
    last = beats.groupBy("workspace_id").agg(F.max("ts").alias("last"))
    wm = beats.agg(F.max("ts")).first()[0] - timedelta(days=1)
    want_open = {r.workspace_id for r in last.collect()
                 if r.last + timedelta(days=1) < wm}
    assert {r.workspace_id for r in res.where(F.col("open")).collect()} == want_open
    prev = W.previous_value(beats, ["workspace_id"], ORDER, "ts", "prev")
    want = (prev.where(F.col("prev").isNotNull())
            .where(ntz_micros(F.col("ts")) - ntz_micros(F.col("prev")) > limit)
            .select("workspace_id", F.col("prev").alias("from_ts"), F.col("ts").alias("to_ts")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.count() > 0


def test_more_files_than_the_least_lose_no_events(spark, monkeypatch):
    events = views.table(spark, SF0001, "events")
    add = W.add_chunks
    monkeypatch.setattr(W, "add_chunks", lambda df, order, **kw: add(df, order, rows_per_chunk=events.count() // 12, **kw))
    got = [r.event_id for r in Q.q_dedup_events(spark, SF0001).select("event_id").collect()]
    assert sorted(got) == sorted(r.event_id for r in events.where("event_id % 97 <> 0").select("event_id").collect())


@pytest.mark.parametrize("rows", [1000, 4])
def test_large_batches_have_more_files_not_more_batches(spark, monkeypatch, rows):
    monkeypatch.setattr(S, "ROWS_PER_FILE", 50 if rows > 50 else 1)
    add = S.add_chunks
    monkeypatch.setattr(S, "add_chunks", lambda df, order, **kw: add(df, order, rows_per_chunk=max(1, rows // 12), **kw))
    df = spark.range(rows).select("id", F.timestamp_micros(F.col("id")).cast("timestamp_ntz").alias("ts"))
    n = S.files_per_batch(df, 3)
    assert n == (7 if rows > 50 else 2)
    path = S.replay_files(df, scratch_path(spark, "t-src"), "ts", 3, n)
    files = spark.read.parquet(path).inputFiles()
    assert len(files) % n == 0 and len(files) <= 3 * n
    log = scratch_path(spark, "t-log")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", n).parquet(path)
    S.run_available(lambda: S.upsert_log(stream.groupBy("id").agg(F.max("ts").alias("ts")), log, scratch_path(spark, "t-ck")), spark=spark, large_state=True)
    got = spark.read.parquet(log).groupBy("batch").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("n")).orderBy("lo").collect()
    assert len(got) <= 3 and [r["batch"] for r in got] == sorted(r["batch"] for r in got)
    assert sum(r["n"] for r in got) == rows and all(r["hi"] - r["lo"] + 1 == r["n"] for r in got)


def test_good_rows_of_a_split_keep_no_payload(spark):
    good = '{"event_id": 1, "ts": "2024-01-01T00:00:00.000001", "user_id": 2, "event_type": "view", "value": 1.5, "props": "p"}'
    src, out, dead = (scratch_path(spark, n) for n in ("t-src", "t-good", "t-dead"))
    df = spark.createDataFrame([("k", good, "t"), ("k", None, "t"), ("k", "{", "t")], "key string, value string, topic string")
    S.write_in_order([df.limit(0), df], src, 4)
    assert len(spark.read.parquet(src).inputFiles()) == 8
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 4).parquet(src)
    S.run_available(lambda: S.split_sinks(S.parse_events(stream), out, dead, scratch_path(spark, "t-ck")))
    assert [r["event_id"] for r in spark.read.parquet(out).collect()] == [1]
    assert sorted(str(r["original_payload"]) for r in spark.read.parquet(dead).collect()) == ["None", "{"]


def test_state_fold_snapshot_equals_incremental(spark, jev):
    ev = jev.select("workspace_id", "event_id", "ts", F.col("kind").alias("state"))
    vals = ["state", "ts", "event_id"]
    snap = scratch_path(spark, "t-snap")
    S.run_available(lambda: S.state_fold(_stream(spark, ev, 3), snap,
                                         scratch_path(spark, "t-ck"), "workspace_id",
                                         ORDER, vals))
    log = scratch_path(spark, "t-log")
    S.run_available(lambda: S.state_fold_incremental(_stream(spark, ev, 3), log,
                                                     scratch_path(spark, "t-ck"),
                                                     "workspace_id", ORDER, vals))
    a = spark.read.parquet(S.latest_state_version(spark, snap)).select("workspace_id", *vals)
    b = S.latest_rows(spark, log, ["workspace_id"]).select("workspace_id", *vals)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert a.count() == jev.select("workspace_id").distinct().count()


def test_event_times_do_not_follow_the_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        t = spark.createDataFrame([(f"2024-03-10 0{1 + i // 60}:{i % 60:02d}:07.250001",) for i in range(180)], "t string")
        us = [r.u for r in t.select(ntz_micros(F.col("t").cast("timestamp_ntz")).alias("u")).collect()]
        assert [b - a for a, b in zip(us, us[1:])] == [60_000_000] * 179
        back = t.withColumn("n", F.col("t").cast("timestamp_ntz"))
        assert all(r.a == r.b for r in back.select(S.wall_clock(S.event_time("n")).alias("a"), F.col("n").alias("b")).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_broken_records_are_errors(spark):
    good = '{"event_id": 1, "ts": "2024-01-01T00:00:00.000001", "user_id": 2, "event_type": "view", "value": 1.5, "props": "p"}'
    bad = [good[:-5], good + " x", good + good, good.replace('"2024-01-01T00:00:00.000001"', '"garbage"'), good.replace("2,", '"x",', 1), good.replace('"user_id": 2', '"user_id": null'),
           good.replace("view", "sing"), "", None, "[]", good.replace('"event_id": 1', '"event_id": null')]
    df = spark.createDataFrame([("k", v, "t") for v in [good, *bad]], "key string, value string, topic string")
    p = S.parse_events(df)
    assert [r.event_id for r in S.good_events(p).collect()] == [1]
    assert S.dead_letters(p).count() == len(bad)


def test_a_task_counts_once(spark):
    rows = [(1, 7, "PENDING", 1), (1, 7, "LEASED", 2), (1, 7, "SUCCEEDED", 3), (2, 7, "PENDING", 1)]
    log = spark.createDataFrame(rows, "task_id long, run_id long, state string, seq int")
    got = S.progress(S.latest_task_states(log, ["seq"])).first()
    assert tuple(got) == (7, 2, 1, 0, 1, 0)


def _null_keys(spark):
    rows = [(None if i % 3 else 7, i, f"2024-01-{1 + i // 20:02d} 00:{i % 20:02d}:00", "failed" if i % 7 else "submitted") for i in range(120)]
    return spark.createDataFrame(rows, "workspace_id long, event_id long, ts string, kind string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@pytest.mark.parametrize("files", [1, 4])
def test_null_keys_are_a_key_like_others(spark, files):
    ev = _null_keys(spark)
    got = _run(spark, S.streak_stream(_stream(spark, ev, files), "failed", 3, 4))
    want = W.true_streak(ev, ["workspace_id"], ORDER, F.col("kind") == "failed", "streak").where(F.col("streak") >= 3).select("workspace_id", "event_id", "ts", "streak")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert {r["workspace_id"] for r in got.collect()} == {None, 7}
    got = _run(spark, S.admission_stream(_stream(spark, ev, files), "submitted", "failed", 2, 4))
    want = W.admission_fold(ev, ["workspace_id"], ORDER, F.col("kind") == "submitted", F.col("kind") == "failed", 2).select("workspace_id", "event_id", "running_before", "admitted")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    gaps = _run(spark, S.missed_heartbeats(_stream(spark, ev, files), 10 * 60 * 1_000_000, "1 hour", 4)).where(~F.col("open"))
    prev = W.previous_value(ev, ["workspace_id"], ORDER, "ts", "from_ts").where(ntz_micros(F.col("ts")) - ntz_micros(F.col("from_ts")) > 10 * 60 * 1_000_000)
    assert sorted(map(tuple, gaps.select("workspace_id", "from_ts", "to_ts").collect()), key=str) == sorted(map(tuple, prev.select("workspace_id", "from_ts", "ts").collect()), key=str)


@pytest.mark.parametrize("files,buckets", [(1, 8), (5, 2)])
def test_retries(spark, files, buckets):
    ev = _null_keys(spark).select(F.when(F.col("event_id") != 5, F.col("event_id")).alias("id"), F.when(F.col("event_id") != 6, F.col("kind")).alias("payload"), "ts")

    def handler(frame):
        return [None if n > (0 if str(i) == "<NA>" else i % 5) else f"no {n}" for i, n in zip(frame["id"], frame["attempt"])]

    got = _run(spark, S.deliver_with_retries(_stream(spark, ev, files), handler, "1 day", 3, 60_000, buckets)).collect()
    end = max(r["ts"] for r in ev.collect()) - timedelta(days=1)
    want = []
    for r in ev.collect():
        k = 0 if r["id"] is None else r["id"] % 5
        if k == 0 or r["ts"] + timedelta(minutes=1 if k == 1 else 3) <= end:
            want.append((r["id"], r["payload"], min(k + 1, 3), k < 3, None if k < 3 else "no 3"))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert {r[3] for r in want} == {True, False}


def test_undelivered_rows_appear_when_time_is_closed(spark):
    ev = _null_keys(spark).withColumn("id", F.when(F.col("event_id") != 3, F.col("event_id")))
    made = ev.select("id", F.col("ts").alias("created_at"))
    # every fourth is never published, the others at once; 8 too late
    sent = ev.where("event_id % 4 <> 0 or event_id = 8").select("id", F.when(F.col("event_id") == 8, F.col("ts") + F.expr("INTERVAL 2 DAYS")).otherwise(F.col("ts")).alias("published_at"))

    def source(df, col):
        return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(S.replay_files(df, scratch_path(spark, "t-src"), col, 3))
    got = _run(spark, S.undelivered_stream(source(made, "created_at"), source(sent, "published_at"), "1 DAY", "1 hour")).collect()
    rows = ev.collect()
    end = min(max(r["ts"] for r in rows), max(r["published_at"] for r in sent.collect())) - timedelta(hours=1)
    want = [(r["id"], r["ts"]) for r in rows if (r["event_id"] % 4 == 0 or r["id"] is None) and r["ts"] + timedelta(days=1) < end]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str) and len(want) > 10
