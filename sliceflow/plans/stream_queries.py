"""Registered streaming queries.

Each replays a driver table as a file stream (a time range per micro-batch, as
many files each as the table needs), runs the streaming job to the end with
``trigger(availableNow=True)`` and returns the finished sink read as a batch,
so the oracle is the SQL of the batch twin.

The noisy topic for T1-T4: every event as a JSON record; records of events
with ``event_id % 97 = 0`` are truncated (bad JSON), and every ``purchase``
record is delivered twice (the copy lands in the next file), as an
at-least-once publisher does after a crash between publish and mark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import FAILURE_THRESHOLD
from ..session import materialize, scratch_path
from ..sources import topics as TP
from ..streaming import jobs as S
from . import views
from .ordered_queries import ORACLE as ORD_ORACLE

FILES = 6
TOPIC = "job.events"

def _events_topic(spark, sf) -> tuple[str, int]:
    """The folder and the number of files in a micro-batch."""
    e = views.table(spark, sf, "events")
    js = F.to_json(F.struct(*[F.col(c) for c in e.columns]), TP.JSON_TS)
    value = F.when(F.col("event_id") % 97 == 0, F.substring(js, 1, 12)).otherwise(js)
    rec = e.select("event_id", "ts", "event_type", F.col("user_id").cast("string").alias("key"),
                   value.alias("value"), F.lit(TOPIC).alias("topic"))
    from ..operators.ordered import add_chunks

    parts = S.whole_chunks(add_chunks(rec, "ts", min_chunks=FILES), FILES)
    again = [p.where(F.col("event_type") == "purchase") for p in parts]
    late = [None, *again]  # by the batch in which copies land: the next, the last its own too
    parts = [p if d is None else p.unionByName(d) for p, d in zip(parts, late)]
    if parts:
        parts[-1] = parts[-1].unionByName(again[-1])
    n = S.files_per_batch(e, FILES)
    headers = F.lit(None).cast(TP.TOPIC_SCHEMA["headers"].dataType).alias("headers")
    return S.write_in_order([p.select("key", "value", "topic", headers) for p in parts], scratch_path(spark, "topic"), n), n


def _topic_stream(spark, sf) -> DataFrame:
    path, n = _events_topic(spark, sf)
    return TP.read_topic(spark, path, stream=True, max_files_per_trigger=n)


def _replayed(spark, df, name):
    """``df`` written in order of ``ts``, as a function that starts a stream over it."""
    n = S.files_per_batch(df, FILES)
    path = S.replay_files(df, scratch_path(spark, name), "ts", FILES, n)
    return lambda: spark.readStream.schema(df.schema).option("maxFilesPerTrigger", n).parquet(path)


def _event_stream(spark, sf, kinds=None) -> DataFrame:
    e = views.job_events(spark, sf).drop("event_type", "props", "value")
    st = _replayed(spark, e, "events")()
    return st.where(F.col("kind").isin(list(kinds))) if kinds else st


def _split(spark, sf):
    good, dead = scratch_path(spark, "good"), scratch_path(spark, "dead")
    parsed = S.parse_events(_topic_stream(spark, sf))
    S.run_available(lambda: S.split_sinks(parsed, good, dead, scratch_path(spark, "ck")), spark=spark)
    return good, dead


def q_parse_events(spark, sf):
    good, _ = _split(spark, sf)
    return spark.read.parquet(good).drop("batch")


def q_quarantine(spark, sf):
    _, dead = _split(spark, sf)
    return spark.read.parquet(dead).select("key", "original_payload", "error", "topic")


def flaky(frame):
    """A handler that fails ``id % 5`` times for every message."""
    return [None if n > i % 5 else f"attempt {n} failed" for i, n in zip(frame["id"], frame["attempt"])]


def q_retry_dead_letters(spark, sf):
    """T2, transient failures: some heal after an attempt or two, some never."""
    e = views.table(spark, sf, "events").select(F.col("event_id").alias("id"), "event_type", "ts")
    st = _replayed(spark, e, "events")()
    out = scratch_path(spark, "attempts")
    done = S.deliver_with_retries(st.withColumnRenamed("event_type", "payload"), flaky, "1 day")
    S.run_available(lambda: S.to_parquet_sink(done, out, scratch_path(spark, "ck")), spark=spark)
    return spark.read.parquet(out)


def q_undelivered_stream(spark, sf):
    """U1 while the stream runs: what no publication followed within a day.  Errors are never
    published, others up to two hours later."""
    e = views.table(spark, sf, "events").select("event_id", "ts", "event_type")
    read = _replayed(spark, e, "events")
    late = F.col("ts") + F.make_dt_interval(mins=F.pmod("event_id", F.lit(120)).cast("int"))
    found = S.undelivered_stream(read().select(F.col("event_id").alias("id"), F.col("ts").alias("created_at")),
                                 read().where("event_type <> 'error'").select(F.col("event_id").alias("id"), late.alias("published_at")), "1 DAY", "6 hours")
    out = scratch_path(spark, "undelivered")
    S.run_available(lambda: S.to_parquet_sink(found, out, scratch_path(spark, "ck")), spark=spark)
    return spark.read.parquet(out)


def _deduped(spark, sf) -> DataFrame:
    ev = S.good_events(S.parse_events(_topic_stream(spark, sf)))
    return S.dedup_events(ev, "10 days")


def q_dedup_events(spark, sf):
    out = scratch_path(spark, "dedup")
    st = _deduped(spark, sf)
    S.run_available(lambda: S.to_parquet_sink(st, out, scratch_path(spark, "ck")), spark=spark)
    return spark.read.parquet(out)


def q_state_fold_stream(spark, sf):
    """T4 in its incremental form (streaming max_by + upsert log); the
    snapshot form is checked against it in the tests."""
    ev = _deduped(spark, sf).select(F.col("user_id").alias("workspace_id"), "event_id", "ts",
                                    views.event_kind().alias("state"))
    path = scratch_path(spark, "state")
    S.run_available(lambda: S.state_fold_incremental(
        ev, path, scratch_path(spark, "ck"), "workspace_id", ["ts", "event_id"],
        ["state", "ts", "event_id"]), spark=spark)
    return S.latest_rows(spark, path, ["workspace_id"]).select(
        "workspace_id", "state", F.col("ts").alias("updated_at"),
        F.col("event_id").alias("last_event_id"))


def q_progress_stream(spark, sf):
    """Every task is made, leased and ends as its row says, days apart."""
    t = materialize(views.tasks(spark, sf).select(F.monotonically_increasing_id().alias("task_id"), "run_id", "state", "created_at"), "tasks")
    step = lambda s, n: F.struct(F.lit(s).alias("state") if isinstance(s, str) else s.alias("state"),
                                 F.lit(n).alias("seq"), (F.col("created_at") + F.expr(f"INTERVAL {40 * n} DAYS")).alias("ts"))
    past = F.when(F.col("state") == "PENDING", F.array(step("PENDING", 0))).when(
        F.col("state") == "LEASED", F.array(step("PENDING", 0), step("LEASED", 1))).otherwise(
        F.array(step("PENDING", 0), step("LEASED", 1), step(F.col("state"), 2)))
    log = t.select("task_id", "run_id", F.explode(past).alias("s")).select("task_id", "run_id", "s.state", "s.seq", "s.ts")
    stream = _replayed(spark, log, "tasks")()
    path = scratch_path(spark, "progress")
    S.run_available(lambda: S.upsert_log(S.latest_task_states(stream, ["ts", "seq"]), path,
                                         scratch_path(spark, "ck")), spark=spark, large_state=True)
    return S.progress(S.latest_rows(spark, path, ["task_id"]))


def q_queue_depth_windows(spark, sf):
    path = scratch_path(spark, "windows")
    """T7: jobs pending and running at the end of each hour.  A submission waits, a first
    sign of life starts it, its end or cancellation takes it away."""
    k = F.col("kind")
    change = lambda up, down: F.when(k.isin(*up), 1).when(k.isin(*down), -1).otherwise(0)
    agg = S.windowed_sums(_event_stream(spark, sf), "ts", {"pending": change(["submitted"], ["heartbeat", "cancelled"]),
                                                           "running": change(["heartbeat"], ["completed", "failed"])}, "1 hour", "1 day")
    S.run_available(lambda: S.upsert_log(agg, path, scratch_path(spark, "ck")), spark=spark)
    return S.depth_per_tick(S.latest_rows(spark, path, ["window_start"]), "window_start", ["pending", "running"])


def q_missed_heartbeats(spark, sf):
    out = scratch_path(spark, "gaps")
    st = S.missed_heartbeats(_event_stream(spark, sf, ["heartbeat"]), 24 * 3600 * 1_000_000,
                             "1 day")
    S.run_available(lambda: S.to_parquet_sink(st, out, scratch_path(spark, "ck")), spark=spark)
    # a gap may be reported as open and end later: the end stands
    gaps = spark.read.parquet(out)
    ended = gaps.where(~F.col("open"))
    still = gaps.where("open").join(ended.select("workspace_id", "from_ts"), ["workspace_id", "from_ts"], "left_anti")
    cols = ["workspace_id", "from_ts", "to_ts", "open", F.coalesce("gap_us", F.lit(0).cast("long")).alias("gap_us")]
    return ended.select(cols).unionByName(still.select(cols))


def q_streak_stream(spark, sf):
    out = scratch_path(spark, "streaks")
    st = S.streak_stream(_event_stream(spark, sf), "failed", FAILURE_THRESHOLD)
    S.run_available(lambda: S.to_parquet_sink(st, out, scratch_path(spark, "ck")), spark=spark)
    return spark.read.parquet(out)


def q_admission_stream(spark, sf):
    out = scratch_path(spark, "admission")
    st = S.admission_stream(_event_stream(spark, sf, ["submitted", "completed"]),
                            "submitted", "completed", 2)
    S.run_available(lambda: S.to_parquet_sink(st, out, scratch_path(spark, "ck")), spark=spark)
    return spark.read.parquet(out)


QUERIES = {
    "parse_events": q_parse_events,
    "quarantine": q_quarantine,
    "retry_dead_letters": q_retry_dead_letters,
    "undelivered_stream": q_undelivered_stream,
    "dedup_events": q_dedup_events,
    "state_fold_stream": q_state_fold_stream,
    "progress_stream": q_progress_stream,
    "queue_depth_windows": q_queue_depth_windows,
    "missed_heartbeats": q_missed_heartbeats,
    "streak_stream": q_streak_stream,
    "admission_stream": q_admission_stream,
}

_GOOD = "SELECT * FROM events WHERE event_id % 97 <> 0"

ORACLE = {
    "parse_events": f"""{_GOOD} UNION ALL
SELECT * FROM events WHERE event_id % 97 <> 0 AND event_type = 'purchase'""",
    "quarantine": """SELECT CAST(user_id AS VARCHAR) AS key, '{"event_id":' AS original_payload, 'malformed JSON' AS error,
  'job.events.deadletter' AS topic FROM events WHERE event_id % 97 = 0
UNION ALL
SELECT CAST(user_id AS VARCHAR), '{"event_id":', 'malformed JSON', 'job.events.deadletter' FROM events
WHERE event_id % 97 = 0 AND event_type = 'purchase'""",
    # attempts 2 and 3 are made one and three minutes later, once the watermark is there
    "retry_dead_letters": """WITH w AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 DAY AS wm FROM events),
e AS (SELECT event_id AS id, event_type AS payload, date_trunc('milliseconds', ts) AS ts, event_id % 5 AS k FROM events)
SELECT id, payload, CAST(least(k + 1, 3) AS INTEGER) AS attempts, k < 3 AS delivered,
  CASE WHEN k >= 3 THEN 'attempt 3 failed' END AS error
FROM e, w WHERE k = 0 OR (k = 1 AND ts + INTERVAL 1 MINUTE <= wm) OR (k >= 2 AND ts + INTERVAL 3 MINUTE <= wm)""",
    "undelivered_stream": """WITH p AS (SELECT event_id, ts + to_minutes(CAST(event_id % 120 AS INTEGER)) AS sent FROM events WHERE event_type <> 'error'),
w AS (SELECT date_trunc('milliseconds', least((SELECT max(ts) FROM events), (SELECT max(sent) FROM p))) - INTERVAL 6 HOUR AS wm)
SELECT event_id AS id, ts AS created_at FROM events e, w WHERE ts + INTERVAL 1 DAY < wm
AND NOT EXISTS (SELECT 1 FROM p WHERE p.event_id = e.event_id AND p.sent BETWEEN e.ts AND e.ts + INTERVAL 1 DAY)""",
    "dedup_events": _GOOD,
    "state_fold_stream": ORD_ORACLE["current_state"].replace(
        "FROM events GROUP BY user_id", "FROM events WHERE event_id % 97 <> 0 GROUP BY user_id"),
    "progress_stream": """SELECT l_orderkey AS run_id, count(*) AS total,
  count(*) FILTER (WHERE l_returnflag <> 'R' AND l_linestatus <> 'F' AND l_returnflag <> 'A') AS pending,
  count(*) FILTER (WHERE l_returnflag = 'A' AND l_linestatus <> 'F') AS running,
  count(*) FILTER (WHERE l_returnflag <> 'R' AND l_linestatus = 'F') AS done,
  count(*) FILTER (WHERE l_returnflag = 'R') AS failed
FROM lineitem GROUP BY l_orderkey""",
    "queue_depth_windows": """WITH t AS (SELECT date_trunc('hour', ts) AS window_start,
  sum(CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN -1 WHEN 'click' THEN -1 ELSE 0 END) AS p,
  sum(CASE event_type WHEN 'view' THEN 1 WHEN 'purchase' THEN -1 WHEN 'error' THEN -1 ELSE 0 END) AS r FROM events GROUP BY 1)
SELECT window_start, CAST(sum(p) OVER (ORDER BY window_start) AS BIGINT) AS pending,
  CAST(sum(r) OVER (ORDER BY window_start) AS BIGINT) AS running FROM t""",
    "missed_heartbeats": f"""SELECT * FROM ({ORD_ORACLE["heartbeat_gaps"]}) WHERE NOT open
UNION ALL SELECT user_id, max(ts), NULL, true, 0 FROM events WHERE event_type = 'view' GROUP BY user_id
HAVING max(ts) + INTERVAL 1 DAY < (SELECT max(ts) FROM events WHERE event_type = 'view') - INTERVAL 1 DAY""",
    "streak_stream": ORD_ORACLE["failure_streaks"],
    "admission_stream": ORD_ORACLE["admission_check"],
}
