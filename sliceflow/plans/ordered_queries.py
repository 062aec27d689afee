"""Registered per-key ordered queries (W1-W7) and table-change jobs (M1-M7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import as_of_ts, json_field, ntz_micros
from ..operators import changes as M
from ..operators import ordered as W
from ..schemas import FAILURE_THRESHOLD, LEASE_SECONDS
from . import views
from .history_queries import datasets, outbox

EAS = views.EVENTS_AS_OF
GAP = "24 HOURS"
GAP_US = 24 * 3600 * 1_000_000
LIMIT = 2
ORDER = ["ts", "event_id"]


def _gap_us(a, b):
    return ntz_micros(b) - ntz_micros(a)


def q_latest_run_per_job(spark, sf):
    r = views.runs(spark, sf)
    return W.first_per_key(r, ["job_id"], ["created_at", "id"], ["id", "created_at", "state"],
                           last=True).withColumnRenamed("id", "run_id")


def q_heartbeat_gaps(spark, sf):
    """Gaps longer than the limit between heartbeats of a key, plus the
    open gap from the last heartbeat to ``as_of``."""
    e = (views.table(spark, sf, "events").where(F.col("event_type") == "view")  # pushed to the scan
         .select(F.col("user_id").alias("workspace_id"), "event_id", "ts"))
    prev = W.previous_value(e, ["workspace_id"], ORDER, "ts", "prev_ts")
    closed = (prev.where(F.col("prev_ts").isNotNull())
              .select("workspace_id", F.col("prev_ts").alias("from_ts"), F.col("ts").alias("to_ts"),
                      F.lit(False).alias("open"))
              .withColumn("gap_us", _gap_us("from_ts", "to_ts"))
              .where(F.col("gap_us") > GAP_US))
    last = (W.first_per_key(e, ["workspace_id"], ORDER, ["ts"], last=True)
            .select("workspace_id", F.col("ts").alias("from_ts"), as_of_ts(EAS).alias("to_ts"),
                    F.lit(True).alias("open"))
            .withColumn("gap_us", _gap_us("from_ts", "to_ts"))
            .where(F.col("gap_us") > GAP_US))
    return closed.unionByName(last)


def q_failure_streaks(spark, sf):
    e = views.job_events(spark, sf).select("workspace_id", "event_id", "ts", "kind")
    s = W.true_streak(e, ["workspace_id"], ORDER, F.col("kind") == "failed", "streak")
    return s.where(F.col("streak") >= FAILURE_THRESHOLD).select("workspace_id", "event_id", "ts", "streak")


def q_running_jobs_counter(spark, sf):
    e = views.job_events(spark, sf).select("workspace_id", "event_id", "ts", "kind")
    return W.running_jobs(e, "workspace_id", ORDER)


def q_admission_check(spark, sf):
    e = (views.job_events(spark, sf).where(F.col("kind").isin("submitted", "completed"))
         .select("workspace_id", "event_id", "ts", "kind"))
    return W.admission_fold(e, ["workspace_id"], ORDER, F.col("kind") == "submitted",
                            F.col("kind") == "completed", LIMIT).select(
        "workspace_id", "event_id", "running_before", "admitted")


def q_first_by_idempotency_key(spark, sf):
    """First submission per key; rows without a key are never duplicates."""
    k = F.get_json_object("props", "$.k").try_cast("long")
    e = (views.table(spark, sf, "events").select(k.alias("k"), "event_id", "ts")
         .withColumn("idempotency_key", F.when(F.col("k") % 10 != 0, F.col("k")))
         # a row without a key is a group of its own
         .withColumn("own", F.when(F.col("idempotency_key").isNull(), F.col("event_id"))))
    return W.first_per_key(e, ["idempotency_key", "own"], ORDER, ["event_id", "ts"]).drop("own")


def q_first_start(spark, sf):
    t = views.tasks(spark, sf)
    return t.groupBy("run_id").agg(F.min("created_at").alias("started_at"))


def q_current_state(spark, sf):
    e = views.job_events(spark, sf).select("workspace_id", "event_id", "ts",
                                           F.col("kind").alias("state"))
    return M.current_state(e, "workspace_id", ORDER, ["state", "ts", "event_id"]).select(
        "workspace_id", "state", F.col("ts").alias("updated_at"),
        F.col("event_id").alias("last_event_id"))


def q_state_as_of(spark, sf):
    """State of the workspace at each of its heartbeats, from the log of all other events."""
    e = views.job_events(spark, sf).select("workspace_id", "ts", "event_id", "kind")
    log = e.where("kind <> 'heartbeat'").withColumnsRenamed({"event_id": "change_id", "kind": "state"}).withColumn("since", F.col("ts"))
    asked = e.where("kind = 'heartbeat'").select("workspace_id", "ts", "event_id")
    return M.state_as_of(asked, log, ["workspace_id"], "ts", "change_id", ["state", "since", "change_id"])


def q_state_intervals(spark, sf):
    """Validity of every change but heartbeats."""
    log = views.job_events(spark, sf).where("kind <> 'heartbeat'").select("workspace_id", "ts", "event_id", F.col("kind").alias("state"))
    return M.validity(log, ["workspace_id"], "ts", "event_id").drop("ts")


def q_partial_update(spark, sf):
    ws = views.workspaces(spark, sf)
    c = views.table(spark, sf, "customer").where(F.col("c_mktsegment") == "AUTOMOBILE")
    upd = c.select(F.col("c_custkey").alias("id"),
                   F.when(F.col("c_acctbal") >= 0, F.upper("c_name")).alias("name"),
                   F.lit("enterprise").alias("plan"))
    # a second, later change of some, that keeps the plan
    more = c.where(F.col("c_custkey") % 3 == 0).select(
        F.col("c_custkey").alias("id"), F.lower("c_name").alias("name"), F.lit(None).cast("string").alias("plan"))
    both = upd.withColumn("seq", F.lit(1)).unionByName(more.withColumn("seq", F.lit(2)))
    return M.partial_update(ws, both, "id", ["name", "plan"], ["seq"])


def q_retention(spark, sf):
    from ..functions.exprs import older_than

    ds = datasets(spark, sf)
    t = views.tasks(spark, sf)
    ob = outbox(spark, sf)
    return M.retention_counts({
        "datasets": (ds, (F.col("state") == "INITIATED")
                     & older_than("created_at", views.ORDERS_AS_OF, "24 HOURS")),
        "tasks": (t, F.col("state").isin("DEAD", "FAILED")
                  & older_than("created_at", views.ORDERS_AS_OF, "7 DAYS")),
        "outbox": (ob, (F.col("status") == "DELIVERED")
                   & older_than("published_at", EAS, "24 HOURS")),
    })


def q_delete_scoped(spark, sf):
    req = views.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"),
                                                    F.col("s_nationkey").alias("owner_id"))
    return M.delete_scoped(views.workspaces(spark, sf).select("id", "owner_id"), req,
                           ["id", "owner_id"])


def q_cancel_cascade(spark, sf):
    """Jobs = customers; the customers with an order in status P are cancelled."""
    o = views.table(spark, sf, "orders")
    cj = o.where(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("id"))
    runs = views.runs(spark, sf).select("id", "job_id", "state")
    tasks = views.tasks(spark, sf).select("run_id", "partition_index", "state")
    r2, t2 = M.cancel_cascade(tasks, runs, cj)
    none = F.lit(None).cast("int")
    return (t2.select(F.lit("tasks").alias("table_name"), "run_id", F.col("partition_index").cast("int").alias("partition_index"), "state")
            .unionByName(r2.select(F.lit("runs").alias("table_name"), F.col("id").alias("run_id"), none.alias("partition_index"), "state")))


def q_task_attempts(spark, sf):
    e = views.job_events(spark, sf)
    lease = F.col("ts") + F.expr(f"INTERVAL {LEASE_SECONDS} SECONDS")
    return M.retried_tasks(e, "workspace_id", ORDER, "kind", F.col("kind") == "failed", "props", lease)


def q_submit_with_event(spark, sf):
    jobs = views.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"),
                                                   F.col("o_custkey").alias("workspace_id"))
    _, ev = M.submit_with_event(jobs)
    return M.parse_payload(ev)


QUERIES = {
    "latest_run_per_job": q_latest_run_per_job,
    "heartbeat_gaps": q_heartbeat_gaps,
    "failure_streaks": q_failure_streaks,
    "running_jobs_counter": q_running_jobs_counter,
    "admission_check": q_admission_check,
    "first_by_idempotency_key": q_first_by_idempotency_key,
    "first_start": q_first_start,
    "current_state": q_current_state,
    "state_as_of": q_state_as_of,
    "state_intervals": q_state_intervals,
    "partial_update": q_partial_update,
    "retention": q_retention,
    "delete_scoped": q_delete_scoped,
    "cancel_cascade": q_cancel_cascade,
    "task_attempts": q_task_attempts,
    "submit_with_event": q_submit_with_event,
}

KIND = """CASE event_type WHEN 'signup' THEN 'submitted' WHEN 'purchase' THEN 'completed'
  WHEN 'error' THEN 'failed' WHEN 'view' THEN 'heartbeat' WHEN 'click' THEN 'cancelled' END"""

ORACLE = {
    "latest_run_per_job": """SELECT o_custkey AS job_id,
  arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS run_id,
  max(o_orderdate) AS created_at,
  arg_max(CASE WHEN o_orderstatus = 'F' THEN 'SUCCEEDED' WHEN o_orderstatus = 'O' THEN 'RUNNING'
               ELSE 'CANCELLED' END, (o_orderdate, o_orderkey)) AS state
FROM orders GROUP BY o_custkey""",
    "heartbeat_gaps": """WITH v AS (SELECT user_id AS workspace_id, event_id, ts,
    lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_ts FROM events
    WHERE event_type = 'view'),
g AS (SELECT workspace_id, prev_ts AS from_ts, ts AS to_ts, false AS open FROM v WHERE prev_ts IS NOT NULL
      UNION ALL
      SELECT workspace_id, max(ts), TIMESTAMP '2024-01-31 00:00:00', true FROM v GROUP BY workspace_id)
SELECT *, date_diff('microsecond', from_ts, to_ts) AS gap_us FROM g
WHERE date_diff('microsecond', from_ts, to_ts) > 86400000000""",
    "failure_streaks": """WITH e AS (SELECT user_id AS workspace_id, event_id, ts, event_type = 'error' AS f,
    sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id
      ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS g FROM events),
s AS (SELECT *, CASE WHEN f THEN row_number() OVER (PARTITION BY workspace_id, g ORDER BY ts, event_id)
      - CASE WHEN g > 0 THEN 1 ELSE 0 END ELSE 0 END AS streak FROM e)
SELECT workspace_id, event_id, ts, streak FROM s WHERE streak >= 3""",
    "running_jobs_counter": f"""SELECT user_id AS workspace_id, event_id, ts, {KIND} AS kind,
  CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE -1 END) OVER (PARTITION BY user_id
    ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running
FROM events WHERE event_type IN ('signup', 'purchase')""",
    "admission_check": """WITH RECURSIVE e AS (
  SELECT user_id, event_id, event_type,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events WHERE event_type IN ('signup', 'purchase')),
r AS (
  SELECT user_id, rn, event_id, event_type, CAST(0 AS BIGINT) AS before,
         CAST(CASE WHEN event_type = 'signup' THEN 1 ELSE -1 END AS BIGINT) AS after
  FROM e WHERE rn = 1
  UNION ALL
  SELECT e.user_id, e.rn, e.event_id, e.event_type, r.after,
         CASE WHEN e.event_type = 'signup' THEN CASE WHEN r.after < 2 THEN r.after + 1 ELSE r.after END
              ELSE r.after - 1 END
  FROM r JOIN e ON e.user_id = r.user_id AND e.rn = r.rn + 1)
SELECT user_id AS workspace_id, event_id, before AS running_before,
  CASE WHEN event_type = 'signup' THEN before < 2 END AS admitted FROM r""",
    "first_by_idempotency_key": """WITH e AS (SELECT CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 <> 0
    THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS idempotency_key, event_id, ts FROM events)
SELECT idempotency_key, arg_min(event_id, (ts, event_id)) AS event_id, min(ts) AS ts
FROM e WHERE idempotency_key IS NOT NULL GROUP BY 1
UNION ALL SELECT * FROM e WHERE idempotency_key IS NULL""",
    "first_start": "SELECT l_orderkey AS run_id, min(l_shipdate) AS started_at FROM lineitem GROUP BY 1",
    "current_state": f"""SELECT user_id AS workspace_id,
  arg_max({KIND}, (ts, event_id)) AS state, max(ts) AS updated_at,
  arg_max(event_id, (ts, event_id)) AS last_event_id FROM events GROUP BY user_id""",
    "state_as_of": f"""WITH c AS (SELECT user_id, ts, arg_max({KIND}, event_id) AS state, max(event_id) AS change_id
           FROM events WHERE event_type <> 'view' GROUP BY user_id, ts)
SELECT v.user_id AS workspace_id, v.ts, v.event_id, c.state, c.ts AS since, c.change_id
FROM (SELECT user_id, ts, event_id FROM events WHERE event_type = 'view') v
ASOF LEFT JOIN c ON c.user_id = v.user_id AND v.ts >= c.ts""",
    "state_intervals": f"""SELECT user_id AS workspace_id, event_id, {KIND} AS state, ts AS valid_from,
  lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to FROM events WHERE event_type <> 'view'""",
    "partial_update": """SELECT c_custkey AS id, c_nationkey AS owner_id,
  CASE WHEN c_mktsegment = 'AUTOMOBILE' AND c_custkey % 3 = 0 THEN lower(c_name)
       WHEN c_mktsegment = 'AUTOMOBILE' AND c_acctbal >= 0 THEN upper(c_name) ELSE c_name END AS name,
  CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'enterprise'
       WHEN c_mktsegment = 'BUILDING' THEN 'enterprise'
       WHEN c_mktsegment = 'MACHINERY' THEN 'pro' ELSE 'free' END AS plan
FROM customer""",
    "retention": """SELECT 'datasets' AS table_name,
  count(*) FILTER (WHERE NOT (o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '2001-08-01 00:00:00')) AS kept,
  count(*) FILTER (WHERE o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '2001-08-01 00:00:00') AS removed
FROM orders
UNION ALL
SELECT 'tasks',
  count(*) FILTER (WHERE NOT (l_returnflag = 'R' AND l_shipdate < TIMESTAMP '2001-07-26 00:00:00')),
  count(*) FILTER (WHERE l_returnflag = 'R' AND l_shipdate < TIMESTAMP '2001-07-26 00:00:00')
FROM lineitem
UNION ALL
SELECT 'outbox',
  count(*) FILTER (WHERE NOT (event_type NOT IN ('error', 'click') AND ts < TIMESTAMP '2024-01-30 00:00:00')),
  count(*) FILTER (WHERE event_type NOT IN ('error', 'click') AND ts < TIMESTAMP '2024-01-30 00:00:00')
FROM events""",
    "delete_scoped": """SELECT c_custkey AS id, c_nationkey AS owner_id FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = c.c_custkey AND s.s_nationkey = c.c_nationkey)""",
    "cancel_cascade": """WITH cj AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P'),
cr AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P' OR o_custkey IN (SELECT o_custkey FROM cj)),
t AS (SELECT l_orderkey AS run_id, l_linenumber AS partition_index,
  CASE WHEN l_returnflag = 'R' THEN 'FAILED' WHEN l_linestatus = 'F' THEN 'SUCCEEDED'
       WHEN l_returnflag = 'A' THEN 'LEASED' ELSE 'PENDING' END AS state FROM lineitem)
SELECT 'tasks' AS table_name, run_id, CAST(partition_index AS INTEGER) AS partition_index,
  CASE WHEN run_id IN (SELECT o_orderkey FROM cr) AND state NOT IN ('SUCCEEDED', 'FAILED', 'DEAD')
       THEN 'DEAD' ELSE state END AS state FROM t
UNION ALL SELECT 'runs', o_orderkey, NULL,
  CASE WHEN o_custkey IN (SELECT o_custkey FROM cj) THEN 'CANCELLED' WHEN o_orderstatus = 'F' THEN 'SUCCEEDED'
       WHEN o_orderstatus = 'O' THEN 'RUNNING' ELSE 'CANCELLED' END FROM orders""",
    "task_attempts": f"""SELECT user_id AS workspace_id, count(*) FILTER (WHERE event_type = 'error') AS retry_count,
  arg_max(props, (ts, event_id)) FILTER (WHERE event_type = 'error') AS last_error,
  CASE WHEN arg_max(event_type, (ts, event_id)) = 'error' THEN 'PENDING'
       ELSE arg_max({KIND}, (ts, event_id)) END AS state,
  CASE WHEN arg_max(event_type, (ts, event_id)) <> 'error' THEN max(ts) + INTERVAL 30 SECONDS END AS lease_expires_at
FROM events GROUP BY user_id""",
    "submit_with_event": """SELECT sha256(concat_ws(chr(1), 'job.submitted', CAST(o_orderkey AS VARCHAR))) AS event_id,
  'job.submitted' AS event_type, CAST(o_orderkey AS VARCHAR) AS aggregate_id,
  CAST(o_orderkey AS VARCHAR) AS job_id, CAST(o_custkey AS VARCHAR) AS workspace_id FROM orders""",
}
