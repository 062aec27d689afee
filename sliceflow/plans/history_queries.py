"""Registered run-history queries (F*, J*, A*, K*, U1) over the driver tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import artifact_key, json_field
from ..operators import history as H
from . import views

OAS = views.ORDERS_AS_OF
EAS = views.EVENTS_AS_OF


def datasets(spark, sf):
    """orders as datasets: P -> INITIATED, F -> READY, O -> UPLOADING."""
    o = views.table(spark, sf, "orders")
    st = (F.when(F.col("o_orderstatus") == "P", "INITIATED")
          .when(F.col("o_orderstatus") == "F", "READY").otherwise("UPLOADING"))
    return o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("workspace_id"),
                    st.alias("state"), F.col("o_orderdate").alias("created_at"))


def outbox(spark, sf):
    """events as outbox rows: error -> FAILED, click -> PENDING, else DELIVERED
    (published at the event time)."""
    e = views.table(spark, sf, "events")
    st = (F.when(F.col("event_type") == "error", "FAILED")
          .when(F.col("event_type") == "click", "PENDING").otherwise("DELIVERED"))
    return e.select(F.col("event_id").alias("id"), F.col("user_id").alias("aggregate_id"),
                    st.alias("status"), F.col("ts").alias("created_at"),
                    F.when(st == "DELIVERED", F.col("ts")).alias("published_at"))


def tasks_with_lease(spark, sf):
    """tasks; odd line numbers hold a lease of 30 s from their ship date."""
    t = views.tasks(spark, sf)
    lease = F.when(F.col("partition_index") % 2 == 1,
                   F.col("created_at") + F.expr("INTERVAL 30 SECONDS"))
    return t.withColumn("lease_expires_at", lease)


def q_scoped_lookup(spark, sf):
    req = views.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"),
                                                    F.col("l_partkey").alias("workspace_id"))
    return H.scoped_lookup(views.runs(spark, sf), req)


def q_lookup_by_id(spark, sf):
    ids = (views.table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R")
           .select(F.col("l_orderkey").alias("id")))
    return H.lookup_by_id(views.runs(spark, sf), ids, "id", ["state"])


def q_stale_rows(spark, sf):
    return H.state_older_than(datasets(spark, sf), "INITIATED", "created_at", OAS, "24 HOURS")


def q_dead_rows(spark, sf):
    t = views.tasks(spark, sf).select("run_id", "partition_index", "state", "created_at")
    return H.state_older_than(t, ["DEAD", "FAILED"], "created_at", OAS, "7 DAYS")


def q_delivered_rows(spark, sf):
    return H.state_older_than(outbox(spark, sf), "DELIVERED", "published_at", EAS, "24 HOURS",
                              state_col="status").select("id", "published_at")


def q_claimable_tasks(spark, sf):
    return (H.claimable_tasks(tasks_with_lease(spark, sf), OAS)
            .select("run_id", "partition_index", "created_at", "lease_expires_at"))


def artifacts(spark, sf):
    li = views.table(spark, sf, "lineitem")
    return li.select(F.col("l_orderkey").alias("run_id"),
                     F.concat(F.lit("partition-"), F.col("l_linenumber").cast("string"), F.lit(".csv")).alias("name"),
                     artifact_key("l_orderkey", "l_linenumber").alias("storage_path"),
                     F.col("l_quantity").cast("long").alias("size_bytes"),
                     F.col("l_shipdate").alias("created_at"))


def q_artifacts_by_job(spark, sf):
    """J1 for the jobs of customers in debt, newest first in each job."""
    jobs = views.table(spark, sf, "customer").where(F.col("c_acctbal") < 0).select(
        F.col("c_custkey").alias("job_id"))
    return H.artifacts_by_job(artifacts(spark, sf), views.runs(spark, sf), jobs,
                              ids=["storage_path", "size_bytes"])


def q_dataset_of_job(spark, sf):
    jobs = views.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber",
                                                     F.col("l_partkey").alias("dataset_id"))
    ds = views.table(spark, sf, "part").select(F.col("p_partkey").alias("dataset_id"),
                                               F.col("p_name").alias("dataset_name"),
                                               F.col("p_size").alias("dataset_size"))
    return H.dataset_of_job(jobs, ds)


def q_job_of_run(spark, sf):
    r = views.runs(spark, sf).select(F.col("id").alias("run_id"), "job_id")
    j = views.workspaces(spark, sf).select(F.col("id").alias("job_id"),
                                           F.col("name").alias("job_name"), "plan")
    return H.job_of_run(r, j)


def q_task_context(spark, sf):
    """J4; a job's dataset is its customer's nation."""
    t = views.tasks(spark, sf).select("run_id", "partition_index")
    r = views.runs(spark, sf).select(F.col("id").alias("run_id"), "job_id")
    c = views.table(spark, sf, "customer").select(F.col("c_custkey").alias("job_id"),
                                                  F.col("c_name").alias("job_name"),
                                                  F.col("c_nationkey").alias("dataset_id"))
    n = views.table(spark, sf, "nation").select(F.col("n_nationkey").alias("dataset_id"),
                                                F.col("n_name").alias("dataset_name"))
    return H.task_context(t, r, c, F.broadcast(n)).drop("dataset_id")


def q_cascade_survivors(spark, sf):
    """Delete region 0 and cascade to nations, customers and orders."""
    reg = views.table(spark, sf, "region").where(F.col("r_regionkey") == 0)
    gone_n = H.removed_children(views.table(spark, sf, "nation"), "n_regionkey", reg,
                                "r_regionkey", "n_nationkey")
    gone_c = H.removed_children(views.table(spark, sf, "customer"), "c_nationkey", gone_n,
                                "n_nationkey", "c_custkey")
    o = views.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return H.cascade_survivors(o, "o_custkey", gone_c, "c_custkey")


def q_retry_eligibility(spark, sf):
    t = (views.tasks(spark, sf).where(F.col("state") == "FAILED")
         .select("run_id", "partition_index", "retry_count"))
    jobs = views.workspaces(spark, sf).select("id", F.lit(3).alias("max_retries"))
    return H.retry_eligibility(t, views.runs(spark, sf), jobs).select(
        "run_id", "partition_index", "retry_count", "max_retries", "can_retry")


def q_queue_depth(spark, sf):
    return H.queue_depth(views.tasks(spark, sf))


def q_tasks_per_run(spark, sf):
    return H.tasks_per_run(views.tasks(spark, sf))


def q_run_progress(spark, sf):
    return H.run_progress(views.runs(spark, sf), views.tasks(spark, sf))


def q_run_outcome(spark, sf):
    return H.run_outcome(H.run_progress(views.runs(spark, sf), views.tasks(spark, sf)))


def q_job_outcome(spark, sf):
    runs = views.runs(spark, sf)
    return H.job_outcome(runs, H.run_outcome(H.run_progress(runs, views.tasks(spark, sf))))


def q_tasks_processed(spark, sf):
    return H.tasks_processed(views.tasks(spark, sf))


def q_requests_by_label(spark, sf):
    e = views.table(spark, sf, "events")
    k = json_field("props", "k").try_cast("int")
    lab = e.select(F.col("event_type").alias("method"),
                   F.concat(F.lit("/k"), (k % 3).cast("string")).alias("path"),
                   F.when(F.col("value") > 10, 500).otherwise(200).alias("status"))
    return H.count_by_labels(lab, ["method", "path", "status"])


def q_duration_histogram(spark, sf):
    return H.duration_histogram(views.table(spark, sf, "events"), "value", money_scale=2)


def q_jobs_totals(spark, sf):
    """A10: one aggregate over the union of the three sources (no join)."""
    e = views.job_events(spark, sf).select(F.col("kind").alias("src"))
    r = views.table(spark, sf, "orders").select(F.lit("run").alias("src"))
    t = views.table(spark, sf, "lineitem").select(F.lit("task").alias("src"))
    s = F.col("src")
    return e.unionByName(r).unionByName(t).agg(
        F.count_if(s == "submitted").alias("jobs_submitted"),
        F.count_if(s == "cancelled").alias("jobs_cancelled"),
        F.count_if(s == "run").alias("runs_created"),
        F.count_if(s == "task").alias("tasks_created"))


def gauge_deltas(spark, sf):
    """submitted: pending +1; heartbeat: pending -1, running +1;
    completed / failed / cancelled: running -1."""
    e = views.job_events(spark, sf)
    k = F.col("kind")
    pend = F.when(k == "submitted", 1).when(k == "heartbeat", -1)
    run = F.when(k == "heartbeat", 1).when(k.isin("completed", "failed", "cancelled"), -1)
    d = e.select("ts", F.explode(F.array(
        F.struct(F.lit("pending").alias("series"), pend.alias("delta")),
        F.struct(F.lit("running").alias("series"), run.alias("delta")))).alias("d"))
    return d.select("ts", "d.series", "d.delta").where(F.col("delta").isNotNull())


def q_pending_running_gauges(spark, sf):
    return H.gauge_series(gauge_deltas(spark, sf), "ts", "series", "delta", 3600)


def q_sampled_gauges(spark, sf):
    """Every hour of every series, also those in which nothing changed."""
    return H.sampled_gauges(gauge_deltas(spark, sf), "ts", "series", "delta", 3600)


CASCADE_LINKS = [("nation", "n_regionkey", "region"), ("customer", "c_nationkey", "nation"), ("supplier", "s_nationkey", "nation"),
                 ("orders", "o_custkey", "customer"), ("lineitem", "l_orderkey", "orders"), ("lineitem", "l_suppkey", "supplier")]


def q_cascade_tables(spark, sf):
    """J5 from a region down to the line items: rows that go and stay in every table."""
    keys = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "orders": "o_orderkey", "lineitem": "l_id"}
    tables = {t: views.table(spark, sf, t) for t in keys if t != "lineitem"}
    # order and line are not unique together: lines that share them go or stay together
    li = views.table(spark, sf, "lineitem").withColumn("l_id", F.struct("l_orderkey", "l_suppkey", "l_linenumber"))
    gone = H.cascade({**tables, "lineitem": li}, keys, CASCADE_LINKS, {"region": tables["region"].where("r_name = 'ASIA'")})
    parts = []
    for t, df in {**tables, "lineitem": li}.items():
        marked = df.join(gone[t].withColumn("_gone", F.lit(True)), keys[t], "left")
        parts.append(marked.agg(F.lit(t).alias("table_name"), F.count_if(F.col("_gone").isNull()).alias("kept"), F.count_if("_gone").alias("removed")))
    return reduce(DataFrame.unionByName, parts)


def q_list_newest_first(spark, sf):
    r = views.runs(spark, sf).select("workspace_id", "id", "created_at")
    return H.list_newest_first(r, "workspace_id", "created_at", "id")


def q_tasks_in_order(spark, sf):
    return H.in_run_order(views.tasks(spark, sf).select("run_id", "partition_index", "state"))


def q_oldest_pending_events(spark, sf):
    ob = outbox(spark, sf).where(F.col("status") == "PENDING")
    return H.oldest(ob.select("id", "aggregate_id", "created_at"), ["created_at", "id"], 10)


def q_oldest_claimable_task(spark, sf):
    c = H.claimable_tasks(tasks_with_lease(spark, sf), OAS).select(
        "run_id", "partition_index", "created_at")
    return H.oldest(c, ["created_at", "run_id", "partition_index"], 1)


def q_list_owned(spark, sf):
    owners = views.table(spark, sf, "supplier").select(F.col("s_nationkey").alias("owner_id"))
    return views.workspaces(spark, sf).join(owners, "owner_id", "left_semi").select(
        "owner_id", "id", "name")


def q_undelivered_events(spark, sf):
    e = views.table(spark, sf, "events")
    ob = e.select(F.col("event_id").alias("id"), F.col("ts").alias("created_at"))
    pub = e.where(F.col("event_type") != "error").select(F.col("event_id").alias("id"))
    return H.undelivered(ob, pub, "id")


QUERIES = {
    "scoped_lookup": q_scoped_lookup,
    "lookup_by_id": q_lookup_by_id,
    "stale_rows": q_stale_rows,
    "dead_rows": q_dead_rows,
    "delivered_rows": q_delivered_rows,
    "claimable_tasks": q_claimable_tasks,
    "artifacts_by_job": q_artifacts_by_job,
    "dataset_of_job": q_dataset_of_job,
    "job_of_run": q_job_of_run,
    "task_context": q_task_context,
    "cascade_survivors": q_cascade_survivors,
    "retry_eligibility": q_retry_eligibility,
    "queue_depth": q_queue_depth,
    "tasks_per_run": q_tasks_per_run,
    "run_progress": q_run_progress,
    "run_outcome": q_run_outcome,
    "job_outcome": q_job_outcome,
    "tasks_processed": q_tasks_processed,
    "requests_by_label": q_requests_by_label,
    "duration_histogram": q_duration_histogram,
    "jobs_totals": q_jobs_totals,
    "pending_running_gauges": q_pending_running_gauges,
    "sampled_gauges": q_sampled_gauges,
    "cascade_tables": q_cascade_tables,
    "list_newest_first": q_list_newest_first,
    "tasks_in_order": q_tasks_in_order,
    "oldest_pending_events": q_oldest_pending_events,
    "oldest_claimable_task": q_oldest_claimable_task,
    "list_owned": q_list_owned,
    "undelivered_events": q_undelivered_events,
}

# ---------------------------------------------------------------- oracles

RUNS = """runs AS (SELECT o_orderkey AS id, o_custkey AS job_id, o_custkey AS workspace_id,
  CASE WHEN o_orderstatus = 'F' THEN 'SUCCEEDED' WHEN o_orderstatus = 'O' THEN 'RUNNING'
       ELSE 'CANCELLED' END AS state, o_orderdate AS created_at FROM orders)"""
TASKS = """tasks AS (SELECT l_orderkey AS run_id, l_linenumber AS partition_index,
  CASE WHEN l_returnflag = 'R' THEN 'FAILED' WHEN l_linestatus = 'F' THEN 'SUCCEEDED'
       WHEN l_returnflag = 'A' THEN 'LEASED' ELSE 'PENDING' END AS state,
  l_shipdate AS created_at, l_linenumber - 1 AS retry_count,
  CASE WHEN l_linenumber % 2 = 1 THEN l_shipdate + INTERVAL 30 SECOND END AS lease_expires_at
  FROM lineitem)"""
PROGRESS = f"""{RUNS}, {TASKS},
progress AS (SELECT r.id, count(t.run_id) AS total,
  count(*) FILTER (WHERE t.state = 'PENDING') AS pending,
  count(*) FILTER (WHERE t.state IN ('LEASED', 'RUNNING')) AS running,
  count(*) FILTER (WHERE t.state = 'SUCCEEDED') AS done,
  count(*) FILTER (WHERE t.state = 'FAILED') AS failed
  FROM runs r LEFT JOIN tasks t ON t.run_id = r.id GROUP BY r.id),
outcome AS (SELECT id, CASE WHEN total > 0 AND done + failed = total
  THEN CASE WHEN failed > 0 THEN 'FAILED' ELSE 'SUCCEEDED' END END AS outcome FROM progress)"""
DELTAS = """d AS (
  SELECT ts, 'pending' AS series, CASE WHEN event_type = 'signup' THEN 1
         WHEN event_type = 'view' THEN -1 END AS delta FROM events
  UNION ALL
  SELECT ts, 'running' AS series, CASE WHEN event_type = 'view' THEN 1
         WHEN event_type IN ('purchase', 'error', 'click') THEN -1 END AS delta FROM events)"""

ORACLE = {
    "scoped_lookup": f"""WITH {RUNS}
SELECT * FROM runs r WHERE EXISTS (SELECT 1 FROM lineitem l
  WHERE l.l_orderkey = r.id AND l.l_partkey = r.workspace_id)""",
    "lookup_by_id": f"""WITH {RUNS}
SELECT id, state FROM runs WHERE id IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
    "stale_rows": """SELECT o_orderkey AS id, o_custkey AS workspace_id, 'INITIATED' AS state,
  o_orderdate AS created_at FROM orders
WHERE o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '2001-08-02 00:00:00' - INTERVAL 24 HOUR""",
    "dead_rows": f"""WITH {TASKS}
SELECT run_id, partition_index, state, created_at FROM tasks
WHERE state IN ('DEAD', 'FAILED') AND created_at < TIMESTAMP '2001-08-02 00:00:00' - INTERVAL 7 DAY""",
    "delivered_rows": """SELECT event_id AS id, ts AS published_at FROM events
WHERE event_type NOT IN ('error', 'click')
  AND ts < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 24 HOUR""",
    "claimable_tasks": f"""WITH {TASKS}
SELECT run_id, partition_index, created_at, lease_expires_at FROM tasks
WHERE state = 'PENDING' AND (lease_expires_at IS NULL
  OR lease_expires_at < TIMESTAMP '2001-08-02 00:00:00')""",
    "artifacts_by_job": """SELECT l.l_orderkey AS run_id, 'partition-' || l.l_linenumber || '.csv' AS name,
  'artifacts/' || l.l_orderkey || '/partition-' || l.l_linenumber || '.csv' AS storage_path,
  CAST(l.l_quantity AS BIGINT) AS size_bytes, l.l_shipdate AS created_at, o.o_custkey AS job_id,
  row_number() OVER (PARTITION BY o.o_custkey ORDER BY l.l_shipdate DESC,
    'artifacts/' || l.l_orderkey || '/partition-' || l.l_linenumber || '.csv', CAST(l.l_quantity AS BIGINT)) AS pos
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
WHERE o.o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
    "dataset_of_job": """SELECT l.l_partkey AS dataset_id, l.l_orderkey, l.l_linenumber,
  p.p_name AS dataset_name, p.p_size AS dataset_size
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey""",
    "job_of_run": """SELECT o.o_custkey AS job_id, o.o_orderkey AS run_id, c.c_name AS job_name,
  CASE WHEN c.c_mktsegment = 'BUILDING' THEN 'enterprise'
       WHEN c.c_mktsegment = 'MACHINERY' THEN 'pro' ELSE 'free' END AS plan
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey""",
    "task_context": """SELECT l.l_orderkey AS run_id, l.l_linenumber AS partition_index,
  count(*) OVER (PARTITION BY l.l_orderkey) AS tasks_in_run,
  o.o_custkey AS job_id, c.c_name AS job_name, n.n_name AS dataset_name
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey""",
    "cascade_survivors": """SELECT o_orderkey, o_custkey FROM orders o WHERE NOT EXISTS (
  SELECT 1 FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
  WHERE c.c_custkey = o.o_custkey AND n.n_regionkey = 0)""",
    "retry_eligibility": """SELECT l_orderkey AS run_id, l_linenumber AS partition_index,
  l_linenumber - 1 AS retry_count, 3 AS max_retries, (l_linenumber - 1) < 3 AS can_retry
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
JOIN customer c ON c.c_custkey = o.o_custkey
WHERE l_returnflag = 'R'""",
    "queue_depth": f"""WITH {TASKS}
SELECT count(*) FILTER (WHERE state = 'PENDING') AS pending,
  count(*) FILTER (WHERE state = 'LEASED') AS leased,
  count(*) FILTER (WHERE state = 'RUNNING') AS running FROM tasks""",
    "tasks_per_run": "SELECT l_orderkey AS run_id, count(*) AS task_count FROM lineitem GROUP BY 1",
    "run_progress": f"""WITH {PROGRESS}
SELECT *, CASE WHEN total = 0 THEN 0.0 ELSE CAST(ROUND(CAST(done AS DECIMAL(20,0)) * 100
  / CAST(total AS DECIMAL(20,0)), 0) AS DOUBLE) END AS percent_complete FROM progress""",
    "run_outcome": f"WITH {PROGRESS} SELECT * FROM outcome",
    "job_outcome": f"""WITH {PROGRESS},
latest AS (SELECT job_id, arg_max(id, (created_at, id)) AS run_id FROM runs GROUP BY job_id)
SELECT l.job_id, l.run_id, o.outcome FROM latest l LEFT JOIN outcome o ON o.id = l.run_id""",
    "tasks_processed": f"""WITH {TASKS}
SELECT lower(state) AS status, count(*) AS n FROM tasks
WHERE state IN ('SUCCEEDED', 'FAILED', 'DEAD') GROUP BY 1""",
    "requests_by_label": """SELECT event_type AS method,
  '/k' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 AS VARCHAR) AS path,
  CASE WHEN value > 10 THEN 500 ELSE 200 END AS status, count(*) AS n
FROM events GROUP BY ALL""",
    "duration_histogram": """SELECT
  count(*) FILTER (WHERE value <= 1) AS le_1, count(*) FILTER (WHERE value <= 5) AS le_5,
  count(*) FILTER (WHERE value <= 10) AS le_10, count(*) FILTER (WHERE value <= 30) AS le_30,
  count(*) FILTER (WHERE value <= 60) AS le_60, count(*) FILTER (WHERE value <= 120) AS le_120,
  count(*) FILTER (WHERE value <= 300) AS le_300, count(value) AS le_inf,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS sum, count(value) AS count
FROM events""",
    "jobs_totals": """SELECT
  (SELECT count(*) FROM events WHERE event_type = 'signup') AS jobs_submitted,
  (SELECT count(*) FROM events WHERE event_type = 'click') AS jobs_cancelled,
  (SELECT count(*) FROM orders) AS runs_created,
  (SELECT count(*) FROM lineitem) AS tasks_created""",
    "pending_running_gauges": f"""WITH {DELTAS},
t AS (SELECT series, date_trunc('hour', ts) AS tick, CAST(sum(delta) AS BIGINT) AS delta
      FROM d WHERE delta IS NOT NULL GROUP BY 1, 2)
SELECT series, tick, delta, CAST(sum(delta) OVER (PARTITION BY series ORDER BY tick) AS BIGINT) AS value
FROM t""",
    "cascade_tables": """WITH n AS (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'),
c AS (SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT * FROM n)), s AS (SELECT s_suppkey FROM supplier WHERE s_nationkey IN (SELECT * FROM n)),
o AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT * FROM c)),
l AS (SELECT l_orderkey IN (SELECT * FROM o) OR l_suppkey IN (SELECT * FROM s) AS gone FROM lineitem)
SELECT 'region' AS table_name, count(*) FILTER (WHERE r_name <> 'ASIA') AS kept, count(*) FILTER (WHERE r_name = 'ASIA') AS removed FROM region
UNION ALL SELECT 'nation', (SELECT count(*) FROM nation) - count(*), count(*) FROM n
UNION ALL SELECT 'customer', (SELECT count(*) FROM customer) - count(*), count(*) FROM c
UNION ALL SELECT 'supplier', (SELECT count(*) FROM supplier) - count(*), count(*) FROM s
UNION ALL SELECT 'orders', (SELECT count(*) FROM orders) - count(*), count(*) FROM o
UNION ALL SELECT 'lineitem', count(*) FILTER (WHERE NOT gone), count(*) FILTER (WHERE gone) FROM l""",
    "sampled_gauges": f"""WITH {DELTAS},
t AS (SELECT series, date_trunc('hour', ts) AS tick, CAST(sum(delta) AS BIGINT) AS delta
      FROM d WHERE delta IS NOT NULL GROUP BY 1, 2),
spine AS (SELECT series, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS tick
          FROM (SELECT DISTINCT series FROM t), (SELECT min(tick) AS lo, max(tick) AS hi FROM t))
SELECT s.series, s.tick, coalesce(t.delta, 0) AS delta,
  CAST(sum(coalesce(t.delta, 0)) OVER (PARTITION BY s.series ORDER BY s.tick) AS BIGINT) AS value
FROM spine s LEFT JOIN t ON t.series = s.series AND t.tick = s.tick""",
    "list_newest_first": f"""WITH {RUNS}
SELECT workspace_id, id, created_at,
  row_number() OVER (PARTITION BY workspace_id ORDER BY created_at DESC, id) AS pos FROM runs""",
    "tasks_in_order": f"""WITH {TASKS}
SELECT run_id, partition_index, state,
  CAST(rank() OVER (PARTITION BY run_id ORDER BY partition_index) AS INTEGER) AS pos FROM tasks""",
    "oldest_pending_events": """SELECT event_id AS id, user_id AS aggregate_id, ts AS created_at
FROM events WHERE event_type = 'click' ORDER BY ts, event_id LIMIT 10""",
    "oldest_claimable_task": f"""WITH {TASKS}
SELECT run_id, partition_index, created_at FROM tasks
WHERE state = 'PENDING' AND (lease_expires_at IS NULL
  OR lease_expires_at < TIMESTAMP '2001-08-02 00:00:00')
ORDER BY created_at, run_id, partition_index LIMIT 1""",
    "list_owned": """SELECT c_nationkey AS owner_id, c_custkey AS id, c_name AS name FROM customer
WHERE c_nationkey IN (SELECT s_nationkey FROM supplier)""",
    "undelivered_events": """SELECT event_id AS id, ts AS created_at FROM events e
WHERE NOT EXISTS (SELECT 1 FROM events p WHERE p.event_id = e.event_id AND p.event_type <> 'error')""",
}
