"""Run-history analytics over whole tables (F*, J*, A*, K*, U1).

Inputs use the platform column names (``id``, ``workspace_id``, ``run_id``,
``state``, ``created_at`` ...).  The reference answers these as point queries,
one entity at a time; here each is one job over all entities.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import as_of_ts, ntz_micros, older_than, percent_complete
from ..schemas import DURATION_BOUNDS
from ..session import materialize
from . import ordered


# ------------------------------------------------------------------ filters

def scoped_lookup(rows: DataFrame, requests: DataFrame, id_col: str = "id",
                  ws_col: str = "workspace_id") -> DataFrame:
    """rows whose (id, workspace) pair is requested -- tenant scoping is
    part of the match, so a row never leaks to another workspace."""
    # distinct first: a key requested many times is reduced map-side, so a hot
    # request key cannot skew the join
    return rows.join(requests.select(id_col, ws_col).distinct(), [id_col, ws_col], "left_semi")


def lookup_by_id(rows: DataFrame, ids: DataFrame, id_col: str = "id",
                 cols: list[str] | None = None) -> DataFrame:
    """rows (or some columns) for a set of requested ids."""
    out = rows.join(ids.select(id_col).distinct(), [id_col], "left_semi")
    return out.select(id_col, *cols) if cols else out


def state_older_than(rows: DataFrame, states, ts_col: str, as_of: str, interval: str,
                     state_col: str = "state") -> DataFrame:
    """rows in one of ``states`` whose ``ts_col`` is older than
    ``as_of - interval``."""
    states = [states] if isinstance(states, str) else list(states)
    return rows.where(F.col(state_col).isin(states) & older_than(ts_col, as_of, interval))


def claimable_tasks(tasks: DataFrame, as_of: str, lease_col: str = "lease_expires_at") -> DataFrame:
    """PENDING and (no lease or lease expired) -- three-valued logic kept."""
    return tasks.where((F.col("state") == "PENDING")
                       & (F.col(lease_col).isNull() | (F.col(lease_col) < as_of_ts(as_of))))


# -------------------------------------------------------------------- joins

def cascade_survivors(child: DataFrame, fk: str, removed: DataFrame, key: str) -> DataFrame:
    """Rows of ``child`` whose parent was not removed (ON DELETE CASCADE)."""
    return child.join(removed.select(F.col(key).alias(fk)).distinct(), [fk], "left_anti")


def removed_children(child: DataFrame, fk: str, removed: DataFrame, key: str,
                     child_key: str) -> DataFrame:
    """Keys of the child rows a cascade removes (input to the next level)."""
    return (child.join(removed.select(F.col(key).alias(fk)).distinct(), [fk], "left_semi")
            .select(child_key))


def cascade(tables: dict[str, DataFrame], keys: dict[str, str], links: list[tuple[str, str, str]],
            removed: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """J5 over any schema: for each table the keys of the rows that go when the rows of
    ``removed`` (table -> frame with its key column) go.

    ``keys``: key column of each table; ``links``: (child table, foreign key, parent table).
    Parents come before their children; a table that refers to itself is followed in
    rounds, each a table in the shared folder, until a round finds nothing new, so a
    chain may have any length.  Null foreign keys refer to nothing.  Circles of several
    tables are refused."""
    waiting, done = list(tables), {}
    while waiting:
        ready = [t for t in waiting if all(p in done or p == t for c, _, p in links if c == t)]
        if not ready:
            raise ValueError(f"tables refer to each other in a circle: {waiting}")
        for name in ready:
            key, rows = keys[name], tables[name]
            gone = [removed[name].select(key)] if name in removed else []
            for child, fk, parent in links:
                if child == name and parent != name:
                    lost = done[parent].select(F.col(keys[parent]).alias(fk))
                    gone.append(rows.join(lost, fk, "left_semi").select(key))
            found = (reduce(DataFrame.unionByName, gone) if gone else rows.select(key).where(F.lit(False))).distinct()
            own = [fk for child, fk, parent in links if child == name and parent == name]
            if own:
                found = fresh = materialize(found, "cascade")
                while not fresh.isEmpty():
                    below = [rows.join(fresh.select(F.col(key).alias(fk)), fk, "left_semi").select(key) for fk in own]
                    fresh = materialize(reduce(DataFrame.unionByName, below).distinct().join(found, key, "left_anti"), "cascade")
                    found = found.unionByName(fresh)
            done[name] = found
            waiting.remove(name)
    return done


def artifacts_by_job(artifacts: DataFrame, runs: DataFrame, jobs: DataFrame | None = None,
                     ts: str = "created_at", ids: list[str] = ["storage_path"], **chunk_opts) -> DataFrame:
    """Artifacts of the runs of the given jobs (``job_id``; all jobs without),
    with their position in the job's newest-first list."""
    r = runs.select(F.col("id").alias("run_id"), "job_id")
    if jobs is not None:
        r = r.join(jobs.select("job_id").distinct(), "job_id", "left_semi")
    return list_newest_first(artifacts.join(r, "run_id"), "job_id", ts, ids, **chunk_opts)


def dataset_of_job(jobs: DataFrame, datasets: DataFrame) -> DataFrame:
    """Jobs with their dataset (``dataset_id``)."""
    return jobs.join(datasets, "dataset_id")


def job_of_run(runs: DataFrame, jobs: DataFrame) -> DataFrame:
    """Runs with their job (``job_id``)."""
    return runs.join(jobs, "job_id")


def task_context(tasks: DataFrame, runs: DataFrame, jobs: DataFrame, datasets: DataFrame) -> DataFrame:
    """Task + run + job + dataset and the number of tasks in the run, for
    every task in one job.  Tasks are counted per run by partial aggregates, so a
    run with very many tasks is no window of one task."""
    n = tasks.join(runs.select("run_id"), "run_id", "left_semi").groupBy("run_id").agg(
        F.count(F.lit(1)).alias("tasks_in_run"))
    return (tasks.join(runs.join(n, "run_id"), "run_id").join(jobs, "job_id")
            .join(datasets, "dataset_id"))


def retry_eligibility(failed_tasks: DataFrame, runs: DataFrame, jobs: DataFrame,
                      error_kind: Column | None = None) -> DataFrame:
    """A failed task may retry when ``retry_count < max_retries`` of its
    job and the error is transient (all errors are, unless ``error_kind``
    says ``'permanent'``)."""
    kind = error_kind if error_kind is not None else F.lit("transient")
    t = (failed_tasks.join(runs.select(F.col("id").alias("run_id"), "job_id"), "run_id")
         .join(jobs.select(F.col("id").alias("job_id"), "max_retries"), "job_id"))
    return t.withColumn("can_retry", (F.col("retry_count") < F.col("max_retries"))
                        & (kind == F.lit("transient")))


# -------------------------------------------------------------- aggregates

def queue_depth(tasks: DataFrame) -> DataFrame:
    """A1: one pass; LEASED is what the reference reports as running, and
    RUNNING is kept apart (never set by the reference)."""
    s = F.col("state")
    return tasks.agg(F.count_if(s == "PENDING").alias("pending"),
                     F.count_if(s == "LEASED").alias("leased"),
                     F.count_if(s == "RUNNING").alias("running"))


def tasks_per_run(tasks: DataFrame) -> DataFrame:
    """A2."""
    return tasks.groupBy("run_id").agg(F.count(F.lit(1)).alias("task_count"))


def run_progress(runs: DataFrame, tasks: DataFrame) -> DataFrame:
    """A3 + A4: counters derived from task rows (no increment drift), for
    every run, runs without tasks included (total 0 -> 0 percent).

    Tasks are aggregated per run first (partial aggregation before the
    shuffle), then joined to the runs: the join sees one row per run."""
    s = F.col("state")
    counts = tasks.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(s == "PENDING").alias("pending"),
        F.count_if(s.isin("LEASED", "RUNNING")).alias("running"),
        F.count_if(s == "SUCCEEDED").alias("done"),
        F.count_if(s == "FAILED").alias("failed"))
    out = runs.select("id").join(counts.withColumnRenamed("run_id", "id"), "id", "left")
    out = out.fillna(0, ["total", "pending", "running", "done", "failed"])
    return out.withColumn("percent_complete", percent_complete("done", "total"))


def run_outcome_expr() -> Column:
    """A5: finished when done + failed = total (> 0): FAILED if any failed.
    DEAD tasks count in neither, so such runs stay open (null)."""
    fin = (F.col("total") > 0) & (F.col("done") + F.col("failed") == F.col("total"))
    return F.when(fin, F.when(F.col("failed") > 0, "FAILED").otherwise("SUCCEEDED"))


def run_outcome(progress: DataFrame) -> DataFrame:
    return progress.select("id", run_outcome_expr().alias("outcome"))


def job_outcome(runs: DataFrame, outcomes: DataFrame) -> DataFrame:
    """A job takes the outcome of its newest run."""
    latest = ordered.first_per_key(runs.select("job_id", "id", "created_at"), ["job_id"],
                                   ["created_at", "id"], ["id"], last=True)
    return (latest.join(outcomes, "id", "left")
            .select("job_id", F.col("id").alias("run_id"), "outcome"))


def tasks_processed(tasks: DataFrame) -> DataFrame:
    """Counter by final state."""
    return (tasks.where(F.col("state").isin("SUCCEEDED", "FAILED", "DEAD"))
            .groupBy(F.lower("state").alias("status")).agg(F.count(F.lit(1)).alias("n")))


def count_by_labels(df: DataFrame, labels: list[str]) -> DataFrame:
    """Counter by label values."""
    return df.groupBy(*labels).agg(F.count(F.lit(1)).alias("n"))


def duration_histogram(df: DataFrame, seconds: str, bounds=DURATION_BOUNDS,
                       money_scale: int | None = None) -> DataFrame:
    """Cumulative histogram (``le_<b>`` = count of d <= b, plus
    ``le_inf``), sum and count -- one aggregate, one row, no collect."""
    d = F.col(seconds)
    aggs = [F.count_if(d <= F.lit(b)).alias(f"le_{b}") for b in bounds]
    total = F.sum(d.cast(f"decimal(18,{money_scale})")) if money_scale is not None else F.sum(d)
    aggs += [F.count(d).alias("le_inf"), total.cast("double").alias("sum"),
             F.count(d).alias("count")]
    return df.agg(*aggs)


def gauge_series(deltas: DataFrame, ts: str, series: str, delta: str,
                 tick_seconds: int) -> DataFrame:
    """Gauge value at the end of each tick where it changed.

    Deltas are summed per (series, tick) first -- the big table is reduced by
    partial aggregation -- and that small tick table is written once,
    so the running sum scans it instead of the events.
    There are only a few series, so the running sum is the chunked scan:
    a long tick history is never sorted by one task per series."""
    return ordered.running_sum(_ticks(deltas, ts, series, delta, tick_seconds), ["series"], ["tick"], F.col("delta"), "value")


def _ticks(deltas: DataFrame, ts: str, series: str, delta: str, tick_seconds: int) -> DataFrame:
    tick = F.window(F.col(ts), f"{tick_seconds} seconds").start
    per_tick = deltas.groupBy(F.col(series).alias("series"), tick.alias("tick")).agg(
        F.sum(delta).cast("long").alias("delta"))
    return materialize(per_tick, "ticks")


#: ticks that one task makes of a series
TICKS_PER_CHUNK = 100_000


def sampled_gauges(deltas: DataFrame, ts: str, series: str, delta: str, tick_seconds: int,
                   ticks_per_chunk: int = TICKS_PER_CHUNK, **chunk_opts) -> DataFrame:
    """A11 as a poller sees it: the value of every series at every tick from the first to
    the last one of all series, whether it changed or not.

    The spine of ticks is made in chunks: of each series the starts of its chunks, dealt to
    tasks, and there the ticks.  Ticks without a delta add 0, and the running sum is the
    chunked scan, so a long history is nowhere one task's work."""
    per_tick = _ticks(deltas, ts, series, delta, tick_seconds)
    kind = per_tick.schema["tick"].dataType
    ends = per_tick.agg(F.min("tick").cast("string").alias("lo"), F.max("tick").cast("string").alias("hi")).first()
    if ends["lo"] is None:
        return per_tick.withColumn("value", F.lit(None).cast("long"))
    lo, hi = (F.lit(ends[x]).cast(kind) for x in ("lo", "hi"))
    step = F.make_dt_interval(secs=F.lit(float(tick_seconds)))
    chunk = F.make_dt_interval(secs=F.lit(float(tick_seconds * ticks_per_chunk)))
    last = F.make_dt_interval(secs=F.lit(float(tick_seconds * (ticks_per_chunk - 1))))
    spine = (per_tick.select("series").distinct()
             .select("series", F.explode(F.sequence(lo, hi, chunk)).alias("from"))
             .repartition("series", "from")
             .select("series", F.explode(F.sequence("from", F.least(F.col("from") + last, hi), step)).alias("tick")))
    dense = (spine.withColumn("delta", F.lit(0).cast("long")).unionByName(per_tick.select("series", "tick", "delta"))
             .groupBy("series", "tick").agg(F.sum("delta").alias("delta")))
    return ordered.running_sum(dense, ["series"], ["tick"], F.col("delta"), "value", **chunk_opts)


# ------------------------------------------------------------ sorts, top-k

def _newest_first(rows: DataFrame, ts: str) -> Column:
    dt, c = rows.schema[ts].dataType, F.col(ts)
    if isinstance(dt, T.TimestampNTZType):
        return -ntz_micros(c)
    if isinstance(dt, T.TimestampType):
        return -F.unix_micros(c)
    return -(F.unix_date(c) if isinstance(dt, T.DateType) else c)


def list_newest_first(rows: DataFrame, group: str, ts: str = "created_at",
                      id_col: str | list[str] = "id", out: str = "pos", **chunk_opts) -> DataFrame:
    """K1: position of each row in its group's newest-first list
    (``ts DESC, id ASC``), 1-based.  A hot group is split into chunks by
    time and id (see ``ordered``), so no task sorts one whole group, nor all rows of
    one day."""
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    t = rows.withColumn("_neg", _newest_first(rows, ts))
    return ordered.running_sum(t, [group], ["_neg", *ids], F.lit(1).cast("long"), out,
                               **chunk_opts).drop("_neg")


def in_run_order(tasks: DataFrame, out: str = "pos") -> DataFrame:
    """K2: rank of each task in its run by ``partition_index``.  A run has as
    many tasks as slices (a small, bounded number), so a plain window is
    right here."""
    w = Window.partitionBy("run_id").orderBy("partition_index")
    return tasks.withColumn(out, F.rank().over(w))


def oldest(rows: DataFrame, order_cols: list[str], k: int) -> DataFrame:
    """K3/K4: the ``k`` oldest rows -- a top-k (``TakeOrderedAndProject``:
    each partition keeps its own k, then one merge of k x partitions rows)."""
    return rows.orderBy(*order_cols).limit(k)


# --------------------------------------------------------------- set-like

def undelivered(outbox: DataFrame, published: DataFrame, key: str = "id") -> DataFrame:
    """Events written but never published."""
    return outbox.join(published.select(key).distinct(), [key], "left_anti")
