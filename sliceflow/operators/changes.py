"""Table changes re-aimed as jobs over an append-only change log (M1-M7).

The reference edits one PostgreSQL row at a time.  Here the facts are a log of
changes, and each job folds the log into the table it describes.  Results are
written to a new path, never edited in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import json_map, stable_id
from . import ordered


def current_state(log: DataFrame, key: str, order_cols: list[str],
                  value_cols: list[str], terminal: tuple[str, ...] | None = None,
                  state_col: str = "state") -> DataFrame:
    """M1: last write wins per ``key`` by ``order_cols`` (``max_by`` -- a
    partial aggregate, so a hot key is reduced map-side).

    ``terminal``: optional states that, once reached, are not overwritten by
    later changes (``terminal_sticky``); the reference does not guard this.
    """
    if terminal:
        # position of the first terminal change per key; later rows are dropped
        ordk = F.struct(*[F.col(c) for c in order_cols])
        first_term = (log.where(F.col(state_col).isin(list(terminal)))
                      .groupBy(key).agg(F.min(ordk).alias("_ft")))
        log = (log.join(first_term, key, "left")
                  .where(F.col("_ft").isNull() | (ordk <= F.col("_ft"))).drop("_ft"))
    return ordered.first_per_key(log, [key], order_cols, value_cols, last=True)


def validity(log: DataFrame, keys: list[str], ts: str, seq: str, **chunk_opts) -> DataFrame:
    """M1, intervals: every change with ``valid_from`` (its time) and ``valid_to`` (the
    time of the key's next change, null while it is in force)."""
    return ordered.next_value(log.withColumn("valid_from", F.col(ts)), keys, [ts, seq], ts, "valid_to", **chunk_opts)


def state_as_of(asked: DataFrame, log: DataFrame, keys: list[str], ts: str, seq: str,
                value_cols: list[str], **chunk_opts) -> DataFrame:
    """M1 at a point in time: each row of ``asked`` with the values of its key's last
    change at or before the row's time (of equal times that of the largest ``seq``); null
    before the first change.

    An as-of join as one scan: both tables in one sequence per key, changes before
    the rows of the same time, and the last change carried forward.  The sequence of
    a hot key is split into chunks (see ``ordered``).  ``asked`` has ``keys``,
    ``ts`` and columns other than ``value_cols``."""
    rest = [c for c in asked.columns if c not in (*keys, ts)]
    row = F.struct(*[F.col(c) for c in rest]) if rest else F.struct(F.lit(0).alias("_none"))
    row_type = asked.select(row.alias("r")).schema["r"].dataType
    change = F.struct(*[F.col(c) for c in value_cols])
    change_type = log.select(change.alias("s")).schema["s"].dataType
    seq_type = log.schema[seq].dataType
    both = (log.select(*keys, ts, F.lit(0).alias("_kind"), F.col(seq).alias("_seq"), change.alias("_change"),
                       F.lit(None).cast(row_type).alias("_asked"))
            .unionByName(asked.select(*keys, ts, F.lit(1).alias("_kind"), F.lit(None).cast(seq_type).alias("_seq"),
                                      F.lit(None).cast(change_type).alias("_change"), row.alias("_asked"))))
    found = ordered.last_known(both, keys, [ts, "_kind", "_seq"], F.col("_change"), "_state", **chunk_opts)
    return (found.where("_kind = 1")
            .select(*keys, ts, *[F.col(f"_asked.{c}").alias(c) for c in rest], *[F.col(f"_state.{c}").alias(c) for c in value_cols]))


def partial_update(base: DataFrame, updates: DataFrame, key: str, cols: list[str],
                   order_cols: list[str] | None = None) -> DataFrame:
    """M2: apply updates where a null means "keep the old value".

    Several updates of one id are folded first: for each column the last value
    that is not null, by ``order_cols``.  Without an order an id may have one
    update only; a second one is an error."""
    if order_cols:
        at = F.struct(*[F.col(c) for c in order_cols])
        folded = [F.max_by(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), at))
                  .alias(f"_new_{c}") for c in cols]
        u = updates.groupBy(key).agg(*folded)
    else:
        u = (updates.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(f"_new_{c}") for c in cols])
             .withColumn("_n", F.when(F.col("_n") > 1, F.raise_error(F.lit("an id has several updates without an order")))
                         .otherwise(F.col("_n"))))
        u = u.where(F.col("_n") == 1).drop("_n")
    out = base.join(u, key, "left")
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(f"_new_{c}"), F.col(c))).drop(f"_new_{c}")
    return out


def retention_counts(tables: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """M3 report: per table, rows kept and removed by its retention predicate
    (a null predicate keeps the row)."""
    parts = []
    for name, (df, pred) in tables.items():
        rm = F.coalesce(pred, F.lit(False))
        parts.append(df.agg(F.lit(name).alias("table_name"),
                            F.count_if(~rm).alias("kept"), F.count_if(rm).alias("removed")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def retention_apply(df: DataFrame, pred: Column, path: str, fmt: str = "parquet") -> str:
    """M3: write the rows the predicate keeps to a new path and return it."""
    df.where(~F.coalesce(pred, F.lit(False))).write.mode("errorifexists").format(fmt).save(path)
    return path


def delete_scoped(rows: DataFrame, requests: DataFrame, keys: list[str]) -> DataFrame:
    """M4: delete rows matching (id, scope) requests -- both keys must match."""
    return rows.join(requests.select(*keys).distinct(), keys, "left_anti")


def cancel_cascade(tasks: DataFrame, runs: DataFrame, cancelled_jobs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """M5: cancelling a job cancels its runs; their unfinished tasks end DEAD.

    Returns (runs, tasks) after the change, each in one pass."""
    cj = cancelled_jobs.select(F.col("id").alias("job_id")).distinct()
    runs2 = (runs.join(cj.withColumn("_cj", F.lit(True)), "job_id", "left")
             .withColumn("state", F.when(F.col("_cj"), F.lit("CANCELLED"))
                         .otherwise(F.col("state"))).drop("_cj"))
    cr = runs2.where(F.col("state") == "CANCELLED").select(F.col("id").alias("run_id"))
    fin = F.col("state").isin("SUCCEEDED", "FAILED", "DEAD")
    tasks2 = (tasks.join(cr.withColumn("_cr", F.lit(True)), "run_id", "left")
              .withColumn("state", F.when(F.col("_cr") & ~fin, F.lit("DEAD"))
                          .otherwise(F.col("state"))).drop("_cr"))
    return runs2, tasks2


def task_attempts(log: DataFrame, key: str, order_cols: list[str], failed: Column,
                  error: str) -> DataFrame:
    """M6: retries = number of failures; last error = error of the latest
    failure (``max_by``); one partial aggregate."""
    ordk = F.struct(*[F.col(c) for c in order_cols])
    return log.groupBy(key).agg(
        F.count_if(failed).alias("retry_count"),
        F.max_by(F.when(failed, F.col(error)), F.when(failed, ordk)).alias("last_error"))


def retried_tasks(log: DataFrame, key: str, order_cols: list[str], state: str, failed: Column,
                  error: str, lease_until: Column) -> DataFrame:
    """M6, the whole row: a task whose latest change is a failure waits again
    (PENDING, no lease) with its error kept; another has the state and lease of
    its latest change.  One partial aggregate."""
    at = F.struct(*[F.col(c) for c in order_cols])
    last = F.max_by(F.struct(F.coalesce(failed, F.lit(False)).alias("f"), F.col(state).alias("s"),
                             lease_until.alias("l")), at)
    out = log.groupBy(key).agg(
        F.count_if(failed).alias("retry_count"), last.alias("_last"),
        F.max_by(F.when(failed, F.col(error)), F.when(failed, at)).alias("last_error"))
    return out.select(key, "retry_count", "last_error",
                      F.when(F.col("_last.f"), F.lit("PENDING")).otherwise(F.col("_last.s")).alias("state"),
                      F.when(~F.col("_last.f"), F.col("_last.l")).alias("lease_expires_at"))


def submit_with_event(jobs: DataFrame, event_type: str = "job.submitted") -> tuple[DataFrame, DataFrame]:
    """M7: the job rows and their outbox events from one projection.

    The event id is derived from the job id, so a replay makes the same
    event and downstream dedup removes it."""
    payload = F.to_json(F.struct(F.col("id").cast("string").alias("job_id"),
                                 F.col("workspace_id").cast("string").alias("workspace_id")))
    ev = jobs.select(stable_id(F.lit(event_type), F.col("id")).alias("event_id"),
                     F.lit(event_type).alias("event_type"),
                     F.col("id").cast("string").alias("aggregate_id"),
                     payload.alias("payload"), F.lit("PENDING").alias("status"))
    return jobs, ev


def parse_payload(events: DataFrame) -> DataFrame:
    """Outbox payload -> (job_id, workspace_id) through the string map."""
    m = json_map("payload")
    return events.select("event_id", "event_type", "aggregate_id",
                         F.try_element_at(m, F.lit("job_id")).alias("job_id"),
                         F.try_element_at(m, F.lit("workspace_id")).alias("workspace_id"))
