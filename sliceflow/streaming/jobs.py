"""Event-stream jobs (T1-T9) on Structured Streaming.

All of them take a streaming DataFrame (Kafka in a deployment, a file folder
offline) and write to a sink under a checkpoint location, so a restarted or
retried query resumes exactly where it stopped.

Stateful per-key logic uses ``applyInPandasWithState``: Spark keeps the small
per-key state in its state store and hands each key's rows of one
micro-batch to one call.  Rows of a batch are sorted by ``(ts, event_id)``
inside the call, because a batch is not ordered; rows older than the last
row already folded into the state are ignored (the reference has no late-data
rule, this one is documented).
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from ..functions.exprs import ntz_micros
from ..operators import changes as M
from ..operators import ordered
from ..operators.ordered import add_chunks
from ..sources.topics import JSON_TS

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


#: attempts before a message goes to the dead letters
MAX_ATTEMPTS = 3


# ------------------------------------------------------------ event time

def event_time(c: str) -> Column:
    """A ``timestamp`` column for watermarks from a ``timestamp_ntz`` one,
    reading the wall-clock value as UTC.  Built from epoch microseconds, so
    it does not depend on the session time zone."""
    return F.timestamp_micros(ntz_micros(F.col(c)))


def wall_clock(c: Column) -> Column:
    """Inverse of ``event_time``: back to ``timestamp_ntz``."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), epoch)


# ------------------------------------------------------------ replay source

#: rows in a file of a replayed table, about
ROWS_PER_FILE = 250_000


def files_per_batch(df: DataFrame, batches: int) -> int:
    """Files that each of ``batches`` micro-batches of ``df`` has, so that a file has about
    ``ROWS_PER_FILE`` rows at any size: ``maxFilesPerTrigger`` of the stream."""
    return max(1, math.ceil(df.count() / batches / ROWS_PER_FILE))


def whole_chunks(chunked: DataFrame, batches: int, chunk_col: str = "_c") -> list[DataFrame]:
    """The rows of each micro-batch, ``batches`` at most: whole chunks, in their order."""
    last = chunked.agg(F.max(chunk_col)).first()[0]
    n = 0 if last is None else max(batches, last + 1)
    at = [n * i // batches for i in range(batches + 1)]
    # ranges of the chunk column, so that a scan leaves out the files of other chunks
    return [chunked.where(F.col(chunk_col).between(lo, hi - 1)).drop(chunk_col)
            for lo, hi in zip(at, at[1:]) if last is not None and lo <= last]


def write_in_order(parts: list[DataFrame], path: str, files: int = 1) -> str:
    """Write exactly ``files`` parquet files for each part, one write per part so
    file times follow the order (a file stream source takes the oldest files first, and
    with ``maxFilesPerTrigger`` = ``files`` each micro-batch is one part).

    A write reads its own part and is done by ``files`` tasks; a part too small
    for so many gets empty files."""
    for i, part in enumerate(parts):
        part.repartition(files).write.mode("append").parquet(path)
        if files > 1:
            there = len(part.sparkSession.read.schema(part.schema).parquet(path).inputFiles())
            for _ in range(files * (i + 1) - there):
                part.limit(0).repartition(1).write.mode("append").parquet(path)
    return path


def replay_files(df: DataFrame, path: str, order_col: str, batches: int, files: int = 1) -> str:
    """Replay a table as ``batches`` times ``files`` parquet files, in ``order_col`` order from
    batch to batch (balanced time ranges from global quantiles)."""
    return write_in_order(whole_chunks(add_chunks(df, order_col, min_chunks=batches), batches), path, files)


#: state on the executors' disks, with a bounded part of it in memory
LARGE_STATE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
               "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
               # rows of the state are not counted: that is a lookup for every write
               "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
               "spark.sql.streaming.stateStore.rocksdb.blockCacheSizeMB": "64"}


def run_available(query_builder: Callable[[], object], spark: SparkSession | None = None,
                  state_partitions: int | None = None, large_state: bool = False) -> None:
    """Start a query built with ``trigger(availableNow=True)`` and wait.

    A stateful query fixes its number of state partitions when it first
    starts (it is stored in the checkpoint), from
    ``spark.sql.shuffle.partitions``.  With ``spark`` given, that setting is
    ``state_partitions`` (default: the cluster's default parallelism) while
    the query starts, and restored right after: the query keeps its own copy
    of the session settings.  ``large_state`` (with ``spark``): a state that grows
    with the input is kept in RocksDB, not in the executors' heaps.
    """
    if spark is None:
        q = query_builder()
    else:
        n = state_partitions or max(1, spark.sparkContext.defaultParallelism)
        settings = {"spark.sql.shuffle.partitions": str(n), **(LARGE_STATE if large_state else {})}
        old = {key: spark.conf.get(key, None) for key in settings}
        try:
            for key, value in settings.items():
                spark.conf.set(key, value)
            q = query_builder()
        finally:
            for key, value in old.items():
                spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


# -------------------------------------------------------- T1, T2, T3 parse

def parse_events(records: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """JSON value -> typed event.  Errors: text that is not one JSON object
    (something after it included) or holds a value of another type; a
    missing id, time or user; an unknown event type."""
    whole = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", **JSON_TS}
    parsed = records.select("key", "value", "topic", F.from_json("value", whole, options).alias("w"),
                            F.size(F.from_json(F.concat(F.lit("["), "value", F.lit("]")), "array<map<string,string>>")).alias("n"))
    parsed = parsed.withColumn("e", F.when(F.col("w").isNotNull(), F.struct(*[F.col(f"w.{f.name}").alias(f.name) for f in schema.fields])))
    err = (F.when(F.col("w").isNull() | F.col("w._bad").isNotNull() | ~F.coalesce(F.col("n") == 1, F.lit(False)), F.lit("malformed JSON"))
           .when(F.col("e.event_id").isNull() | F.col("e.ts").isNull() | F.col("e.user_id").isNull(), F.lit("missing field"))
           .when(~F.coalesce(F.col("e.event_type").isin(list(EVENT_TYPES)), F.lit(False)),
                 F.lit("unknown event type")))
    return parsed.withColumn("error", err).drop("w", "n")


def good_events(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("error").isNull()).select("e.*")


def dead_letters(parsed: DataFrame) -> DataFrame:
    """``<topic>.deadletter`` rows: original payload, error, topic."""
    return parsed.where(F.col("error").isNotNull()).select(
        F.col("key"), F.col("value").alias("original_payload"), "error",
        F.concat(F.col("topic"), F.lit(".deadletter")).alias("topic"))


def split_sinks(parsed: DataFrame, good_path: str, dead_path: str, checkpoint: str):
    """One stream, two sinks; each micro-batch is written to both in
    ``foreachBatch`` (batch id in the path keeps a replay idempotent). The payload
    is kept for the rows that go to the dead letters alone."""
    parsed = parsed.withColumn("value", F.when(F.col("error").isNotNull(), F.col("value")))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            good_events(batch).write.mode("overwrite").parquet(f"{good_path}/batch={batch_id}")
            dead_letters(batch).write.mode("overwrite").parquet(f"{dead_path}/batch={batch_id}")
        finally:
            batch.unpersist()

    return (parsed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


ATTEMPT_OUT = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("payload", T.StringType()),
    T.StructField("attempts", T.IntegerType()),
    T.StructField("delivered", T.BooleanType()),
    T.StructField("error", T.StringType()),
])
# Per bucket: parallel arrays, an entry for each message that waits for its next attempt.
WAITING_STATE = T.StructType([
    T.StructField("ids", T.ArrayType(T.LongType())),
    T.StructField("payloads", T.ArrayType(T.StringType())),
    T.StructField("attempts", T.ArrayType(T.IntegerType())),
    T.StructField("due_ms", T.ArrayType(T.LongType())),
])


def deliver_with_retries(messages: DataFrame, handler: Callable[[pd.DataFrame], list], delay: str,
                         max_attempts: int = MAX_ATTEMPTS, backoff_ms: int = 60_000, buckets: int | None = None) -> DataFrame:
    """T2, transient failures: ``handler(frame)`` gets messages (id, payload, attempt from 1)
    and gives an error text or None for each.  A message that fails waits in the state
    and is tried again ``attempt * backoff_ms`` of event time later; after the last attempt it
    is given up with its error.

    ``messages``: (id, payload, ts).  One row per message once it is delivered or given up:
    (id, payload, attempts, delivered, error).  Only messages that have failed are
    state; a null id or payload is handled like others.  Attempts are due by the
    watermark, so a replay gives the same rows."""

    def fn(bkey, pdfs, state):
        wm = state.getCurrentWatermarkMs()
        waiting = list(zip(*state.get)) if state.exists else []
        turn = [(i, p, n + 1, due) for i, p, n, due in waiting if due <= wm]
        waiting = [x for x in waiting if x[3] > wm]
        if not state.hasTimedOut:
            for pdf in pdfs:
                ids = [None if pd.isna(x) else int(x) for x in pdf["id"]]
                times = pdf["_wts"].to_numpy("datetime64[ms]").astype("int64").tolist()
                turn += [(i, None if pd.isna(p) else p, 1, t) for i, p, t in zip(ids, pdf["payload"], times)]
        done = []
        while turn:
            frame = pd.DataFrame({"id": pd.array([x[0] for x in turn], dtype="Int64"), "payload": [x[1] for x in turn], "attempt": [x[2] for x in turn]})
            again = []
            for (i, p, n, at), error in zip(turn, handler(frame)):
                due = at + n * backoff_ms
                if error is None or n >= max_attempts:
                    done.append((i, p, n, error is None, error))
                elif due <= wm:
                    again.append((i, p, n + 1, due))
                else:
                    waiting.append((i, p, n, due))
            turn = again
        if waiting:
            state.update(tuple(list(x) for x in zip(*waiting)))
            state.setTimeoutTimestamp(min(x[3] for x in waiting))
        elif state.exists:
            state.remove()
        if done:
            out = pd.DataFrame(done, columns=ATTEMPT_OUT.names)
            yield out.astype({"id": "Int64"})

    t = (_bucketed(messages.select("id", "payload", "ts"), "id", buckets)
         .withColumn("_wts", event_time("ts")).withWatermark("_wts", delay).drop("ts"))
    return t.groupBy("_bucket").applyInPandasWithState(
        fn, ATTEMPT_OUT, WAITING_STATE, "append", GroupStateTimeout.EventTimeTimeout)


def undelivered_stream(outbox: DataFrame, published: DataFrame, horizon: str, delay: str) -> DataFrame:
    """U1 on streams: (id, created_at) of outbox rows of which no publication came in the
    ``horizon`` after them.  ``outbox``: (id, created_at), ``published``: (id, published_at).

    A left outer join of two streams with a watermark each: both sides keep rows for
    the horizon only, and a row is reported once the watermark is past it.  Rows without
    an id have no publication."""
    made = outbox.select(F.col("id").alias("_id"), "created_at", event_time("created_at").alias("_made")).withWatermark("_made", delay)
    sent = published.select(F.col("id").alias("_sent_id"), event_time("published_at").alias("_sent")).withWatermark("_sent", delay)
    on = (F.col("_id") == F.col("_sent_id")) & (F.col("_sent") >= F.col("_made")) & (F.col("_sent") <= F.col("_made") + F.expr(f"INTERVAL {horizon}"))
    return made.join(sent, on, "left_outer").where(F.col("_sent_id").isNull()).select(F.col("_id").alias("id"), "created_at")


def dedup_events(events: DataFrame, delay: str, key: str = "event_id",
                 ts: str = "ts") -> DataFrame:
    """Drop redelivered copies (same event id) arriving within ``delay``."""
    return (events.withColumn("_wts", event_time(ts))
            .withWatermark("_wts", delay)
            .dropDuplicatesWithinWatermark([key]).drop("_wts"))


# ------------------------------------------------------- T4 state fold

def state_fold(events: DataFrame, state_path: str, checkpoint: str, key: str,
               order_cols: list[str], value_cols: list[str]):
    """T4: M1 per micro-batch.  New state = last write wins over (stored
    state U batch); each version is written to its own folder, which also
    cuts the lineage.  Returns the started query; ``latest_state`` reads
    the newest version."""

    def fold(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        prev = latest_state_version(spark, state_path, before=batch_id)
        cur = batch.select(key, *value_cols)
        if prev is not None:
            cur = spark.read.parquet(prev).select(key, *value_cols).unionByName(cur)
        out = M.current_state(cur, key, order_cols, value_cols)
        out.write.mode("overwrite").parquet(f"{state_path}/v={batch_id:012d}")

    return (events.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def latest_state_version(spark: SparkSession, state_path: str,
                         before: int | None = None) -> str | None:
    """Newest version folder of a folded state (file listing only).

    ``before``: only versions older than this batch id.  A batch starts after
    the previous batch committed, so those versions are complete even when
    the current batch is a retry over its own half-written folder."""
    try:
        files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
                 .option("recursiveFileLookup", True).load(state_path).select("path"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None  # no folder yet: no state yet
    v = F.regexp_extract("path", r"/v=(\d+)/[^/]+$", 1).cast("long")
    if before is not None:
        files = files.where(v < F.lit(before))
    r = files.select(F.max(v).alias("v")).first()
    return f"{state_path}/v={r['v']:012d}" if r and r["v"] is not None else None


def state_fold_incremental(events: DataFrame, log_path: str, checkpoint: str, key: str,
                           order_cols: list[str], value_cols: list[str]):
    """T4, incremental form: a streaming ``max_by`` aggregate in update mode.

    The latest value per key lives in the state store; each micro-batch
    writes only the keys it changed to an upsert log (``upsert_log``), so a
    batch costs what it carries, not the size of the whole state.  Read the
    current state with ``latest_rows``.  ``state_fold`` is the snapshot form:
    it rewrites the full state per batch, which is simpler to read but costs
    O(state) per batch."""
    ordk = F.struct(*[F.col(c) for c in order_cols])
    rec = F.struct(*[F.col(c) for c in value_cols])
    agg = (events.groupBy(key).agg(F.max_by(rec, ordk).alias("_r"))
           .select(key, *[F.col(f"_r.{c}").alias(c) for c in value_cols]))
    return upsert_log(agg, log_path, checkpoint)


# ------------------------------------------------ T6, T7 upsert-log sinks

def upsert_log(agg: DataFrame, path: str, checkpoint: str):
    """Write an update-mode aggregate as a log: each micro-batch's changed
    rows go to ``path/batch=<id>``; ``latest_rows`` picks the newest row per
    key.  Only changed rows are written per batch (not the whole table)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id:012d}")

    return (agg.writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def latest_rows(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    log = spark.read.parquet(path)
    cols = [c for c in log.columns if c not in keys and c != "batch"]
    rec = F.struct(*[F.col(c) for c in cols])
    return (log.groupBy(*keys).agg(F.max_by(rec, F.col("batch")).alias("_r"))
            .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in cols]))


def latest_task_states(changes: DataFrame, order_cols: list[str]) -> DataFrame:
    """T6, the stream: the latest (run_id, state) of every task (update mode,
    for ``upsert_log``).  A task that goes through several states counts once."""
    at = F.struct(*[F.col(c) for c in order_cols])
    return (changes.groupBy("task_id").agg(F.max_by(F.struct("run_id", "state"), at).alias("_r"))
            .select("task_id", "_r.run_id", "_r.state"))


def progress(tasks: DataFrame) -> DataFrame:
    """Run counters of the tasks' latest states."""
    s = F.col("state")
    return tasks.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(s == "PENDING").alias("pending"),
        F.count_if(s.isin("LEASED", "RUNNING")).alias("running"),
        F.count_if(s == "SUCCEEDED").alias("done"),
        F.count_if(s == "FAILED").alias("failed"))


def windowed_counts(events: DataFrame, ts: str, group: str, width: str,
                    delay: str) -> DataFrame:
    """Counts per tumbling window and group; rows later than the
    watermark are dropped."""
    t = events.withColumn("_wts", event_time(ts)).withWatermark("_wts", delay)
    return (t.groupBy(F.window("_wts", width).alias("w"), F.col(group))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(wall_clock(F.col("w.start")).alias("window_start"), group, "n"))


def depth_per_tick(deltas: DataFrame, tick: str, values: list[str]) -> DataFrame:
    """Gauges at the end of each tick from their changes in it: running sums
    over the small table of ticks (``ordered.running_sum``, chunked)."""
    t = deltas.withColumn("_all", F.lit(0))
    for v in values:
        t = ordered.running_sum(t, ["_all"], [tick], F.col(v), f"_{v}").drop(v).withColumnRenamed(f"_{v}", v)
    return t.drop("_all")


def windowed_sums(events: DataFrame, ts: str, values: dict[str, Column], width: str, delay: str) -> DataFrame:
    """Sums per tumbling window; rows later than the watermark are dropped."""
    t = events.withColumn("_wts", event_time(ts)).withWatermark("_wts", delay)
    return (t.groupBy(F.window("_wts", width).alias("w"))
            .agg(*[F.sum(v).cast("long").alias(k) for k, v in values.items()])
            .select(wall_clock(F.col("w.start")).alias("window_start"), *values))


# ------------------------------------------------- T5, T8, T9 per-key state

STREAK_OUT = T.StructType([
    T.StructField("workspace_id", T.LongType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("streak", T.LongType()),
])
ADMIT_OUT = T.StructType([
    T.StructField("workspace_id", T.LongType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("running_before", T.LongType()),
    T.StructField("admitted", T.BooleanType()),
])
# Per-bucket state: parallel arrays, one entry per key of the bucket.
BUCKET_STATE = T.StructType([
    T.StructField("keys", T.ArrayType(T.LongType())),
    T.StructField("last_us", T.ArrayType(T.LongType())),
    T.StructField("last_id", T.ArrayType(T.LongType())),
    T.StructField("value", T.ArrayType(T.LongType())),
])
# State groups for each core of the cluster at the first start, when the caller
# gives no number.  It is part of the checkpoint: give it when a stream goes on
# elsewhere; about active keys / 1000 for large key spaces.
STATE_BUCKETS_PER_CORE = 16
_BIG = np.iinfo("int64").max


def _bucketed(events: DataFrame, key: str, buckets: int | None) -> DataFrame:
    if buckets is None:
        buckets = STATE_BUCKETS_PER_CORE * max(1, events.sparkSession.sparkContext.defaultParallelism)
    # a null key has a bucket of its own
    return events.withColumn("_bucket", F.when(F.col(key).isNull(), F.lit(NULL_BUCKET)).otherwise(F.pmod(F.xxhash64(F.col(key)), F.lit(buckets))))


NULL_BUCKET = -1


def _named(k, bkey):
    """Keys of a bucket as they were: null in the bucket of the null key."""
    return pd.array([pd.NA] * len(k), dtype="Int64") if bkey[0] == NULL_BUCKET else k


def _load_bucket(pdfs, state, key: str, bkey):
    """Rows of one bucket for one batch, sorted by (key, ts, event_id), with
    each row's carried state; rows not newer than their key's state are late
    and dropped.  Returns (rows, seg, first, carry, keys, table)."""
    parts = list(pdfs)
    pdf = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
    k = np.zeros(len(pdf), dtype="int64") if bkey[0] == NULL_BUCKET else pdf[key].to_numpy("int64")
    us = pdf["ts"].to_numpy("datetime64[us]").astype("int64")
    eid = pdf["event_id"].to_numpy("int64")
    order = np.lexsort((eid, us, k))
    pdf = pdf.iloc[order].reset_index(drop=True)
    k, us, eid = k[order], us[order], eid[order]
    if state.exists:
        st = state.get
        table = pd.DataFrame({"last_us": st[1], "last_id": st[2], "value": st[3]},
                             index=pd.Index(st[0], dtype="int64"))
    else:
        table = pd.DataFrame({"last_us": pd.Series(dtype="int64"),
                              "last_id": pd.Series(dtype="int64"),
                              "value": pd.Series(dtype="int64")},
                             index=pd.Index([], dtype="int64"))
    pos = table.index.get_indexer(k)  # -1 for a key without state
    lo = np.iinfo("int64").min
    # each array gets a sentinel at the end, which position -1 picks
    last_us = np.r_[table["last_us"].to_numpy("int64"), lo][pos]
    last_id = np.r_[table["last_id"].to_numpy("int64"), lo][pos]
    keep = (us > last_us) | ((us == last_us) & (eid > last_id))
    pdf, k, us, eid, pos = pdf[keep].reset_index(drop=True), k[keep], us[keep], eid[keep], pos[keep]
    carry = np.r_[table["value"].to_numpy("int64"), 0][pos]
    first = np.ones(len(k), dtype=bool)
    first[1:] = k[1:] != k[:-1]
    seg = np.cumsum(first) - 1
    return pdf, k, us, eid, seg, first, carry, table


def _store_bucket(state, table: pd.DataFrame, k, us, eid, seg, new_value) -> None:
    """Write back the state of every key seen in this batch (its last row)."""
    if len(k):
        last = np.r_[np.nonzero(np.diff(seg))[0], len(seg) - 1]
        upd = pd.DataFrame({"last_us": us[last], "last_id": eid[last],
                            "value": np.asarray(new_value, dtype="int64")},
                           index=pd.Index(k[last], dtype="int64"))
        table = pd.concat([table[~table.index.isin(upd.index)], upd])
    state.update((table.index.to_numpy().tolist(), table["last_us"].tolist(),
                  table["last_id"].tolist(), table["value"].tolist()))


def streak_stream(events: DataFrame, failed_kind: str, threshold: int,
                  buckets: int | None = None) -> DataFrame:
    """Consecutive failures per key; rows at streak >= threshold.

    Keys are grouped into ``buckets`` hashed state groups, so one Python call
    folds many keys at once with vectorized pandas (state per key: last
    position and the open streak).  Choose ``buckets`` near the number of
    active keys / 1000 so a bucket's state stays small."""

    def fn(bkey, pdfs, state):
        pdf, k, us, eid, seg, first, carry, table = _load_bucket(pdfs, state, "workspace_id", bkey)
        if not len(k):
            return
        f = (pdf["kind"] == failed_kind).to_numpy()
        idx = np.arange(len(k)) - np.maximum.accumulate(np.where(first, np.arange(len(k)), 0))
        lastf = pd.Series(np.where(~f, idx, -1)).groupby(seg).cummax().to_numpy()
        c0 = carry  # open streak carried from earlier batches, per row's key
        streak = np.where(f, np.where(lastf >= 0, idx - lastf, c0 + idx + 1), 0)
        last = np.r_[np.nonzero(np.diff(seg))[0], len(seg) - 1]
        _store_bucket(state, table, k, us, eid, seg, streak[last])
        sel = streak >= threshold
        if sel.any():
            yield pd.DataFrame({"workspace_id": _named(k[sel], bkey), "event_id": eid[sel],
                                "ts": pdf["ts"][sel].to_numpy(), "streak": streak[sel]})

    ev = _bucketed(events.select("workspace_id", "event_id", "ts", "kind"), "workspace_id",
                   buckets)
    return ev.groupBy("_bucket").applyInPandasWithState(
        fn, STREAK_OUT, BUCKET_STATE, "append", GroupStateTimeout.NoTimeout)


def admission_stream(events: DataFrame, submit_kind: str, release_kind: str,
                     limit: int, buckets: int | None = None) -> DataFrame:
    """W5 on a stream; state = the counter of each key (bucketed as in
    ``streak_stream``).  Uses the same closed form as the batch fold:
    ``before_t = S_{t-1} + min(c0, min over earlier submits of (limit - S_j))``."""

    def fn(bkey, pdfs, state):
        pdf, k, us, eid, seg, first, c0, table = _load_bucket(pdfs, state, "workspace_id", bkey)
        if not len(k):
            return
        kind = pdf["kind"].to_numpy()
        sub = kind == submit_kind
        a = np.where(sub, 1, np.where(kind == release_kind, -1, 0)).astype("int64")
        s = pd.Series(a).groupby(seg).cumsum().to_numpy()
        cand = np.where(sub, limit - s, _BIG)
        cm = pd.Series(cand).groupby(seg).cummin().to_numpy()
        mprev = np.where(first, _BIG, np.r_[_BIG, cm[:-1]])
        before = (s - a) + np.minimum(c0, mprev)
        last = np.r_[np.nonzero(np.diff(seg))[0], len(seg) - 1]
        after = s[last] + np.minimum(c0[last], cm[last])
        _store_bucket(state, table, k, us, eid, seg, after)
        yield pd.DataFrame({"workspace_id": _named(k, bkey), "event_id": eid, "running_before": before,
                            "admitted": pd.Series(before < limit, dtype="boolean")
                            .where(sub, pd.NA)})

    ev = _bucketed(events.select("workspace_id", "event_id", "ts", "kind"), "workspace_id",
                   buckets)
    return ev.groupBy("_bucket").applyInPandasWithState(
        fn, ADMIT_OUT, BUCKET_STATE, "append", GroupStateTimeout.NoTimeout)


GAP_OUT = T.StructType([
    T.StructField("workspace_id", T.LongType()),
    T.StructField("from_ts", T.TimestampNTZType()),
    T.StructField("to_ts", T.TimestampNTZType()),
    T.StructField("gap_us", T.LongType()),
    T.StructField("open", T.BooleanType()),
])


def missed_heartbeats(beats: DataFrame, limit_us: int, delay: str,
                      buckets: int | None = None) -> DataFrame:
    """T5: every gap between consecutive heartbeats of a key longer than the
    limit (closed gaps: inside a batch and across batches), and an open gap
    once the watermark passes ``last + limit`` with no new beat.

    State per key: last beat and a ``reported`` flag (the ``value`` array),
    so an open gap is reported once.  Keys are bucketed as in
    ``streak_stream``; a bucket's event-time timeout is the earliest due time
    of its unreported keys."""
    limit_ms = limit_us // 1000

    def open_gaps(table: pd.DataFrame, wm_ms: int, bkey):
        due = table["last_us"].to_numpy() // 1000 + limit_ms
        hit = (table["value"].to_numpy() == 0) & (due <= wm_ms)
        out = None
        if hit.any():
            out = pd.DataFrame({"workspace_id": _named(table.index.to_numpy()[hit], bkey),
                                "from_ts": pd.to_datetime(table["last_us"].to_numpy()[hit],
                                                          unit="us"),
                                "to_ts": pd.NaT, "gap_us": None, "open": True})
            v = table["value"].to_numpy().copy()
            v[hit] = 1
            table = table.assign(value=v)
        return table, out

    def schedule(state, table: pd.DataFrame, wm_ms: int) -> None:
        due = table["last_us"].to_numpy() // 1000 + limit_ms
        due = due[(table["value"].to_numpy() == 0) & (due > wm_ms)]
        if len(due):
            state.setTimeoutTimestamp(int(due.min()))

    def fn(bkey, pdfs, state):
        wm = state.getCurrentWatermarkMs()
        if state.hasTimedOut:
            st = state.get
            table = pd.DataFrame({"last_us": st[1], "last_id": st[2], "value": st[3]},
                                 index=pd.Index(st[0], dtype="int64"))
            table, out = open_gaps(table, wm, bkey)
            state.update((table.index.to_numpy().tolist(), table["last_us"].tolist(),
                          table["last_id"].tolist(), table["value"].tolist()))
            schedule(state, table, wm)
            if out is not None:
                yield out
            return
        pdf, k, us, eid, seg, first, _, table = _load_bucket(pdfs, state, "workspace_id", bkey)
        if not len(k):
            return
        prev_known = table.index.get_indexer(k)
        prev_us = np.r_[table["last_us"].to_numpy("int64"), -1][prev_known]
        prev = np.where(first, prev_us, np.r_[-1, us[:-1]])
        gap = us - prev
        sel = (prev >= 0) & (gap > limit_us)
        last = np.r_[np.nonzero(np.diff(seg))[0], len(seg) - 1]
        _store_bucket(state, table, k, us, eid, seg, np.zeros(len(last), dtype="int64"))
        st = state.get
        table = pd.DataFrame({"last_us": st[1], "last_id": st[2], "value": st[3]},
                             index=pd.Index(st[0], dtype="int64"))
        # a bucket with data gets no timeout call: report its due keys here
        table, out = open_gaps(table, wm, bkey)
        state.update((table.index.to_numpy().tolist(), table["last_us"].tolist(),
                      table["last_id"].tolist(), table["value"].tolist()))
        schedule(state, table, wm)
        if out is not None:
            yield out
        if sel.any():
            yield pd.DataFrame({"workspace_id": _named(k[sel], bkey),
                                "from_ts": pd.to_datetime(prev[sel], unit="us"),
                                "to_ts": pd.to_datetime(us[sel], unit="us"),
                                "gap_us": gap[sel], "open": False})

    t = (_bucketed(beats.select("workspace_id", "event_id", "ts"), "workspace_id", buckets)
         .withColumn("_wts", event_time("ts")).withWatermark("_wts", delay))
    return t.groupBy("_bucket").applyInPandasWithState(
        fn, GAP_OUT, BUCKET_STATE, "append", GroupStateTimeout.EventTimeTimeout)


def to_parquet_sink(stream: DataFrame, path: str, checkpoint: str):
    """Append sink for the stateful outputs above."""
    return (stream.writeStream.format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(availableNow=True).start())

