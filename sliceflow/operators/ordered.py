"""Per-key ordered operators (W1-W7) that stay parallel when one key is hot.

A plain ``Window.partitionBy(key).orderBy(ts)`` sends every row of a key to
one task; if one workspace holds a third of all events, that task sorts a
third of the data alone.  The scans here split each key's sequence into
*chunks* and run a two-level prefix scan:

1. ``chunk`` = range partition of *all* order columns (time, then id), written
   once to the shared folder with its number.  Ties in time are split by id, and a
   chunk of any key holds about ``rows_per_chunk`` rows at most, however
   hot the key is.  Comparisons are on the columns' own types, so no
   time zone matters.
2. Local window over ``(key, chunk)`` (bounded sort, runs in parallel).
3. One summary row per ``(key, chunk)``; a window over that small table
   (partitioned by key, ordered by chunk) gives what each chunk inherits from
   the chunks before it.
4. Join the carry back on ``(key, chunk)`` -- the row side is already
   partitioned on those columns, so only the small carry table moves.

Each scan below is an associative summary, so the result is exactly the one
a single sequential pass would give.  Keys are held in one struct, ``_k``: structs
are equal where their nulls are, so rows of a null key are a key like others in
the windows and in the join.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import MAX_RUNNING_JOBS
from ..session import materialize

ROWS_PER_CHUNK = 1_000_000
MIN_CHUNKS = 8
_UNB = Window.unboundedPreceding


def add_chunks(df: DataFrame, order_cols: str | list[str], rows_per_chunk: int = ROWS_PER_CHUNK,
               min_chunks: int = MIN_CHUNKS, out: str = "_c") -> DataFrame:
    """Add ``out``: the number of the row's range of the order columns; ranges are
    global, balanced and in order.  Null order values come first."""
    cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    chunks = max(min_chunks, math.ceil(df.select(*cols).count() / rows_per_chunk))
    return materialize(df.repartitionByRange(chunks, *cols).withColumn(out, F.spark_partition_id()),
                       "chunks")


def _local(keys, order_cols):
    return Window.partitionBy(*keys, "_c").orderBy(*order_cols)


def _chunks(keys):
    return Window.partitionBy(*keys).orderBy("_c")


def _attach(rows: DataFrame, carry: DataFrame, keys) -> DataFrame:
    return rows.join(carry, [*keys, "_c"], "left").drop("_k")


def _keyed(rows: DataFrame, keys) -> tuple[DataFrame, list[str]]:
    return rows.withColumn("_k", F.struct(*[F.col(k) for k in keys])), ["_k"]


def running_sum(df: DataFrame, keys: list[str], order_cols: list[str], value: Column,
                out: str, rows_per_chunk: int = ROWS_PER_CHUNK,
                min_chunks: int = MIN_CHUNKS, chunked: DataFrame | None = None) -> DataFrame:
    """``out`` = sum of ``value`` over all earlier rows of the key and this row."""
    t = chunked if chunked is not None else add_chunks(df, order_cols, rows_per_chunk,
                                                        min_chunks)
    t, keys = _keyed(t.withColumn("_v", value), keys)
    w = _local(keys, order_cols).rowsBetween(_UNB, 0)
    t = t.withColumn("_ls", F.sum("_v").over(w))
    summ = t.groupBy(*keys, "_c").agg(F.sum("_v").alias("_tot"))
    carry = summ.select(*keys, "_c",
                        F.coalesce(F.sum("_tot").over(_chunks(keys).rowsBetween(_UNB, -1)),
                                   F.lit(0)).alias("_carry"))
    return (_attach(t, carry, keys)
            .withColumn(out, F.coalesce(F.col("_carry"), F.lit(0)) + F.col("_ls"))
            .drop("_v", "_ls", "_carry", "_c"))


def previous_value(df: DataFrame, keys: list[str], order_cols: list[str], value: str,
                   out: str, rows_per_chunk: int = ROWS_PER_CHUNK,
                   min_chunks: int = MIN_CHUNKS) -> DataFrame:
    """``out`` = ``value`` of the previous row of the same key (``lag``)."""
    t, keys = _keyed(add_chunks(df, order_cols, rows_per_chunk, min_chunks), keys)
    lw = _local(keys, order_cols)
    t = (t.withColumn("_rn", F.row_number().over(lw))
         .withColumn("_lag", F.lag(value).over(lw)))
    ordkey = F.struct(*[F.col(c) for c in order_cols])
    summ = t.groupBy(*keys, "_c").agg(F.max_by(F.col(value), ordkey).alias("_last"))
    carry = summ.select(*keys, "_c", F.lag("_last").over(_chunks(keys)).alias("_carry"))
    return (_attach(t, carry, keys)
            .withColumn(out, F.when(F.col("_rn") == 1, F.col("_carry")).otherwise(F.col("_lag")))
            .drop("_rn", "_lag", "_carry", "_c"))


def next_value(df: DataFrame, keys: list[str], order_cols: list[str], value: str,
               out: str, rows_per_chunk: int = ROWS_PER_CHUNK,
               min_chunks: int = MIN_CHUNKS) -> DataFrame:
    """``out`` = ``value`` of the next row of the same key (``lead``)."""
    t, keys = _keyed(add_chunks(df, order_cols, rows_per_chunk, min_chunks), keys)
    lw = _local(keys, order_cols)
    t = (t.withColumn("_lead", F.lead(value).over(lw))
         .withColumn("_end", F.lead(F.lit(True)).over(lw).isNull()))
    ordkey = F.struct(*[F.col(c) for c in order_cols])
    summ = t.groupBy(*keys, "_c").agg(F.min_by(F.col(value), ordkey).alias("_first"))
    carry = summ.select(*keys, "_c", F.lead("_first").over(_chunks(keys)).alias("_carry"))
    return (_attach(t, carry, keys)
            .withColumn(out, F.when(F.col("_end"), F.col("_carry")).otherwise(F.col("_lead")))
            .drop("_lead", "_end", "_carry", "_c"))


def last_known(df: DataFrame, keys: list[str], order_cols: list[str], value: Column,
               out: str, rows_per_chunk: int = ROWS_PER_CHUNK,
               min_chunks: int = MIN_CHUNKS) -> DataFrame:
    """``out`` = the last ``value`` that is not null, of this row or of an earlier
    one of the key; null before the first."""
    t, keys = _keyed(add_chunks(df.withColumn("_v", value), order_cols, rows_per_chunk, min_chunks), keys)
    t = t.withColumn("_known", F.last("_v", ignorenulls=True).over(_local(keys, order_cols).rowsBetween(_UNB, 0)))
    ordkey = F.when(F.col("_v").isNotNull(), F.struct(*[F.col(c) for c in order_cols]))
    summ = t.groupBy(*keys, "_c").agg(F.max_by(F.col("_v"), ordkey).alias("_last"))
    carry = summ.select(*keys, "_c", F.last("_last", ignorenulls=True)
                        .over(_chunks(keys).rowsBetween(_UNB, -1)).alias("_carry"))
    return (_attach(t, carry, keys).withColumn(out, F.coalesce("_known", "_carry"))
            .drop("_v", "_known", "_carry", "_c"))


def true_streak(df: DataFrame, keys: list[str], order_cols: list[str], flag: Column,
                out: str, rows_per_chunk: int = ROWS_PER_CHUNK,
                min_chunks: int = MIN_CHUNKS) -> DataFrame:
    """``out`` = number of consecutive rows with ``flag`` true ending at this
    row (0 when ``flag`` is false or null): the gaps-and-islands streak length."""
    t, keys = _keyed(add_chunks(df.withColumn("_f", F.coalesce(flag, F.lit(False))), order_cols, rows_per_chunk, min_chunks), keys)
    lw = _local(keys, order_cols)
    t = (t.withColumn("_rn", F.row_number().over(lw))
         .withColumn("_lastf", F.max(F.when(~F.col("_f"), F.col("_rn")))
                     .over(lw.rowsBetween(_UNB, 0))))
    summ = t.groupBy(*keys, "_c").agg(
        F.count(F.lit(1)).alias("_n"),
        F.max(F.when(~F.col("_f"), F.col("_rn"))).alias("_lf"))
    # streak at the end of the chunk, and whether the chunk is all true
    summ = summ.select(*keys, "_c", "_n",
                       F.col("_lf").isNull().alias("_all"),
                       (F.col("_n") - F.coalesce(F.col("_lf"), F.lit(0))).alias("_trail"))
    cw = _chunks(keys)
    run = cw.rowsBetween(_UNB, 0)
    summ = (summ.withColumn("_cum", F.sum("_n").over(run))
            .withColumn("_brk", F.last(F.when(~F.col("_all"), F.struct(
                F.col("_trail").alias("t"), F.col("_cum").alias("c"))), ignorenulls=True)
                .over(run)))
    end = F.when(F.col("_brk").isNull(), F.col("_cum")).otherwise(
        F.col("_brk.t") + F.col("_cum") - F.col("_brk.c"))
    carry = summ.select(*keys, "_c", F.coalesce(F.lag(end).over(cw), F.lit(0)).alias("_carry"))
    streak = F.when(~F.col("_f"), F.lit(0)).when(
        F.col("_lastf").isNull(), F.col("_carry") + F.col("_rn")).otherwise(
        F.col("_rn") - F.col("_lastf"))
    return (_attach(t, carry, keys).withColumn(out, streak.cast("long"))
            .drop("_f", "_rn", "_lastf", "_carry", "_c"))


def admission_fold(df: DataFrame, keys: list[str], order_cols: list[str], is_submit: Column,
                   is_release: Column, limit: int = MAX_RUNNING_JOBS, out_prev: str = "running_before",
                   out_admitted: str = "admitted", start: int = 0,
                   rows_per_chunk: int = ROWS_PER_CHUNK,
                   min_chunks: int = MIN_CHUNKS) -> DataFrame:
    """Counter per key; a submit is admitted only while counter < limit
    (then +1), refused otherwise (no change); a release is -1 (no floor).

    Each event is the map ``c -> min(c + a, b)`` (submit: a=1, b=limit;
    release: a=-1, b=inf; other: a=0, b=inf).  Such maps compose into the same
    form, so the counter is a prefix scan:
    ``c_t = S_t + min(start, min over submits j <= t of (limit - S_j))``,
    with ``S`` the running sum of ``a``.  Other rows pass through with
    ``admitted`` null.
    """
    t, keys = _keyed(add_chunks(df, order_cols, rows_per_chunk, min_chunks), keys)
    t = (t.withColumn("_a", F.when(is_submit, F.lit(1)).when(is_release, F.lit(-1))
                      .otherwise(F.lit(0)).cast("long"))
         .withColumn("_sub", F.coalesce(is_submit, F.lit(False))))
    lw = _local(keys, order_cols)
    inc = lw.rowsBetween(_UNB, 0)
    exc = lw.rowsBetween(_UNB, -1)
    cand = F.when(F.col("_sub"), F.lit(limit) - F.col("_ls"))
    t = t.withColumn("_ls", F.sum("_a").over(inc))
    t = (t.withColumn("_lsx", F.coalesce(F.sum("_a").over(exc), F.lit(0)))
         .withColumn("_lmx", F.min(cand).over(exc)))
    summ = t.groupBy(*keys, "_c").agg(F.sum("_a").alias("_tot"), F.min(cand).alias("_m"))
    cw = _chunks(keys)
    summ = summ.withColumn("_cs", F.coalesce(F.sum("_tot").over(cw.rowsBetween(_UNB, -1)),
                                             F.lit(0)))
    carry = summ.select(*keys, "_c", "_cs",
                        F.min(F.col("_m") - F.col("_cs")).over(cw.rowsBetween(_UNB, -1))
                        .alias("_cm"))
    t = _attach(t, carry, keys).withColumn("_cs", F.coalesce(F.col("_cs"), F.lit(0)))
    # counter before this event = S_{t-1} + min(start, min over earlier submits)
    s_prev = F.col("_cs") + F.col("_lsx")
    m_prev = F.least(F.lit(start), F.col("_cm"), F.col("_lmx") - F.col("_cs"))
    t = t.withColumn(out_prev, (s_prev + m_prev).cast("long"))
    t = t.withColumn(out_admitted, F.when(F.col("_sub"), F.col(out_prev) < F.lit(limit)))
    return t.drop("_a", "_sub", "_ls", "_lsx", "_lmx", "_cs", "_cm", "_c")



def running_jobs(events: DataFrame, key: str, order_cols: list[str], kind: str = "kind",
                 submitted: str = "submitted", completed: str = "completed",
                 cancelled: str = "cancelled", release_on_cancel: bool = False,
                 out: str = "running", **chunk_opts) -> DataFrame:
    """Jobs running per workspace: +1 on submit, -1 on completion, no
    floor.  The reference never gives a cancelled job's slot back; with
    ``release_on_cancel`` a cancellation is -1 as well.  Rows of other kinds
    are dropped."""
    rel = [completed, cancelled] if release_on_cancel else [completed]
    ev = events.where(F.col(kind).isin([submitted, *rel]))
    d = F.when(F.col(kind) == submitted, F.lit(1)).otherwise(F.lit(-1)).cast("long")
    return running_sum(ev, [key], order_cols, d, out, **chunk_opts)


def first_per_key(df: DataFrame, keys: list[str], order_cols: list[str],
                  cols: list[str] | None = None, last: bool = False) -> DataFrame:
    """The first (or last) row of each key by ``order_cols``.

    Written as ``min_by``/``max_by`` aggregates: Spark computes them map-side
    (partial aggregation), so a hot key is reduced before the shuffle and no
    task ever sorts a whole key.
    """
    cols = cols or [c for c in df.columns if c not in keys]
    ordkey = F.struct(*[F.col(c) for c in order_cols])
    pick = F.max_by if last else F.min_by
    rec = F.struct(*[F.col(c) for c in cols])
    return (df.groupBy(*keys).agg(pick(rec, ordkey).alias("_r"))
            .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in cols]))
