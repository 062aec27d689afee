"""Contiguous row slices (P1), per-slice user functions.

A slice is a contiguous range of rows in the order of a unique key:
``rows_per_slice = max(1, n // total)``, slice ``i`` is
``[i * rows_per_slice, (i + 1) * rows_per_slice)`` and the last slice takes the
remainder.  The slice of a row therefore depends only on the keys found at the
ranks ``i * rows_per_slice``; the full row numbering is never needed.

How the boundary keys are found, for keys of any type that can be ordered:

1. one aggregate: rows and non-null keys;
2. the keys alone are range-partitioned into parts of about
   ``rows_per_bucket`` rows and written once to the shared folder with their part
   number, so every later pass sees the same parts;
3. keys are numbered inside their part (a window partitioned by part, so each
   sort is bounded); equal neighbours are counted, and a key that repeats is
   an error.  Small part counts give the rank where each part starts;
4. the keys at the wanted ranks -- ``total - 1`` at most -- reach the driver, and
   every row gets its slice from comparisons with them (a balanced tree of
   ``CASE`` expressions, on the key's own type).

Nothing depends on the number of rows but the number of parts.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

ROWS_PER_BUCKET = 1_000_000


def _portable(c: Column, dt: T.DataType) -> Column:
    """A value that survives the way through Python whatever the time zone."""
    if isinstance(dt, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dt, (T.TimestampNTZType, T.DateType)):
        return c.cast("string")
    return c


def _literal(value, dt: T.DataType) -> Column:
    if isinstance(dt, T.TimestampType):
        return F.timestamp_micros(F.lit(value))
    return F.lit(value).cast(dt)


def position_among(c: Column, cuts: list[Column]) -> Column:
    """How many of the increasing ``cuts`` are at most ``c``: binary search as
    nested conditions."""
    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(c >= cuts[mid], search(mid + 1, hi)).otherwise(search(lo, mid))
    return search(0, len(cuts))


@dataclass(frozen=True)
class SlicePlan:
    """Everything needed to assign slices; all of it is small."""

    key: str
    key_type: T.DataType
    n: int
    total: int
    rows_per_slice: int
    boundaries: list = field(default_factory=list)  # key values at ranks i*rps

    def slice_sizes(self) -> list[int]:
        rps, n = self.rows_per_slice, self.n
        sizes = []
        for i in range(self.total):
            lo = min(n, i * rps)
            hi = n if i == self.total - 1 else min(n, (i + 1) * rps)
            sizes.append(max(0, hi - lo))
        return sizes

    def empty_slices(self) -> list[int]:
        return [i for i, s in enumerate(self.slice_sizes()) if s == 0]


def plan_slices(df: DataFrame, key: str, total: int,
                rows_per_bucket: int = ROWS_PER_BUCKET) -> SlicePlan:
    """Find the keys at the slice boundaries (see module doc)."""
    if total < 1:
        raise ValueError("total must be >= 1")
    dt = df.schema[key].dataType
    k = df.select(F.col(key).alias("_k"))
    st = k.agg(F.count("_k").alias("n"), F.count(F.lit(1)).alias("rows")).first()
    if st["n"] != st["rows"]:
        raise ValueError(f"slice key {key!r} has nulls; it must be unique and non-null")
    n = int(st["n"])
    rps = max(1, n // total)
    ranks = [i * rps for i in range(1, total) if i * rps < n]
    parts = max(1, math.ceil(n / rows_per_bucket))
    fixed = materialize(k.repartitionByRange(parts, "_k").withColumn("_p", F.spark_partition_id()),
                        "slice-keys")
    inside = Window.partitionBy("_p").orderBy("_k")
    starts = (fixed.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_start", F.sum("_n").over(  # one row per part
                  Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)))
              .select("_p", F.coalesce("_start", F.lit(0).cast("long")).alias("_start")))
    numbered = (fixed.withColumn("_i", F.row_number().over(inside) - 1)
                .withColumn("_twice", F.lag("_k").over(inside) == F.col("_k"))
                .join(starts, "_p").withColumn("_rank", F.col("_start") + F.col("_i")))
    wanted = ((F.col("_rank") % rps == 0) & F.col("_rank").between(rps, rps * len(ranks))
              if ranks else F.lit(False))
    found = (numbered.where(wanted | F.col("_twice"))
             .select(_portable(F.col("_k"), dt).alias("k"), "_rank",
                     F.coalesce("_twice", F.lit(False)).alias("twice"))
             .orderBy(F.desc("twice"), "_rank").limit(len(ranks) + 1).collect())
    if any(r["twice"] for r in found):
        raise ValueError(f"slice key {key!r} repeats values; it must be unique")
    if len(found) != len(ranks):
        raise RuntimeError("not every slice boundary was found")
    return SlicePlan(key, dt, n, total, rps, [r["k"] for r in found])


def assign_slices(df: DataFrame, plan: SlicePlan, out: str = "partition_index") -> DataFrame:
    """Add the slice index of each row (int), from the plan's boundary keys."""
    cuts = [_literal(v, plan.key_type) for v in plan.boundaries]
    return df.withColumn(out, position_among(F.col(plan.key), cuts).cast("int"))


def slice_rows_by_rank(df: DataFrame, key: str, total: int, out: str = "partition_index",
                       rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """P1 for any number of slices: every row's slice is computed from its rank.

    The rows are range-partitioned by the key, sorted inside each range and written
    once with ``monotonically_increasing_id``, which is then the range and the place in
    it.  Ranges before a row's own give the rank of its first place: a table of one
    row per range, joined back.  No boundary reaches the driver and no expression
    grows with ``total``."""
    if total < 1:
        raise ValueError("total must be >= 1")
    parts = max(1, math.ceil(df.select(key).count() / rows_per_bucket))
    fixed = materialize(df.repartitionByRange(parts, key).sortWithinPartitions(key)
                        .withColumn("_mid", F.monotonically_increasing_id()), "ranked-rows")
    place = fixed.withColumn("_p", F.shiftright("_mid", 33)).withColumn("_i", F.col("_mid").bitwiseAND((1 << 33) - 1))
    # keys alone: nulls, and equal neighbours of a range (equal keys share a range)
    near = Window.partitionBy("_p").orderBy("_i")
    bad = (place.select("_p", "_i", F.col(key).alias("_k")).withColumn("_twice", F.lag("_k").over(near) == F.col("_k"))
           .agg(F.count_if(F.col("_k").isNull()).alias("nulls"), F.count_if("_twice").alias("twice")).first())
    if bad["nulls"]:
        raise ValueError(f"slice key {key!r} has nulls; it must be unique and non-null")
    if bad["twice"]:
        raise ValueError(f"slice key {key!r} repeats values; it must be unique")
    sizes = place.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = sizes.select(F.col("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long")).alias("_start"),
                          F.sum("_n").over(Window.partitionBy()).alias("_all"))
    size = F.greatest(F.lit(1), F.floor(F.col("_all") / F.lit(total)))
    return (place.join(starts, "_p")
            .withColumn(out, F.least(F.floor((F.col("_start") + F.col("_i")) / size), F.lit(total - 1)).cast("int"))
            .drop("_p", "_i", "_mid", "_start", "_all"))


#: from so many slices on, rows are ranked instead of compared with every boundary
MANY_SLICES = 64


def slice_rows(df: DataFrame, key: str, total: int = 3,
               out: str = "partition_index") -> DataFrame:
    """Every row with the index of its contiguous slice."""
    if total >= MANY_SLICES:
        return slice_rows_by_rank(df, key, total, out)
    return assign_slices(df, plan_slices(df, key, total), out)


def slice_rows_by_position(df: DataFrame, position: str, total: int = 3, out: str = "partition_index") -> DataFrame:
    """P1 for rows that carry their position, 0 to n - 1, in a column (which is dropped)."""
    n = df.agg(F.max(position)).first()[0]
    size = max(1, ((n if n is not None else -1) + 1) // total)
    return (df.withColumn(out, F.least(F.floor(F.col(position) / F.lit(size)), F.lit(total - 1)).cast("int"))
            .drop(position))


def _file_positions(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of a file scan with ``_fp``, ``_fb``, ``_mid``; first position, and
    number of rows in all, of each file split).

    Spark may cut a scan differently each time it runs (the split size
    follows the parallelism of the moment), so rows and ids are written once and
    both tables come from that."""
    fixed = materialize(df.select("*", F.col("_metadata.file_path").alias("_fp"),
                                  F.col("_metadata.file_block_start").alias("_fb"),
                                  F.monotonically_increasing_id().alias("_mid")), "file-rows")
    # one row per split, in file order; the rows themselves are not moved
    order = Window.orderBy("_fp", "_fb")
    splits = (fixed.groupBy("_fp", "_fb").agg(F.count(F.lit(1)).alias("_c"), F.min("_mid").alias("_m"))
              .select(F.col("_fp").alias("_sp"), F.col("_fb").alias("_sb"), "_m",
                      F.coalesce(F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, -1)),
                                 F.lit(0).cast("long")).alias("_start"),
                      F.sum("_c").over(Window.partitionBy()).alias("_all")))
    return fixed, splits


def _with_position(df: DataFrame, out: str) -> DataFrame:
    fixed, splits = _file_positions(df)
    t = fixed.join(splits, (F.col("_fp") == F.col("_sp")) & (F.col("_fb") == F.col("_sb")), "left")
    lost = F.raise_error(F.lit("a row of an unknown file split"))
    return (t.withColumn(out, F.coalesce(F.col("_start") + F.col("_mid") - F.col("_m"), lost))
            .drop("_fp", "_fb", "_mid", "_sp", "_sb", "_m", "_start"))


def file_row_index(df: DataFrame, out: str = "_row_idx") -> DataFrame:
    """0-based position of each row of a file scan, in (file path, offset) order.

    Rows of one file split are numbered consecutively by
    ``monotonically_increasing_id``; a split is identified by
    ``(_metadata.file_path, _metadata.file_block_start)``.  The rows are written
    once to the shared folder with those values, so no row can be
    lost or misplaced by a scan that is cut differently later.
    ``df`` must be a file scan.
    """
    return _with_position(df, out).drop("_all")


def slice_rows_in_file_order(df: DataFrame, total: int = 3,
                             out: str = "partition_index") -> DataFrame:
    """P1 for a file scan without a key: slices follow the order in the files."""
    size = F.greatest(F.lit(1), F.floor(F.col("_all") / F.lit(total)))
    return (_with_position(df, "_row_idx")
            .withColumn(out, F.least(F.floor(F.col("_row_idx") / size), F.lit(total - 1)).cast("int"))
            .drop("_row_idx", "_all"))


# --------------------------------------------------------------------- P2, P3

def check_job_function(fn) -> None:
    """A job is a callable ``run(df, params) -> pandas.DataFrame``."""
    if fn is None or not callable(fn):
        raise ValueError("job must define a callable run(df, params)")


def slice_apply(df: DataFrame, fn: Callable[[pd.DataFrame, dict], pd.DataFrame],
                schema: str | T.StructType, key: str, total: int = 3,
                params: dict | None = None,
                merge: Callable[[pd.DataFrame, dict], pd.DataFrame] | None = None,
                max_rows_per_group: int = ROWS_PER_BUCKET,
                rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """The user function over every slice, empty slices included.

    Output = ``partition_index int`` + ``schema``.  The caller chooses one of two
    contracts; neither depends on the number of rows:

    * without ``merge``: ``fn(slice_frame, params)`` is called once per slice, with
      all its rows in key order.  A slice must fit one worker's memory:
      choose ``total`` accordingly.
    * with ``merge``: ``fn`` is always called on parts of a slice, each in key
      order, and ``merge(partials, params)`` combines the outputs of one
      slice.  Parts are drawn by a hash of the key and hold half of
      ``max_rows_per_group`` rows on average.
    """
    check_job_function(fn)
    if merge is not None:
        check_job_function(merge)
    params = dict(params or {})
    out_schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    cols = df.columns
    plan = plan_slices(df, key, total, rows_per_bucket)
    parts = 1
    if merge is not None:
        parts = max(1, math.ceil(2 * max(plan.slice_sizes()) / max_rows_per_group))

    sliced = (assign_slices(df, plan).withColumn("_empty", F.lit(False))
              .withColumn("_sub", F.pmod(F.xxhash64(F.col(key)), F.lit(parts)).cast("int")))
    empty = plan.empty_slices()
    if empty:
        spark = df.sparkSession
        marks = spark.createDataFrame([(i,) for i in empty], "partition_index int")
        for f in df.schema.fields:
            marks = marks.withColumn(f.name, F.lit(None).cast(f.dataType))
        marks = (marks.withColumn("_empty", F.lit(True)).withColumn("_sub", F.lit(0))
                 .select(*sliced.columns))
        sliced = sliced.unionByName(marks)

    part_schema = T.StructType([T.StructField("partition_index", T.IntegerType()),
                                T.StructField("_sub", T.IntegerType()), *out_schema.fields])
    names = [f.name for f in out_schema.fields]

    def checked(res, pidx: int, what: str) -> pd.DataFrame:
        if res is None:
            raise ValueError(f"the {what} function gave no DataFrame for slice {pidx}")
        missing = [c for c in names if c not in res.columns]
        if missing:
            raise ValueError(f"the {what} function's result for slice {pidx} lacks columns {missing}")
        return res.reset_index(drop=True)[names].copy()

    def run_one(pdf: pd.DataFrame) -> pd.DataFrame:
        pidx = int(pdf["partition_index"].iloc[0])
        rows = pdf[~pdf["_empty"].astype(bool)].sort_values(key)[cols].reset_index(drop=True)
        res = checked(fn(rows, params), pidx, "job")
        res.insert(0, "_sub", int(pdf["_sub"].iloc[0]))
        res.insert(0, "partition_index", pidx)
        return res

    partial = sliced.groupBy("partition_index", "_sub").applyInPandas(run_one, part_schema)
    if merge is None:
        return partial.drop("_sub")

    final_schema = T.StructType([T.StructField("partition_index", T.IntegerType()),
                                 *out_schema.fields])

    def merge_one(pdf: pd.DataFrame) -> pd.DataFrame:
        pidx = int(pdf["partition_index"].iloc[0])
        res = checked(merge(pdf.sort_values("_sub")[names].reset_index(drop=True), params), pidx, "merge")
        res.insert(0, "partition_index", pidx)
        return res

    return partial.groupBy("partition_index").applyInPandas(merge_one, final_schema)


def slice_stream(df: DataFrame, fn: Callable, schema: str | T.StructType, key: str, total: int = 3,
                 params: dict | None = None, tasks: int | None = None) -> DataFrame:
    """P2 over slices of any size: ``fn(frames, params)`` is called once per slice, empty
    slices included, with an iterator of pandas frames that hold the slice's rows in
    key order; it yields frames of ``schema``.

    Rows are dealt by slice, sorted by Spark (which spills) and streamed in Arrow
    batches (``spark.sql.execution.arrow.maxRecordsPerBatch`` rows), so memory is that of a
    batch and of what the function itself keeps.  A slice is one task's work: take as
    many slices as tasks should share."""
    check_job_function(fn)
    params = dict(params or {})
    out_schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    cols, names = df.columns, [f.name for f in out_schema.fields]
    sliced = slice_rows(df, key, total).withColumn("_row", F.lit(True))
    # a mark before the rows of each slice, so that empty ones are called too
    marks = df.sparkSession.range(total).select(F.col("id").cast("int").alias("partition_index"), F.lit(False).alias("_row"))
    rows = sliced.unionByName(marks, allowMissingColumns=True)
    tasks = tasks or min(total, max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1))
    dealt = rows.repartition(tasks, "partition_index").sortWithinPartitions("partition_index", "_row", key)

    def run(batches):
        def pieces():  # (slice, frame) in order; a batch may hold rows of several slices
            for pdf in batches:
                index = pdf["partition_index"].to_numpy()
                cuts = [0, *(i + 1 for i in (index[1:] != index[:-1]).nonzero()[0].tolist()), len(pdf)]
                for a, b in zip(cuts, cuts[1:]):
                    if b > a:
                        part = pdf.iloc[a:b]
                        yield int(index[a]), part.loc[part["_row"].to_numpy(dtype=bool), cols].reset_index(drop=True)

        coming = pieces()
        ahead = next(coming, None)
        while ahead is not None:
            index = ahead[0]

            def frames():
                nonlocal ahead
                while ahead is not None and ahead[0] == index:
                    frame = ahead[1]
                    ahead = next(coming, None)
                    if len(frame):
                        yield frame

            given = frames()
            for res in fn(given, params):
                missing = [c for c in names if c not in res.columns]
                if missing:
                    raise ValueError(f"the job function's result for slice {index} lacks columns {missing}")
                res = res[names].reset_index(drop=True).copy()
                res.insert(0, "partition_index", index)
                yield res
            for _ in given:  # rows that the function left
                pass

    return dealt.mapInPandas(run, T.StructType([T.StructField("partition_index", T.IntegerType()), *out_schema.fields]))
