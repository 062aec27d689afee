"""Records of large CSV files, cut in parallel.

A line feed ends a record only outside quotes, and whether a line begins inside a
quoted field depends on all lines before it. So a file cannot simply be read in
splits by line. Here it is, with a prefix scan:

1. Lines are read as text, in as many splits as the file has, and written once with
   the split and their order.
2. A line is a map from "begins outside / inside quotes" to "ends outside / inside":
   it keeps, swaps or fixes the state. Such maps compose, so a window over
   each split and one over the splits of a file (a row each) give every line's state.
   Quotes count where a field begins with one; a quote inside a bare field is text,
   as pandas has it.
3. Lines that begin outside start a record. Records of one line, nearly all, are not moved;
   the others are put together by their number.

A field that is never closed makes one record of the rest of its file.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize

# possessive throughout: one pass over a line, without backtracking or recursion
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+'
_FIELDS = rf'(?:(?:{_QUOTED}"[^,]*+|[^",][^,]*+|),)*+'
_OPENS = rf"^{_FIELDS}{_QUOTED}\z"
_NEVER_CLOSES = r'^[^"]*+(?:""[^"]*+)*+\z'
_OPENS_AGAIN = rf'^[^"]*+(?:""[^"]*+)*+"[^,]*+,{_FIELDS}{_QUOTED}\z'


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(_fp, _fb: file and split, _mid: order, value, _rec: number of the record in its file, _whole:
    the line is a record)."""
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select("value", F.col("_metadata.file_path").alias("_fp"), F.col("_metadata.file_block_start").alias("_fb"),
                     F.monotonically_increasing_id().alias("_mid")))
    outside = F.col("value").rlike(_OPENS)
    inside = F.col("value").rlike(_NEVER_CLOSES) | F.col("value").rlike(_OPENS_AGAIN)
    lines = materialize(lines.select("*", outside.cast("int").alias("_o"), inside.cast("int").alias("_i")), "csv-lines")
    in_split = Window.partitionBy("_fp", "_fb").orderBy("_mid")
    upto = in_split.rowsBetween(Window.unboundedPreceding, 0)
    # parity of swaps, and the state that the last fixing line left, as of a parity of 0
    t = lines.withColumn("_swap", F.sum(F.when(F.col("_o") > F.col("_i"), 1).otherwise(0)).over(upto) % 2)
    t = t.withColumn("_fixed", F.last(F.when(F.col("_o") == F.col("_i"), F.col("_o").bitwiseXOR(F.col("_swap").cast("int"))), ignorenulls=True).over(upto))
    splits = t.groupBy("_fp", "_fb").agg(F.max_by(F.struct("_swap", "_fixed"), "_mid").alias("s")).select("_fp", "_fb", "s.*")
    of_file = Window.partitionBy("_fp").orderBy("_fb")  # one row per split
    before = of_file.rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_all", F.sum("_swap").over(of_file.rowsBetween(Window.unboundedPreceding, 0)) % 2)
    earlier = F.when(F.col("_fixed").isNotNull(), F.col("_fixed").bitwiseXOR(F.col("_swap").cast("int")).bitwiseXOR(F.col("_all").cast("int")))
    begins = (F.coalesce(F.last(earlier, ignorenulls=True).over(before), F.lit(0)).bitwiseXOR(
        F.coalesce(F.lag("_all").over(of_file), F.lit(0)).cast("int")))
    splits = splits.select("_fp", "_fb", begins.alias("_begins"))
    t = t.join(splits, ["_fp", "_fb"])
    t = t.withColumn("_ends", F.coalesce("_fixed", "_begins").bitwiseXOR(F.col("_swap").cast("int")))
    t = t.withColumn("_was", F.coalesce(F.lag("_ends").over(in_split), "_begins"))
    blank = (F.col("_was") == 0) & F.col("value").isin("", "\r")
    t = t.withColumn("_starts", ((F.col("_was") == 0) & ~blank).cast("int"))
    t = materialize(t.select("_fp", "_fb", "_mid", "value", blank.alias("_blank"), ((F.col("_starts") == 1) & (F.col("_ends") == 0)).alias("_whole"),
                             F.sum("_starts").over(upto).alias("_n")), "csv-numbered")
    starts = t.groupBy("_fp", "_fb").agg(F.max("_n").alias("_k"))
    carry = starts.select("_fp", "_fb", F.coalesce(F.sum("_k").over(before), F.lit(0).cast("long")).alias("_carry"))
    return (t.where(~F.col("_blank")).join(carry, ["_fp", "_fb"])
            .select("_fp", "_fb", "_mid", "value", "_whole", (F.col("_carry") + F.col("_n") - 1).alias("_rec")))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record, text): every record of the CSV files at ``path``, numbered from 0 in
    its file. Blank lines are no records; a carriage return before the line feed that ends a
    record is dropped."""
    lines = _numbered_lines(spark, path)
    whole = lines.where("_whole").select("_fp", "_rec", F.col("value").alias("text"))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("_fb", "_mid", "value"))), lambda x: x["value"])
    joined = lines.where(~F.col("_whole")).groupBy("_fp", "_rec").agg(F.array_join(parts, "\n").alias("text"))
    return whole.unionByName(joined).select(F.col("_fp").alias("file"), F.col("_rec").alias("record"), F.regexp_replace("text", r"\r\z", "").alias("text"))


def _names(header: str) -> list[str]:
    """Column names as pandas gives them: repeated ones get a number, empty ones a place."""
    out: list[str] = []
    for i, name in enumerate(next(csv.reader(io.StringIO(header.removeprefix("﻿"), newline="")))):
        name, n = name or f"Unnamed: {i}", 0
        base = name
        while name in out:
            n += 1
            name = f"{base}.{n}"
        out.append(name)
    return out


def read_csv_text(spark: SparkSession, path: str, header: bool = True, position: str | None = None) -> DataFrame:
    """All fields of all records as text, null where they are empty or missing, in the order of
    files and records (a sort that Spark leaves out where the order does not matter). With
    ``position`` a column of that name numbers the rows from 0 in this order."""
    records = materialize(csv_records(spark, path), "csv-records")
    first = records.where("record = 0").orderBy("file").limit(1).collect()
    if not first:
        raise ValueError(f"no records in {path!r}")
    names = _names(first[0]["text"])
    if not header:
        names = [f"_c{i}" for i in range(len(names))]
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    fields = F.from_csv("text", schema, {"quote": '"', "escape": '"', "multiLine": "true"})
    rows = records.where("record > 0") if header else records
    columns = [F.col(f"x.c{i}").alias(c) for i, c in enumerate(names)]
    if position is None:
        return rows.orderBy("file", "record").select(fields.alias("x")).select(*columns)
    skipped = 1 if header else 0
    # one row per file
    start = F.sum("_n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    files = (records.groupBy("file").agg((F.max("record") + 1 - skipped).alias("_n"))
             .select("file", F.coalesce(start, F.lit(0).cast("long")).alias("_start")))
    # sent to the rows: by file, the rows of a file would all go to one task
    return (rows.join(F.broadcast(files), "file").orderBy("file", "record").select(fields.alias("x"), (F.col("_start") + F.col("record") - skipped).alias("_at"))
            .select(*columns, F.col("_at").alias(position)))
