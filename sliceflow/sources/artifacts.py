"""Slice artifacts: write one CSV per slice (S4), list them (S5), read them
back as one DataFrame (S6), and write datasets in each declared format."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import split_key_size


def write_artifacts(df: DataFrame, path: str, slice_col: str = "partition_index",
                    files_per_slice: int = 1,
                    max_records_per_file: int = 5_000_000, total: int | None = None) -> str:
    """``path/partition_index=<i>/part-*.csv`` with a header and no index.

    With ``files_per_slice=1`` the rows of one slice go to one task, so a
    small slice (a rollup) is one file as in the reference.  For large slice
    outputs raise ``files_per_slice``: rows are spread over that many writer
    tasks per slice by a hash of the row, so no single task writes a whole
    slice; ``maxRecordsPerFile`` bounds each file.

    Text comes back as it was: quotes are doubled, white space is kept, an empty
    text is written as ``""`` and a missing value as nothing.  With ``total`` a
    slice without rows gets an artifact too, with the header alone.
    """
    if files_per_slice <= 1:
        out = df.repartition(slice_col)
    else:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(files_per_slice))
        # an explicit count: AQE must not coalesce the writers back together
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
        out = df.repartition(max(n, files_per_slice), slice_col, salt)
    (_writer(out).option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(slice_col).csv(path))
    if total is not None:
        spark, rest = df.sparkSession, df.drop(slice_col)
        # at most one row per slice
        have = {r[0] for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
                .option("recursiveFileLookup", True).load(path)
                .select(F.regexp_extract("path", rf"{slice_col}=(\d+)", 1).cast("int")).distinct().collect()}
        empty = spark.createDataFrame([], rest.schema).coalesce(1)
        for i in sorted(set(range(total)) - have):
            _writer(empty).csv(f"{path}/{slice_col}={i}")
    return path


def _writer(df: DataFrame):
    return (df.write.mode("errorifexists").option("header", True).option("quote", '"').option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .option("emptyValue", '""').option("nullValue", ""))


def artifact_manifest(spark: SparkSession, path: str, run_id: str | None = None,
                      slice_col: str = "partition_index") -> DataFrame:
    """One row per artifact file: slice, logical name, storage path,
    content type, size.  File contents are not read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
             .option("recursiveFileLookup", True).load(path)
             .select("path", "length"))
    idx = F.regexp_extract("path", rf"{slice_col}=(\d+)", 1).cast("int")
    out = files.select(
        idx.alias(slice_col),
        F.concat(F.lit("partition-"), idx.cast("string"), F.lit(".csv")).alias("name"),
        F.col("path").alias("storage_path"),
        F.lit("text/csv").alias("content_type"),
        F.col("length").alias("size_bytes"))
    if run_id is not None:
        out = out.withColumn("run_id", F.lit(run_id))
    return out


def parse_runner_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """The ``key:size`` line a slice task reports, split into path and size."""
    path, size = split_key_size(col)
    return lines.select(path.alias("storage_path"), size.alias("size_bytes"))


def read_artifacts(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Every artifact of a run as one DataFrame; ``partition_index`` comes
    back from the directory names (partition discovery).  An unquoted empty
    field is missing, a quoted one is an empty text."""
    return (spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True)
            .option("nullValue", _NO_TEXT).option("emptyValue", "").schema(schema).csv(path))


#: stands for a missing field while a file is read: a text that no file holds
_NO_TEXT = "\u0001missing\u0001"


def write_dataset(df: DataFrame, path: str, file_format: str, order_by: str | None = None,
                  files: int | None = None) -> str:
    """Write ``df`` in one of the declared dataset formats.

    ``order_by``: keep this order across files (range partitioning, then a
    sort inside each file), so a reader that follows file order sees it.
    ``json`` writes one JSON array per file (a document per file, read with
    ``multiLine``); ``jsonl`` writes a record per line.
    """
    out = df
    if order_by is not None:
        n = files or max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")))
        out = out.repartitionByRange(n, order_by).sortWithinPartitions(order_by)
    fmt = file_format.lower()
    if fmt == "csv":
        _writer(out).csv(path)
    elif fmt == "parquet":
        out.write.parquet(path)
    elif fmt == "jsonl":
        out.write.json(path)
    elif fmt == "json":
        lines = out.select(F.to_json(F.struct(*[F.col(c) for c in out.columns])).alias("value"))

        def as_array(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            first = True
            for pdf in it:
                if pdf.empty:
                    continue
                v = pdf["value"].astype(str)
                prefix = pd.Series([","] * len(v))
                if first:
                    prefix.iloc[0] = "["
                    first = False
                yield pd.DataFrame({"value": prefix.values + v.values})
            yield pd.DataFrame({"value": ["[]" if first else "]"]})

        lines.mapInPandas(as_array, "value string").write.text(path)
    else:
        raise ValueError(f"unknown file format {file_format!r}")
    return path
