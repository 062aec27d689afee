"""A slice job end to end (submit and compute, SURVEY §3.1):
read a dataset -> contiguous slices -> user function (or the native job)
-> one artifact per slice -> manifest.  Spark's scheduler, task retry and
shuffle stand in for the platform's scheduler, workers and queues."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path
from ..sources import artifacts as A
from ..sources import readers as R
from . import rollup, slices


@dataclass
class JobResult:
    output_path: str
    results: DataFrame      # per-slice output, with partition_index
    manifest: DataFrame     # one row per artifact file


def run_slice_job(spark: SparkSession, path: str, file_format: str = "csv",
                  fn: Callable[[pd.DataFrame, dict], pd.DataFrame] | None = None,
                  schema: str | None = None, total: int = 3, key: str | None = None,
                  params: dict | None = None,
                  merge: Callable[[pd.DataFrame, dict], pd.DataFrame] | None = None,
                  output_path: str | None = None, files_per_slice: int = 1) -> JobResult:
    """Run one job over a dataset.

    * ``key``: order of the rows for slicing; without it, the order of the
      rows in the files (exact positions, no sort).
    * ``fn``/``schema``: the user's ``run(df, params)``; without ``fn`` the
      native sample job runs (region rollup, or the shape summary when the
      columns are absent).
    * ``files_per_slice``: writers of each slice's output.  Every slice has an artifact and
      a manifest row, also without rows.
    """
    df = R.read_dataset(spark, path, file_format)
    order = key
    if order is None:
        df = slices.file_row_index(df, "_row")  # exact file order, no sort
        order = "_row"
    if fn is None:
        out = rollup.analyze_slices(df, order, total)
    else:
        if schema is None:
            raise ValueError("a job function needs its output schema")
        user_fn = fn
        if key is None:
            def user_fn(pdf, p, _f=fn):  # hide the helper position column
                return _f(pdf.drop(columns=["_row"]), p)
        out = slices.slice_apply(df, user_fn, schema, order, total, params=params, merge=merge)
    target = output_path or scratch_path(spark, "job")
    A.write_artifacts(out, target, files_per_slice=files_per_slice, total=total)
    return JobResult(target, A.read_artifacts(spark, target, _ddl(out)),
                     A.artifact_manifest(spark, target))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
