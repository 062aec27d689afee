"""Scalar helpers (X1-X10) and operator options not covered by the oracle keys."""

from __future__ import annotations

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from sliceflow.functions import exprs as X
from sliceflow.operators import changes as M
from sliceflow.operators import history as H
from sliceflow.sources import artifacts as A
from sliceflow.session import checkpoint_root
from sliceflow.sources import readers as R
from sliceflow.sources import topics as TP


def test_percent_complete_half_up_and_zero_total(spark):
    df = spark.createDataFrame([(1, 8), (0, 0), (2, 3), (5, 5)], "done long, total long")
    got = [r.p for r in df.select(X.percent_complete("done", "total").alias("p")).collect()]
    assert got == [13.0, 0.0, 67.0, 100.0]  # 12.5 rounds half up


def test_uuid_and_short_id(spark):
    df = spark.createDataFrame([("123e4567-e89b-12d3-a456-426614174000",),
                                ("{123e4567-e89b-12d3-a456-426614174000}",),
                                ("not-a-uuid",), (None,)], "id string")
    got = df.select(X.is_uuid("id").alias("ok"), X.short_id("id").alias("s")).collect()
    assert [r.ok for r in got] == [True, False, False, False]
    assert got[0].s == "123e4567"


def test_split_key_size(spark):
    df = spark.createDataFrame([("artifacts/r/partition-0.csv:123",), ("a:b:7",),
                                ("no-size",), ("x:bad",)], "value string")
    got = [tuple(r) for r in A.parse_runner_lines(df).collect()]
    assert got == [("artifacts/r/partition-0.csv", 123), ("a", 0), ("no-size", 0), ("x", 0)]


def test_json_field_tolerates_bad_json(spark):
    df = spark.createDataFrame([('{"job_id": "j1", "workspace_id": "w"}',), ("{broken",)],
                               "payload string")
    assert [r.j for r in df.select(X.json_field("payload", "job_id").alias("j")).collect()] \
        == ["j1", None]


def test_keys_and_stable_ids(spark):
    df = spark.createDataFrame([(7, 2)], "run long, i int")
    r = df.select(X.artifact_key("run", "i").alias("k"),
                  X.stable_id("run", "i").alias("a"), X.stable_id("run", "i").alias("b")).first()
    assert r.k == "artifacts/7/partition-2.csv" and r.a == r.b and len(r.a) == 64


def test_current_state_terminal_sticky(spark):
    log = spark.createDataFrame(
        [("j", 1, "QUEUED"), ("j", 2, "CANCELLED"), ("j", 3, "QUEUED"), ("k", 1, "RUNNING")],
        "id string, seq int, state string")
    plain = {r.id: r.state for r in M.current_state(log, "id", ["seq"], ["state"]).collect()}
    sticky = {r.id: r.state for r in M.current_state(
        log, "id", ["seq"], ["state"], terminal=("SUCCEEDED", "FAILED", "CANCELLED")).collect()}
    assert plain == {"j": "QUEUED", "k": "RUNNING"}  # the reference's unguarded update
    assert sticky == {"j": "CANCELLED", "k": "RUNNING"}


def test_retention_apply_writes_kept_rows(spark, tmp_out):
    df = spark.createDataFrame([(1, "DELIVERED"), (2, "PENDING"), (3, None)],
                               "id long, status string")
    path = M.retention_apply(df, F.col("status") == "DELIVERED", f"{tmp_out}/kept")
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [2, 3]


def test_catalog_sizes_and_formats(spark):
    cat = R.dataset_catalog(spark, SF0001).collect()
    assert len(cat) == 14 and all(r.size_bytes > 0 and r.file_format == "parquet" for r in cat)


def test_cancel_cascade_marks_unfinished_tasks_dead(spark):
    runs = spark.createDataFrame([(1, 10, "RUNNING"), (2, 11, "RUNNING")],
                                 "id long, job_id long, state string")
    tasks = spark.createDataFrame([(1, 0, "PENDING"), (1, 1, "SUCCEEDED"), (2, 0, "LEASED")],
                                  "run_id long, partition_index int, state string")
    jobs = spark.createDataFrame([(10,)], "id long")
    r2, t2 = M.cancel_cascade(tasks, runs, jobs)
    assert {r.id: r.state for r in r2.collect()} == {1: "CANCELLED", 2: "RUNNING"}
    assert sorted(tuple(r) for r in t2.collect()) == [
        (1, 0, "DEAD"), (1, 1, "SUCCEEDED"), (2, 0, "LEASED")]


def test_retry_eligibility_permanent_errors(spark):
    t = spark.createDataFrame([(1, 0, 0, "transient"), (1, 1, 0, "permanent"), (1, 2, 3, "transient")],
                              "run_id long, partition_index int, retry_count int, kind string")
    runs = spark.createDataFrame([(1, 5)], "id long, job_id long")
    jobs = spark.createDataFrame([(5, 3)], "id long, max_retries int")
    got = {r.partition_index: r.can_retry for r in
           H.retry_eligibility(t, runs, jobs, F.col("kind")).collect()}
    assert got == {0: True, 1: False, 2: False}


def test_gauges_running_sum(spark):
    pdf = pd.DataFrame({"ts": pd.to_datetime(["2024-01-01 00:00:01", "2024-01-01 00:00:05",
                                              "2024-01-01 00:00:12", "2024-01-01 00:00:31"]),
                        "series": ["p", "p", "p", "p"], "delta": [1, 1, -1, 1]})
    df = spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = [(r.delta, r.value) for r in
           H.gauge_series(df, "ts", "series", "delta", 10).orderBy("tick").collect()]
    assert got == [(2, 2), (-1, 1), (1, 2)]


def test_catalog_parses_object_key_layout(spark, tmp_out):
    keys = spark.createDataFrame([("w1", "d7", "sales", "csv")],
                                 "ws string, ds string, name string, fmt string") \
        .select(X.dataset_key("ws", "ds", "name", "fmt").alias("k")).first().k
    assert keys == "w1/d7/sales.csv"
    os.makedirs(f"{tmp_out}/w1/d7")
    with open(f"{tmp_out}/{keys}", "w") as f:
        f.write("region,revenue\nIN,1\n")
    r = R.dataset_catalog(spark, tmp_out).first()
    assert (r.workspace_id, r.dataset_id, r.name, r.file_format, r.state) == \
        ("w1", "d7", "sales", "csv", "READY")
    assert r.size_bytes == len("region,revenue\nIN,1\n")


def test_read_history_schema_and_validity(spark, tmp_out):
    rows = [("123e4567-e89b-12d3-a456-426614174000", "r1", "w", "PENDING", 0),
            ("123e4567-e89b-12d3-a456-426614174001", "r1", "w", "BOGUS", 1),
            ("nope", "r1", "w", "LEASED", 2)]
    spark.createDataFrame(rows, "id string, run_id string, workspace_id string, state string, "
                                "partition_index int").write.json(f"{tmp_out}/tasks")
    df = R.read_history(spark, f"{tmp_out}/tasks", table="tasks", fmt="json")
    assert df.columns[:5] == ["id", "run_id", "workspace_id", "state", "partition_index"]
    assert dict(df.dtypes)["lease_expires_at"] == "timestamp_ntz"
    good, bad = R.split_valid(df, "tasks")
    assert [r.partition_index for r in good.collect()] == [0]
    assert sorted((r.partition_index, r.error) for r in bad.collect()) == [
        (1, "invalid state"), (2, "invalid id")]


def test_write_artifacts_spreads_large_slices(spark, tmp_out):
    df = spark.range(400).selectExpr("id", "CAST(id % 2 AS INT) AS partition_index")
    path = A.write_artifacts(df, f"{tmp_out}/art", files_per_slice=4)
    man = A.artifact_manifest(spark, path).collect()
    assert {r.partition_index for r in man} == {0, 1}
    assert max(sum(1 for r in man if r.partition_index == i) for i in (0, 1)) > 1
    back = A.read_artifacts(spark, path, "id long, partition_index int")
    assert sorted(r.id for r in back.collect()) == list(range(400))


def test_updates_of_one_id_are_folded(spark):
    base = spark.createDataFrame([(1, "a", "free"), (2, "b", "free")], "id long, name string, plan string")
    up = spark.createDataFrame([(1, "x", None, 1), (1, None, "pro", 2), (1, "y", None, 3)], "id long, name string, plan string, seq int")
    got = M.partial_update(base, up, "id", ["name", "plan"], ["seq"])
    assert sorted(map(tuple, got.collect())) == [(1, "y", "pro"), (2, "b", "free")]
    with pytest.raises(Exception, match="several updates"):
        M.partial_update(base, up.drop("seq"), "id", ["name", "plan"]).collect()


def test_retried_task_waits_without_a_lease(spark):
    log = spark.createDataFrame([("a", 1, "LEASED", None, 10), ("a", 2, "FAILED", "boom", 20), ("b", 1, "FAILED", "old", 5), ("b", 2, "LEASED", None, 30)],
                                "id string, seq int, state string, err string, lease int")
    got = M.retried_tasks(log, "id", ["seq"], "state", F.col("state") == "FAILED", "err", F.col("lease"))
    assert sorted(map(tuple, got.collect())) == [("a", 1, "boom", "PENDING", None), ("b", 1, "old", "LEASED", 30)]


def test_headers_travel_with_records(spark, tmp_out):
    df = spark.createDataFrame([(1, "v")], "id long, v string")
    TP.write_topic(TP.to_records(df, "id", ["v"], "t", {"trace": F.lit("abc")}), f"{tmp_out}/topic")
    r = TP.read_topic(spark, f"{tmp_out}/topic").select(TP.header("trace").alias("a"), TP.header("none").alias("b")).first()
    assert (r.a, r.b) == ("abc", None)


def test_no_private_scratch_on_a_cluster(monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())
