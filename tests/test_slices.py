"""Slice-apply data plane: golden sample, pandas differential, edge cases."""

from __future__ import annotations

import math
import random

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sliceflow.operators import rollup, slices
from sliceflow.sources import artifacts as A
from sliceflow.sources import readers as R

# The nine rows of the sample data set.
SAMPLE = [("IN", 1000.0, "2024-01"), ("IN", 2000.0, "2024-02"), ("US", 5000.0, "2024-01"),
          ("US", 3000.0, "2024-02"), ("EU", 4000.0, "2024-01"), ("EU", 2500.0, "2024-02"),
          ("IN", 1500.0, "2024-03"), ("US", 6000.0, "2024-03"), ("EU", 3500.0, "2024-03")]


def sample_df(spark):
    rows = [(i, *r) for i, r in enumerate(SAMPLE)]
    return spark.createDataFrame(rows, "idx long, region string, revenue double, date string")


def sizes_by_dealing(n: int, total: int) -> list[int]:
    """Rows dealt one after the other: a slice takes rows until it has its
    share, the last takes whatever is left."""
    share, sizes, at = max(1, n // total), [0] * total, 0
    for _ in range(n):
        if sizes[at] == share and at < total - 1:
            at += 1
        sizes[at] += 1
    return sizes


def test_golden_by_slice(spark):
    got = {(r.partition_index, r.region): (r.total_revenue, r.avg_revenue, r.row_count)
           for r in rollup.region_rollup_by_slice(sample_df(spark), "idx", 3).collect()}
    assert got == {
        (0, "IN"): (3000.0, 1500.0, 2), (0, "US"): (5000.0, 5000.0, 1),
        (1, "EU"): (6500.0, 3250.0, 2), (1, "US"): (3000.0, 3000.0, 1),
        (2, "EU"): (3500.0, 3500.0, 1), (2, "IN"): (1500.0, 1500.0, 1),
        (2, "US"): (6000.0, 6000.0, 1)}


def test_golden_merged_is_not_mean_of_means(spark):
    merged = {r.region: (r.total_revenue, r.avg_revenue, r.row_count)
              for r in rollup.region_rollup(sample_df(spark)).collect()}
    assert merged["IN"] == (4500.0, 1500.0, 3)
    assert merged["US"][0] == 14000.0 and merged["US"][2] == 3
    assert merged["EU"][0] == 10000.0 and math.isclose(merged["EU"][1], 10000 / 3)
    part = rollup.region_rollup_by_slice(sample_df(spark), "idx", 3)
    again = {r.region: r.avg_revenue for r in rollup.merge_rollup(part).collect()}
    assert math.isclose(again["EU"], 10000 / 3)  # mean of slice means would be 3375


@pytest.mark.parametrize("n,total,expect", [
    (0, 3, [0, 0, 0]), (1, 3, [1, 0, 0]), (2, 3, [1, 1, 0]), (3, 3, [1, 1, 1]),
    (7, 3, [2, 2, 3]), (100, 8, [12] * 7 + [16])])
def test_slice_size_edges(spark, n, total, expect):
    assert sizes_by_dealing(n, total) == expect
    df = spark.range(n).withColumnRenamed("id", "k")
    got = [0] * total
    for r in slices.slice_rows(df, "k", total).groupBy("partition_index").count().collect():
        got[r["partition_index"]] = r["count"]
    assert got == expect
    plan = slices.plan_slices(df, "k", total)
    assert plan.slice_sizes() == expect


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_slices_differential_many_buckets(spark, seed):
    """Random sparse keys, small buckets: boundary search across buckets."""
    rnd = random.Random(seed)
    for n in (2, 7, 100, 257):
        keys = rnd.sample(range(-10_000, 10_000), n)
        total = rnd.choice([1, 3, 5, 8])
        df = spark.createDataFrame([(k,) for k in keys], "k long")
        got = {r.k: r.partition_index for r in
               slices.assign_slices(df, slices.plan_slices(df, "k", total, rows_per_bucket=9))
               .collect()}
        order = sorted(keys)
        rpp = max(1, n // total)
        want = {k: min(i // rpp, total - 1) for i, k in enumerate(order)}
        assert got == want, (n, total)


def test_slices_on_timestamp_key(spark):
    pdf = pd.DataFrame({"ts": pd.date_range("2024-01-01", periods=50, freq="37min")})
    df = spark.createDataFrame(pdf).select(F.col("ts").cast("timestamp_ntz").alias("ts"))
    got = sorted((r.ts, r.partition_index) for r in slices.slice_rows(df, "ts", 4).collect())
    assert [p for _, p in got] == [min(i // 12, 3) for i in range(50)]


def test_shape_summary_counts_empty_slices(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x long, y string")
    got = {(r.partition_index, r.metric): r.value for r in rollup.shape_summary(df, 3).collect()}
    assert got == {(0, "row_count"): 1, (1, "row_count"): 1, (2, "row_count"): 0,
                   (0, "col_count"): 2, (1, "col_count"): 2, (2, "col_count"): 2}


def _stats(pdf, params):
    return pd.DataFrame({"n": [len(pdf)], "first": [pdf["k"].min() if len(pdf) else None],
                         "tag": [params.get("tag")]})


def _merge(parts, params):
    return pd.DataFrame({"n": [parts["n"].sum()], "first": [parts["first"].min()],
                         "tag": [params.get("tag")]})


def test_slice_apply_calls_every_slice(spark):
    df = spark.createDataFrame([(5,), (9,)], "k long")
    got = {r.partition_index: (r.n, r.first) for r in
           slices.slice_apply(df, _stats, "n long, first long, tag string", "k", 3,
                              params={"tag": "x"}).collect()}
    assert got == {0: (1, 5), 1: (1, 9), 2: (0, None)}


def test_slice_apply_two_phase_equals_one_phase(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    one = sorted(tuple(r) for r in slices.slice_apply(
        df, _stats, "n long, first long, tag string", "k", 3).collect())
    two = sorted(tuple(r) for r in slices.slice_apply(
        df, _stats, "n long, first long, tag string", "k", 3, merge=_merge,
        max_rows_per_group=50, rows_per_bucket=40).collect())
    assert one == two
    seen = slices.slice_apply(df, lambda p, q: pd.DataFrame({"n": [len(p)]}), "n long", "k", 3,
                              merge=lambda p, q: pd.DataFrame({"n": [p["n"].max()]}), max_rows_per_group=50)
    assert max(r.n for r in seen.collect()) <= 50


def test_job_contract(spark):
    df = spark.range(3).withColumnRenamed("id", "k")
    with pytest.raises(ValueError):
        slices.slice_apply(df, None, "n long", "k", 3)
    with pytest.raises(Exception, match="gave no DataFrame for slice"):
        slices.slice_apply(df, lambda p, q: None, "n long", "k", 3).collect()


def test_csv_pandas_null_rules(spark, tmp_out):
    path = f"{tmp_out}/nulls.csv"
    with open(path, "w") as f:
        f.write("region,revenue\nNA,10\nUS,\n,5\nEU,7\n")
    df = R.read_csv(spark, path)
    assert dict(df.dtypes) == {"region": "string", "revenue": "double"}  # gaps -> float
    got = {r.region: (r.total_revenue, r.avg_revenue, r.row_count)
           for r in rollup.region_rollup(df).collect()}
    assert got == {"EU": (7.0, 7.0, 1), "US": (0.0, None, 0)}


def test_csv_month_text_is_not_a_timestamp(spark, tmp_out):
    path = f"{tmp_out}/m.csv"
    with open(path, "w") as f:
        f.write("region,revenue,date\nIN,1000,2024-01\nUS,N/A,2024-02\n")
    df = R.read_csv(spark, path)
    assert dict(df.dtypes) == {"region": "string", "revenue": "double", "date": "string"}


def test_file_order_slices_across_files(spark, tmp_out):
    df = spark.range(103).withColumnRenamed("id", "k").withColumn("v", F.col("k") * 2)
    path = f"{tmp_out}/ordered"
    A.write_dataset(df, path, "csv", order_by="k", files=5)
    back = R.read_csv(spark, path)
    got = {r.k: r.partition_index for r in slices.slice_rows_in_file_order(back, 4).collect()}
    assert got == {k: min(k // 25, 3) for k in range(103)}


def test_formats_round_trip(spark, tmp_out):
    df = sample_df(spark)
    for fmt in ("csv", "parquet", "json", "jsonl"):
        path = f"{tmp_out}/d-{fmt}"
        A.write_dataset(df, path, fmt)
        back = R.read_dataset(spark, path, fmt,
                              schema=None if fmt == "csv" else
                              "idx long, region string, revenue double, date string")
        assert sorted(tuple(r) for r in back.select("idx", "region", "revenue", "date")
                      .collect()) == sorted((i, *r) for i, r in enumerate(SAMPLE)), fmt


def spread(df, params):
    """A user's job: smallest and largest revenue and number of months by region."""
    found = {}
    for region, revenue, month in zip(df["region"], df["revenue"], df["date"]):
        lo, hi, months = found.get(region, (revenue, revenue, set()))
        found[region] = min(lo, revenue), max(hi, revenue), months | {month}
    return pd.DataFrame([(k, lo, hi, len(m)) for k, (lo, hi, m) in found.items()],
                        columns=["region", "lowest", "highest", "months"])


def test_run_slice_job_user_and_native_match_golden(spark, tmp_out):
    from sliceflow.operators.jobs import run_slice_job

    path = f"{tmp_out}/sample.csv"
    with open(path, "w") as f:
        f.write("region,revenue,date\n")
        for r in SAMPLE:
            f.write(f"{r[0]},{int(r[1])},{r[2]}\n")
    want = {(0, "IN"): (3000.0, 1500.0, 2), (0, "US"): (5000.0, 5000.0, 1),
            (1, "EU"): (6500.0, 3250.0, 2), (1, "US"): (3000.0, 3000.0, 1),
            (2, "EU"): (3500.0, 3500.0, 1), (2, "IN"): (1500.0, 1500.0, 1),
            (2, "US"): (6000.0, 6000.0, 1)}
    user = run_slice_job(spark, path, "csv", fn=spread, schema="region string, lowest double, highest double, months long",
                         output_path=f"{tmp_out}/user")
    assert {(r.partition_index, r.region): (r.lowest, r.highest, r.months) for r in user.results.collect()} == {
        (0, "IN"): (1000.0, 2000.0, 2), (0, "US"): (5000.0, 5000.0, 1), (1, "US"): (3000.0, 3000.0, 1), (1, "EU"): (2500.0, 4000.0, 2),
        (2, "IN"): (1500.0, 1500.0, 1), (2, "US"): (6000.0, 6000.0, 1), (2, "EU"): (3500.0, 3500.0, 1)}
    native = run_slice_job(spark, path, "csv", output_path=f"{tmp_out}/native")
    got = {(r.partition_index, r.region): (r.total_revenue, r.avg_revenue, r.row_count) for r in native.results.collect()}
    assert got == want
    # more slices than rows: every slice has an artifact
    wide = run_slice_job(spark, path, "csv", total=12, output_path=f"{tmp_out}/wide")
    for res, n in ((user, 3), (native, 3), (wide, 12)):
        assert sorted(r.partition_index for r in res.manifest.collect()) == list(range(n))
        assert all(r.size_bytes > 0 for r in res.manifest.collect())


def test_many_buckets_use_binary_search(spark):
    """Very many parts and boundaries, and keys that a double can't hold."""
    rnd = random.Random(11)
    keys = rnd.sample(range(2**60, 2**60 + 10**5), 3000)
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    plan = slices.plan_slices(df, "k", 7, rows_per_bucket=100)
    got = {r.k: r.partition_index for r in slices.assign_slices(df, plan).collect()}
    rpp = 3000 // 7
    assert got == {k: min(i // rpp, 6) for i, k in enumerate(sorted(keys))}
    many = slices.plan_slices(df, "k", 300, rows_per_bucket=100)
    got = {r.k: r.partition_index for r in slices.assign_slices(df, many).collect()}
    assert got == {k: min(i // 10, 299) for i, k in enumerate(sorted(keys))}



@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=st.lists(st.integers(-10**12, 10**12), min_size=0, max_size=80, unique=True),
       total=st.integers(1, 9), rows_per_bucket=st.integers(1, 40))
def test_slices_property(spark, keys, total, rows_per_bucket):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    plan = slices.plan_slices(df, "k", total, rows_per_bucket=rows_per_bucket)
    got = {r.k: r.partition_index for r in slices.assign_slices(df, plan).collect()}
    rpp = max(1, len(keys) // total)
    assert got == {k: min(i // rpp, total - 1) for i, k in enumerate(sorted(keys))}
    assert plan.slice_sizes() == sizes_by_dealing(len(keys), total)


@pytest.mark.parametrize("kind,values", [
    ("string", [f"id-{i * 7919 % 1000:03d}-é" for i in range(100)]),
    ("timestamp_ntz", [f"2024-03-10 {1 + i // 60:02d}:{i % 60:02d}:00.000001" for i in range(100)]),
    ("date", [f"20{i:02d}-02-28" for i in range(100)]),
    ("decimal(38,2)", [f"{10**30 + i}.25" for i in range(100)]),
    ("double", [str(i / 7) for i in range(100)])])
def test_keys_of_any_type(spark, kind, values):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # clocks change on 2024-03-10
    try:
        df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "t string, i int").withColumn("k", F.col("t").cast(kind))
        got = [r.p for r in slices.slice_rows(df.repartition(4), "k", 7, "p").orderBy("k").select("p").collect()]
        assert got == [min(i // 14, 6) for i in range(100)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_repeated_and_missing_keys_are_refused(spark):
    for n in (40, 4000):
        df = spark.range(n).select((F.col("id") % (n - 1)).alias("k"))
        with pytest.raises(ValueError, match="repeats"):
            slices.plan_slices(df, "k", 3, rows_per_bucket=500)
    with pytest.raises(ValueError, match="nulls"):
        slices.plan_slices(spark.createDataFrame([(1,), (None,)], "k long"), "k", 3)


def test_file_order_survives_other_splits(spark, tmp_out):
    """The scan is cut differently between making and running the plan."""
    path = f"{tmp_out}/big"
    A.write_dataset(spark.range(20_000).withColumnRenamed("id", "k"), path, "csv", order_by="k", files=3)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    try:
        spark.conf.set(names[0], "20k")
        spark.conf.set(names[1], "1")
        t = slices.slice_rows_in_file_order(R.read_csv(spark, path, multi_line=False), 7)
        spark.conf.set(names[0], "7k")
        spark.conf.set(names[2], "50")
        rows = sorted((r.k, r.partition_index) for r in t.collect())
    finally:
        for n in names:
            spark.conf.unset(n)
    assert rows == [(k, min(k // 2857, 6)) for k in range(20_000)]


CSV = 'a,b,c,d,e,f\n"x ""y"", z",1d, pad ,1,True,1e3\n"two\nlines",2f,q,2,false,.5\n" ",3,NA,3,TRUE, 7\n'


def test_csv_reads_as_pandas_does(spark, tmp_out):
    path = f"{tmp_out}/q.csv"
    with open(path, "w") as f:
        f.write(CSV)
    got, want = R.read_csv(spark, path), pd.read_csv(path)
    kinds = {"int64": "bigint", "float64": "double", "object": "string", "bool": "boolean"}
    assert dict(got.dtypes) == {c: kinds[str(t)] for c, t in want.dtypes.items()}
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in want.itertuples(index=False)]
    assert [tuple(r) for r in got.collect()] == rows


def test_artifacts_keep_text(spark, tmp_out):
    rows = [(0, " pad "), (0, ""), (0, None), (1, 'q "x", y'), (1, "two\nlines"), (1, "\ttab"), (3, "NA")]
    df = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(rows)], "i int, partition_index int, t string")
    path = A.write_artifacts(df, f"{tmp_out}/text", total=4)
    back = A.read_artifacts(spark, path, "i int, t string, partition_index int")
    assert sorted((r.i, r.partition_index, r.t) for r in back.collect()) == [(i, p, t) for i, (p, t) in enumerate(rows)]
    assert sorted(r.partition_index for r in A.artifact_manifest(spark, path).collect()) == [0, 1, 2, 3]


@pytest.mark.parametrize("query", ["job_parameters", "slice_job"])
def test_registered_jobs_run_on_parts_of_slices(spark, monkeypatch, query):
    from conftest import SF0001
    from sliceflow.plans import slice_queries, source_queries

    run, apply, merges = (slice_queries.QUERIES | source_queries.QUERIES)[query], slices.slice_apply, []

    def in_parts(*args, merge=None, **kw):
        merges.append(merge)
        return apply(*args, merge=merge, max_rows_per_group=100, **kw)

    monkeypatch.setattr(slices, "slice_apply", in_parts)
    got = sorted(map(str, run(spark, SF0001).collect()))
    monkeypatch.setattr(slices, "slice_apply", lambda *args, merge=None, **kw: apply(*args, **kw))
    assert merges and all(merges) and got == sorted(map(str, run(spark, SF0001).collect()))
