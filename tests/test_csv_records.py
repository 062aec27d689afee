"""S1 on files that are cut inside quoted fields: the rows that pandas reads."""

import io
import random

import pandas as pd
import pytest

from sliceflow.operators import slices
from sliceflow.sources import readers as R
from sliceflow.sources.csv_records import _names, csv_records, read_csv_text

PIECES = ['"a, b"', '"he said ""no"""', '"line\nfeed"', '""', "plain", '"\n\n"', '"""\n"', "5 feet", 'x"y', "", '"cr\r\nlf"', "é", '","', '"\n,\n"', "'", " "]


def _file(rows, seed=1, end="\n"):
    rng = random.Random(seed)
    lines = ["id,text,note"]
    for i in range(rows):
        lines.append(f"{i},{rng.choice(PIECES)},{rng.choice(PIECES)}")
        if rng.random() < 0.05:
            lines.append("")
    return end.join(lines) + end


def _pandas(text):
    return pd.read_csv(io.StringIO(text, newline=""), dtype=str, keep_default_na=False).fillna("").values.tolist()


@pytest.mark.parametrize("end,split", [("\n", "2k"), ("\r\n", "1k"), ("\n", "64m")])
def test_rows_are_those_of_pandas(spark, tmp_path, end, split):
    text = _file(900, end=end)
    (tmp_path / "a.csv").write_text(text, newline="")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    opened = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = R.read_csv(spark, str(tmp_path), pandas_nulls=False, infer=False, position="_at").orderBy("_at").collect()
        if split != "64m":
            assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() >= 6
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.set("spark.sql.files.openCostInBytes", opened)
    assert [r["_at"] for r in got] == list(range(900))
    assert [["" if x is None else x for x in r[:3]] for r in got] == _pandas(text)


def test_several_files_and_types(spark, tmp_path):
    for name in ("b", "a", "c"):
        (tmp_path / f"{name}.csv").write_text(f'k,v\n1,"{name}\n1"\n2,NA\n\n3,"{name} ""3"""')
    got = R.read_csv(spark, str(tmp_path), position="at")
    assert dict(got.dtypes) == {"k": "bigint", "v": "string", "at": "bigint"}
    assert [tuple(r) for r in got.orderBy("at").collect()] == [
        x for i, n in enumerate("abc") for x in ((1, f"{n}\n1", 3 * i), (2, None, 3 * i + 1), (3, f'{n} "3"', 3 * i + 2))]
    sliced = slices.slice_rows_by_position(got, "at", 4).collect()
    assert sorted(r["partition_index"] for r in sliced) == [0, 0, 1, 1, 2, 2, 3, 3, 3]


def test_a_field_that_is_never_closed_ends_with_its_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,v\n1,"open\n2,x\n3,y\n')
    (tmp_path / "b.csv").write_text("k,v\n9,z\n")
    got = {(r["file"][-5:], r["record"]): r["text"] for r in csv_records(spark, str(tmp_path)).collect()}
    assert got == {("a.csv", 0): "k,v", ("a.csv", 1): '1,"open\n2,x\n3,y', ("b.csv", 0): "k,v", ("b.csv", 1): "9,z"}


def test_long_lines_do_not_overflow(spark, tmp_path):
    field = 'w ""q"" ' * 60_000
    (tmp_path / "a.csv").write_text(f'k,v\n1,"{field}\n{field}"\n' + ",".join(["2", *['"x"'] * 30_000]) + "\n")
    got = csv_records(spark, str(tmp_path)).where("record = 1").first()
    assert got["text"] == f'1,"{field}\n{field}"'


def test_names_and_no_rows(spark, tmp_path):
    assert _names('a,"b\nc",a,,a') == ["a", "b\nc", "a.1", "Unnamed: 3", "a.2"]
    (tmp_path / "a.csv").write_text("a,b\n")
    assert R.read_csv(spark, str(tmp_path)).collect() == []
    assert R.read_csv(spark, str(tmp_path), header=False, infer=False).collect()[0].asDict() == {"_c0": "a", "_c1": "b"}


def test_rows_of_a_file_do_not_meet_in_a_task(spark, tmp_out):
    spark.createDataFrame([(i, f"a\n{i}") for i in range(20)], "i int, t string").repartitionByRange(2, "i").write.option("header", True).option("escape", '"').csv(tmp_out + "/x")
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        df = read_csv_text(spark, tmp_out + "/x", position="at")
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(file" not in plan.split("BroadcastExchange")[0] and "BroadcastHashJoin" in plan
        assert [tuple(r) for r in df.orderBy("at").collect()] == [(str(i), f"a\n{i}", i) for i in range(20)]
    finally:
        spark.conf.set(key, old)


def test_large_documents_are_written_to_more_files(spark, monkeypatch):
    from conftest import SF0001
    from sliceflow.plans import source_queries as Q

    made = []
    write = Q.A.write_dataset
    monkeypatch.setattr(Q, "CSV_FILE_BYTES", 100_000)
    monkeypatch.setattr(Q.A, "write_dataset", lambda df, path, *a, **kw: (made.append(path), write(df, path, *a, **kw)))
    got = [r["doc_id"] for r in Q.q_read_csv_multiline(spark, SF0001).orderBy("position").select("doc_id").collect()]
    assert got == sorted(got) and len(got) == spark.read.parquet(f"{SF0001}/documents.parquet").count()
    assert len(spark.read.text(made[0]).inputFiles()) > 2
