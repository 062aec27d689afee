"""Stages of the pipeline give rows back with their own columns, whatever these are."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from conftest import SF0001

TEXTS = ["one two three four five six seven eight nine ten " * 3, "alpha beta gamma delta epsilon zeta eta theta " * 4, None, "", "short"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i != 7 else None, TEXTS[i % 5] if i < 10 else f"{TEXTS[0]} tail number {i} goes on and on", "en", f"s{i % 3}" if i % 4 else None, 5, i, i + 1, i + 2, f"t{i}", {"a": i}, [i], 2.5)
            for i in range(24)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size int, a1 int, _row int, Toxicity string, tags map<string,int>, key array<int>, score double")
    return df.withColumnRenamed("a1", "second")


@pytest.mark.parametrize("stage", [P.toxicity, P.near_duplicates, P.mixing])
def test_columns_come_back(spark, docs, stage):
    docs = docs.withColumn("taken", F.lit("mine"))
    got = stage(spark, docs, SF0001)
    assert got.dtypes == docs.dtypes
    given = {str(r) for r in docs.collect()}
    back = [str(r) for r in got.collect()]
    assert back and set(back) <= given
    if stage is P.near_duplicates:
        assert len(set(back)) == len(back)


def test_rows_of_a_null_id_link_others(spark):
    from sliceflow.llm.shingle_join import similar_documents

    words = [f"w{i}" for i in range(400)]
    chain = [" ".join(words), " ".join(words[:-9] + ["x"] * 9), " ".join(words[:-9] + ["x"] * 9).replace("w0 w1 w2 w3 w4 w5 w6 w7 ", "")]
    docs = spark.createDataFrame([(1, chain[0]), (None, chain[1]), (3, chain[2]), (4, "another text altogether here"), (None, chain[1])], "doc_id long, text string")
    got = sorted(map(tuple, similar_documents(docs, 3, 95).collect()), key=str)
    assert {r[0]: r[2] for r in got} == {1: 1, 3: 1, 4: 4, None: None}
    assert len(got) == 5
