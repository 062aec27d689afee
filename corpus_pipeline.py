"""From raw documents to packed training sequences, in four stages.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before
kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sliceflow.llm.common import spill
from sliceflow.llm.mixing import mixed_documents
from sliceflow.llm.packing import pack_documents
from sliceflow.llm.shingle_join import similar_documents
from sliceflow.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by a Jaccard similarity of 0.8 of their five-word shingles, that
    with the smallest doc_id stays (of equal ids by a hash of the text, null last). An id
    is a name only: rows that repeat one, or have none, are linked by their texts like
    others. Rows of the same id and text are one, that whose other columns come first as JSON.
    Columns of any name and type come back as they were. Rows whose hashes meet by
    chance all stay."""
    at = {name: i for i, name in reversed(list(enumerate(docs.columns)))}
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    doc_id, text = F.col(f"c{at['doc_id']}"), F.col(f"c{at['text']}")
    rest = [c for i, c in enumerate(plain.columns) if i not in (at["doc_id"], at["text"])]
    rows = plain.select(F.struct(*plain.columns).alias("row"), doc_id.alias("doc_id"), text.alias("text"), F.to_json(F.struct(F.lit(0).alias("_"), *rest)).alias("rest"),
                        F.xxhash64(doc_id.isNull(), doc_id, text.isNull(), text).alias("key"), F.xxhash64(text, F.lit("second"), doc_id).alias("second"))
    group = similar_documents(rows, k=5, percent=80, id_col="key").select(F.col("doc_id").alias("key"), "component_id").distinct()
    names = spill(rows.select("key", "second", "doc_id").distinct(), "names")
    first = (names.join(group, "key").groupBy("component_id")
             .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("first")).select("first.key"))
    met = names.groupBy("key").agg(F.min("second").alias("lo"), F.max("second").alias("hi")).where("lo <> hi").select("key")
    kept = rows.select("key", "second", "row", "rest").join(first.union(met).distinct(), "key", "left_semi")
    one = kept.groupBy("key", "second").agg(F.min_by("row", "rest").alias("row"))
    return one.select(*[F.col(f"row.c{i}").alias(name) for i, name in enumerate(docs.columns)])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 2048 tokens."""
    return pack_documents(docs)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("mixing", mixing), ("packing", packing)]

#: a classifier, similarity joins and tokenizers are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = spill(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
