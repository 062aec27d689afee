"""Event topics (S8, S9): records as ``(key, value JSON)``.

Records may carry headers.  In a deployment the topic is Kafka (``format("kafka")`` with the broker
options); offline and in tests it is a folder of parquet files with the same
columns, read as a batch or as a stream.  No Kafka client code lives here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Timestamps in record values keep microseconds (the JSON default is millis).
JSON_TS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
           "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}

TOPIC_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("headers", T.ArrayType(T.StructType([
        T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())]))),
])


def to_records(df: DataFrame, key: str, value_cols: list[str], topic: str,
               headers: dict[str, Column] | None = None) -> DataFrame:
    """key = aggregate id, value = JSON of the chosen columns, headers
    (trace context and the like) as name and bytes."""
    made = [F.struct(F.lit(k).alias("key"), v.cast("string").cast("binary").alias("value"))
            for k, v in (headers or {}).items()]
    kind = TOPIC_SCHEMA["headers"].dataType
    return df.select(F.col(key).cast("string").alias("key"),
                     F.to_json(F.struct(*[F.col(c) for c in value_cols]), JSON_TS).alias("value"),
                     F.lit(topic).alias("topic"),
                     (F.array(*made) if made else F.lit(None)).cast(kind).alias("headers"))


def header(name: str, headers: str = "headers") -> Column:
    """The value of a header as text; null when a record has none of that name."""
    at = F.filter(headers, lambda h: h["key"] == name)
    return F.when(F.size(at) > 0, at[0]["value"].cast("string"))


def write_topic(records: DataFrame, path: str | None = None,
                kafka: dict | None = None) -> None:
    """Append records to a topic folder, or to Kafka when options are given."""
    if kafka:
        records.select("key", "value", "topic", "headers").write.format("kafka").option("includeHeaders", True).options(**kafka).save()
    else:
        records.write.mode("append").parquet(path)


def read_topic(spark: SparkSession, path: str | None = None, kafka: dict | None = None,
               stream: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """The topic as a batch or streaming DataFrame of (key, value, topic, headers)."""
    if kafka:
        r = spark.readStream if stream else spark.read
        d = r.format("kafka").option("includeHeaders", True).options(**kafka).load()
        return d.select(F.col("key").cast("string"), F.col("value").cast("string"), "topic", "headers")
    if stream:
        r = spark.readStream.schema(TOPIC_SCHEMA)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        return r.parquet(path)
    return spark.read.schema(TOPIC_SCHEMA).parquet(path)
