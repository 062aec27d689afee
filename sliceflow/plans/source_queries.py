"""Registered source / sink queries.

Each writes data derived from the driver tables into a fresh folder under the
shared checkpoint root, reads it back through the reader under test, and
returns what the reader saw, so the oracle is the SQL of the original rows.
"""

from __future__ import annotations

import math
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import artifact_key, is_uuid, short_id
from ..operators import rollup, slices
from ..operators.jobs import run_slice_job
from ..schemas import FILE_FORMATS
from ..session import scratch_path
from ..sources import artifacts as A
from ..sources import readers as R
from ..sources import topics as TP
from . import views
from .slice_queries import ORACLE as SLICE_ORACLE
from .slice_queries import _SALES as SALES_SQL

ROLLUP_SCHEMA = ("partition_index int, region string, total_revenue double, "
                 "avg_revenue double, row_count long")


#: text in a CSV file of documents, about: a task writes a file
CSV_FILE_BYTES = 64 << 20


def _files(spark) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "8")))


def q_read_csv(spark, sf):
    """The reference's path end to end: a CSV dataset (rows in key order
    across files) -> pandas-rule read -> contiguous slices in file order ->
    per-slice rollup."""
    path = scratch_path(spark, "sales-csv")
    A.write_dataset(views.sales(spark, sf), path, "csv", order_by="o_orderkey",
                    files=_files(spark))
    df = R.read_csv(spark, path, position="_at")
    sliced = slices.slice_rows_by_position(df, "_at", 3)
    return rollup.by_slice_rollup(sliced, money_scale=2)


def q_slice_file_order(spark, sf):
    """P1 without a key: every row of a CSV dataset with its slice, in file order."""
    path = scratch_path(spark, "sales-csv")
    A.write_dataset(views.sales(spark, sf), path, "csv", order_by="o_orderkey", files=_files(spark))
    return slices.slice_rows_in_file_order(R.read_csv(spark, path, multi_line=False), 4).select("o_orderkey", "region", "partition_index")


def q_read_csv_multiline(spark, sf):
    """S1 on large files whose fields hold quotes and line feeds: documents written to CSV
    files of about ``CSV_FILE_BYTES`` (two at least), read back in many splits, with their places in the order of files."""
    path = scratch_path(spark, "documents-csv")
    docs = views.table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    held = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    A.write_dataset(docs, path, "csv", order_by="doc_id", files=max(2, math.ceil(held / CSV_FILE_BYTES)))
    back = R.read_csv(spark, path, schema="doc_id long, text string, lang string, source string", position="position")
    return back.select("position", "doc_id", "lang", "source", F.length("text").alias("n_chars"), F.md5("text").alias("text_md5"))


def region_extremes(pdf: pd.DataFrame, params: dict) -> pd.DataFrame:
    """A user job: smallest and largest revenue of each region of a slice."""
    found: dict = {}
    for region, revenue in zip(pdf["region"], pdf["revenue"]):
        lo, hi, n = found.get(region, (revenue, revenue, 0))
        found[region] = min(lo, revenue), max(hi, revenue), n + 1
    return pd.DataFrame([(k, *v) for k, v in found.items()], columns=["region", "lowest", "highest", "n_rows"])


def merged_extremes(partials: pd.DataFrame, params: dict) -> pd.DataFrame:
    return (partials.groupby("region", as_index=False, dropna=False)
            .agg(lowest=("lowest", "min"), highest=("highest", "max"), n_rows=("n_rows", "sum")))


def q_slice_job(spark, sf):
    """The whole user path: CSV dataset -> slices -> user function -> one artifact
    per slice -> results read back, with the size of each slice's artifact."""
    path = scratch_path(spark, "sales-csv")
    A.write_dataset(views.sales(spark, sf), path, "csv", order_by="o_orderkey", files=_files(spark))
    done = run_slice_job(spark, path, "csv", fn=region_extremes, schema="region string, lowest double, highest double, n_rows long",
                         total=3, key="o_orderkey", merge=merged_extremes)
    size = done.manifest.groupBy("partition_index").agg((F.sum("size_bytes") > 0).alias("has_artifact"))
    return done.results.join(size, "partition_index")


def q_read_by_format(spark, sf):
    s = views.sales(spark, sf)
    parts = []
    for fmt in FILE_FORMATS:
        path = scratch_path(spark, f"sales-{fmt}")
        A.write_dataset(s, path, fmt)
        schema = "o_orderkey long, region string, revenue double, date string"
        back = R.read_dataset(spark, path, fmt, schema=schema)
        parts.append(rollup.region_rollup(back, money_scale=2)
                     .withColumn("file_format", F.lit(fmt)))
    return reduce(DataFrame.unionByName, parts)


def q_dataset_catalog(spark, sf):
    """S3: every dataset of the folder with its rows; a dataset may have many files."""
    files = R.dataset_catalog(spark, sf, "*.parquet").withColumn(
        "name", F.regexp_extract("storage_path", r"/([^/]+)\.parquet(/[^/]*)?$", 1))
    listed = files.groupBy("name").agg(F.first("file_format").alias("file_format"), F.min("state").alias("state"),
                                       (F.min("size_bytes") > 0).alias("has_size"))
    rows = R.catalog_rows(spark, [(t, f"{sf.rstrip('/')}/{t}.parquet", "parquet") for t in views.TABLES])
    return listed.join(rows, "name")


def _written_artifacts(spark, sf) -> str:
    path = scratch_path(spark, "artifacts")
    part = rollup.region_rollup_by_slice(views.sales(spark, sf), "o_orderkey", 3, money_scale=2)
    return A.write_artifacts(part, path, total=3)


def q_write_artifacts(spark, sf):
    return A.read_artifacts(spark, _written_artifacts(spark, sf), ROLLUP_SCHEMA)


def q_artifact_manifest(spark, sf):
    """S5 over the slices of the orders: two of five hold nothing after a filter, and have an
    artifact all the same.  The folder stands for the path, whose file name is random."""
    o = slices.slice_rows(views.table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 5)
    path = A.write_artifacts(o.where(~F.col("partition_index").isin(1, 4)), scratch_path(spark, "artifacts"), total=5)
    back = A.read_artifacts(spark, path, "o_orderkey long, o_totalprice double, partition_index int")
    rows = back.groupBy("partition_index").agg(F.count(F.lit(1)).alias("n_rows"))
    m = A.artifact_manifest(spark, path).groupBy("partition_index", "name", "content_type").agg(
        F.min(F.regexp_extract("storage_path", r"/([^/]+)/[^/]+$", 1)).alias("folder"), F.min(F.col("size_bytes") > 0).alias("has_size"))
    return m.join(rows, "partition_index", "left").fillna(0, ["n_rows"])


def q_read_artifacts(spark, sf):
    back = A.read_artifacts(spark, _written_artifacts(spark, sf), ROLLUP_SCHEMA)
    return rollup.merge_rollup(back, money_scale=2)


def q_write_topic(spark, sf):
    e = views.table(spark, sf, "events")
    path = scratch_path(spark, "topic")
    TP.write_topic(TP.to_records(e, "user_id", ["event_id", "event_type", "value"],
                                 "job.events", {"event_type": F.col("event_type"),
                                                "trace": F.concat(F.lit("t-"), F.col("event_id").cast("string"))}), path)
    back = TP.read_topic(spark, path)
    v = F.from_json("value", "event_id long, event_type string, value double")
    return back.select(F.col("key").alias("user_id"), v.alias("v"), "topic", TP.header("trace").alias("trace")).select(
        "user_id", "v.event_id", "v.event_type", "v.value", "topic", "trace")


def uuid_text(c) -> Column:
    """An id of the canonical form made from a number."""
    h = F.md5(c.cast("string"))
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def _history(spark, sf):
    """The runs as a platform table: ids are UUIDs, a few are not, a few states are unknown."""
    o = views.table(spark, sf, "orders")
    key = F.col("o_orderkey")
    rows = o.select(F.when(key % 11 == 0, F.concat(F.lit("{"), uuid_text(key), F.lit("}"))).otherwise(uuid_text(key)).alias("id"),
                    uuid_text(F.col("o_custkey")).alias("job_id"), F.when(key % 13 == 0, "LOST").otherwise(views.run_state()).alias("state"),
                    F.lit(1).alias("attempt_number"), F.col("o_orderdate").alias("created_at"))
    path = scratch_path(spark, "runs")
    rows.write.options(**TP.JSON_TS).json(path)
    return R.read_history(spark, path, table="runs", fmt="json")


def q_read_history(spark, sf):
    """A platform table with its declared schema, rows that its enums and
    ids do not allow apart."""
    good, bad = R.split_valid(_history(spark, sf), "runs")
    cols = ["id", "job_id", "state", "attempt_number", "created_at"]
    return good.select(*cols, F.lit(None).cast("string").alias("error")).unionByName(bad.select(*cols, "error"))


def q_short_ids(spark, sf):
    """X6 and X10 over the customers: is an id canonical, and its short form."""
    c = views.table(spark, sf, "customer")
    u = uuid_text(F.col("c_custkey"))
    i = F.when(F.col("c_custkey") % 5 == 0, F.upper(u)).when(F.col("c_custkey") % 7 == 0, F.concat(F.lit("urn:uuid:"), u)).otherwise(u)
    return c.select("c_custkey", i.alias("id")).select("c_custkey", is_uuid("id").alias("valid"), short_id("id").alias("short"))


def q_runner_lines(spark, sf):
    """The line a task reports, taken apart; some have no size."""
    li = views.table(spark, sf, "lineitem")
    key = artifact_key("l_orderkey", "l_linenumber")
    size = F.when(F.col("l_returnflag") == "A", F.concat(F.lit(":"), F.col("l_quantity").cast("long").cast("string"))).when(
        F.col("l_returnflag") == "R", F.lit(":none")).otherwise(F.lit(""))
    return A.parse_runner_lines(li.select(F.concat(key, size).alias("value")))


QUERIES = {
    "read_csv": q_read_csv,
    "read_csv_multiline": q_read_csv_multiline,
    "read_by_format": q_read_by_format,
    "dataset_catalog": q_dataset_catalog,
    "write_artifacts": q_write_artifacts,
    "artifact_manifest": q_artifact_manifest,
    "read_artifacts": q_read_artifacts,
    "write_topic": q_write_topic,
    "slice_file_order": q_slice_file_order,
    "slice_job": q_slice_job,
    "read_history": q_read_history,
    "short_ids": q_short_ids,
    "runner_lines": q_runner_lines,
}

_UUID = """substr(md5(CAST({0} AS VARCHAR)), 1, 8) || '-' || substr(md5(CAST({0} AS VARCHAR)), 9, 4) || '-' ||
  substr(md5(CAST({0} AS VARCHAR)), 13, 4) || '-' || substr(md5(CAST({0} AS VARCHAR)), 17, 4) || '-' || substr(md5(CAST({0} AS VARCHAR)), 21, 12)"""

ORACLE = {
    "read_csv": SLICE_ORACLE["region_rollup_by_slice"],
    "read_csv_multiline": """SELECT row_number() OVER (ORDER BY doc_id) - 1 AS position, doc_id, lang, source,
  length(text) AS n_chars, md5(text) AS text_md5 FROM documents""",
    "read_by_format": f"""SELECT f.file_format, r.* FROM ({SLICE_ORACLE['region_rollup']}) r,
  (VALUES ('csv'), ('parquet'), ('json'), ('jsonl')) f(file_format)""",
    "dataset_catalog": " UNION ALL ".join(
        f"SELECT '{t}' AS name, 'parquet' AS file_format, 'READY' AS state, true AS has_size, count(*) AS n_rows FROM {t}" for t in views.TABLES),
    "write_artifacts": SLICE_ORACLE["region_rollup_by_slice"],
    "artifact_manifest": """WITH p AS (SELECT CAST(LEAST((row_number() OVER (ORDER BY o_orderkey) - 1)
  // GREATEST(1, count(*) OVER () // 5), 4) AS INTEGER) AS i FROM orders)
SELECT i AS partition_index, 'partition-' || i || '.csv' AS name, 'text/csv' AS content_type, 'partition_index=' || i AS folder,
  true AS has_size, count(*) FILTER (WHERE i NOT IN (1, 4)) AS n_rows FROM p GROUP BY i""",
    "read_artifacts": SLICE_ORACLE["region_rollup"],
    "write_topic": """SELECT CAST(user_id AS VARCHAR) AS user_id, event_id, event_type, value,
  'job.events' AS topic, 't-' || event_id AS trace FROM events""",
    "slice_file_order": f"""WITH s AS ({SALES_SQL})
SELECT o_orderkey, region, CAST(LEAST((row_number() OVER (ORDER BY o_orderkey) - 1)
  // GREATEST(1, count(*) OVER () // 4), 3) AS INTEGER) AS partition_index FROM s""",
    "slice_job": f"""WITH s AS ({SALES_SQL}),
p AS (SELECT region, revenue, CAST(LEAST((row_number() OVER (ORDER BY o_orderkey) - 1)
  // GREATEST(1, count(*) OVER () // 3), 2) AS INTEGER) AS partition_index FROM s)
SELECT partition_index, region, min(revenue) AS lowest, max(revenue) AS highest, count(*) AS n_rows, true AS has_artifact FROM p GROUP BY ALL""",
    "read_history": f"""WITH r AS (SELECT CASE WHEN o_orderkey % 11 = 0 THEN '{{' || {_UUID.format('o_orderkey')} || '}}' ELSE {_UUID.format('o_orderkey')} END AS id,
  {_UUID.format('o_custkey')} AS job_id, CASE WHEN o_orderkey % 13 = 0 THEN 'LOST' WHEN o_orderstatus = 'F' THEN 'SUCCEEDED'
    WHEN o_orderstatus = 'O' THEN 'RUNNING' ELSE 'CANCELLED' END AS state, 1 AS attempt_number, o_orderdate AS created_at,
  CASE WHEN o_orderkey % 11 = 0 THEN 'invalid id' WHEN o_orderkey % 13 = 0 THEN 'invalid state' END AS error FROM orders)
SELECT * FROM r""",
    "short_ids": f"""WITH c AS (SELECT c_custkey, {_UUID.format('c_custkey')} AS u FROM customer),
i AS (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN upper(u) WHEN c_custkey % 7 = 0 THEN 'urn:uuid:' || u ELSE u END AS id FROM c)
SELECT c_custkey, c_custkey % 5 = 0 OR c_custkey % 7 <> 0 AS valid, substr(id, 1, 8) AS short FROM i""",
    "runner_lines": """SELECT 'artifacts/' || l_orderkey || '/partition-' || l_linenumber || '.csv' AS storage_path,
  CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS BIGINT) ELSE 0 END AS size_bytes FROM lineitem""",
}
