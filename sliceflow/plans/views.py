"""Platform tables expressed over the driver's test tables.

The reference keeps workspaces, jobs, runs, tasks and events in PostgreSQL.
Here the same shapes are derived from the TPC-H-like parquet tables so that
every query reads real data whose size grows with the scale factor:

* ``sales``      region x nation x customer x orders (region, revenue, month)
* ``workspaces`` customer
* ``runs``       orders   (one run per order, job = workspace = customer)
* ``tasks``      lineitem (task of run l_orderkey)
* ``job_events`` events   (event type mapped to a job event kind)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# The "now" used instead of NOW(), per data set.
ORDERS_AS_OF = "2001-08-02 00:00:00"
EVENTS_AS_OF = "2024-01-31 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def region_of_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> region name.  nation (25 rows) and region (5 rows) have a
    fixed size in this schema, so broadcasting them is safe at any scale."""
    geo = (table(spark, sf_dir, "nation")
           .join(F.broadcast(table(spark, sf_dir, "region")),
                 F.col("n_regionkey") == F.col("r_regionkey"))
           .select("n_nationkey", "r_name"))
    return (table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
            .join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", F.col("r_name").alias("region")))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(o_orderkey, region, revenue, date)``; ``date`` is ``yyyy-MM`` text."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice",
                                               "o_orderdate")
    return (o.join(region_of_customer(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
            .select("o_orderkey", "region", F.col("o_totalprice").alias("revenue"),
                    F.date_format("o_orderdate", "yyyy-MM").alias("date")))


def workspaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    plan = (F.when(F.col("c_mktsegment") == "BUILDING", "enterprise")
            .when(F.col("c_mktsegment") == "MACHINERY", "pro").otherwise("free"))
    return c.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("owner_id"),
                    F.col("c_name").alias("name"), plan.alias("plan"))


def run_state():
    return (F.when(F.col("o_orderstatus") == "F", "SUCCEEDED")
            .when(F.col("o_orderstatus") == "O", "RUNNING").otherwise("CANCELLED"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("job_id"),
                    F.col("o_custkey").alias("workspace_id"), run_state().alias("state"),
                    F.col("o_orderdate").alias("created_at"))


def task_state():
    return (F.when(F.col("l_returnflag") == "R", "FAILED")
            .when(F.col("l_linestatus") == "F", "SUCCEEDED")
            .when(F.col("l_returnflag") == "A", "LEASED").otherwise("PENDING"))


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One task per lineitem.  Task id = ``l_orderkey * 8 + l_linenumber``
    (line numbers are 1..7); note (run, line) itself is not unique in the
    data, so the id is not unique either -- only used where that is fine."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("run_id"),
                     F.col("l_linenumber").alias("partition_index"),
                     task_state().alias("state"),
                     F.col("l_shipdate").alias("created_at"),
                     (F.col("l_linenumber") - 1).alias("retry_count"),
                     "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")


def event_kind():
    return (F.when(F.col("event_type") == "signup", "submitted")
            .when(F.col("event_type") == "purchase", "completed")
            .when(F.col("event_type") == "error", "failed")
            .when(F.col("event_type") == "view", "heartbeat")
            .when(F.col("event_type") == "click", "cancelled"))


def job_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("event_id", "ts", F.col("user_id").alias("workspace_id"),
                    event_kind().alias("kind"), "event_type", "value", "props")
