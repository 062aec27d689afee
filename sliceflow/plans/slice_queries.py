"""Registered queries for the slice-apply data plane."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import rollup, slices
from ..schemas import DEFAULT_PARTITIONS
from . import views

TOTAL = DEFAULT_PARTITIONS
MONEY = 2


def q_slice_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = views.table(spark, sf_dir, "orders").select("o_orderkey")
    return slices.slice_rows(o, "o_orderkey", TOTAL)


def q_region_rollup_by_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    # ranks count the joined orders: the keys are those with a customer
    o = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = views.region_of_customer(spark, sf_dir).select("c_custkey")
    keys = o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    return rollup.region_rollup_by_slice(views.sales(spark, sf_dir), "o_orderkey", TOTAL,
                                         money_scale=MONEY, keys=keys)


def q_slice_rows_by_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 on a text key, as ids of the platform are."""
    k = F.sha2(F.col("o_orderkey").cast("string"), 256).alias("id")
    return slices.slice_rows(views.table(spark, sf_dir, "orders").select("o_orderkey", k), "id", 5).drop("id")


def q_slice_rows_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 into 100,000 slices: most hold a row or none."""
    return slices.slice_rows(views.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 100_000)


def new_highs(frames, params: dict):
    """A user job that streams its slice: rows, and how often the price passes all before."""
    n, highs, top = 0, 0, None
    for f in frames:
        for price in f["o_totalprice"]:
            if top is None or price > top:
                highs, top = highs + 1, price
        n += len(f)
    yield pd.DataFrame({"n_rows": [n], "new_highs": [highs], "top": pd.array([top], dtype="Float64")})


def q_slice_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 on slices of any size: rows streamed in key order."""
    o = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return slices.slice_stream(o, new_highs, "n_rows long, new_highs long, top double", "o_orderkey", 8)


def q_schema_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same call on a table with and one without the sample columns."""
    sales = rollup.analyze_slices(views.sales(spark, sf_dir), "o_orderkey", TOTAL, money_scale=MONEY)
    part = rollup.analyze_slices(views.table(spark, sf_dir, "part"), "p_partkey", TOTAL)
    return (sales.select(F.lit("sales").alias("dataset"), "partition_index", F.col("region").alias("name"), F.col("total_revenue").alias("value"))
            .unionByName(part.select(F.lit("part").alias("dataset"), "partition_index", F.col("metric").alias("name"), F.col("value").cast("double").alias("value"))))


def dear_orders(pdf: pd.DataFrame, params: dict) -> pd.DataFrame:
    """A user job that its parameters change: orders from a price on."""
    dear = pdf[pdf["o_totalprice"] >= params["min_price"]]
    return pd.DataFrame({"label": [params["label"]], "n_rows": [len(dear)]})


def added_rows(partials: pd.DataFrame, params: dict) -> pd.DataFrame:
    return partials.groupby("label", as_index=False)["n_rows"].sum()


def q_job_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One job under two sets of parameters."""
    o = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    runs = [slices.slice_apply(o, dear_orders, "label string, n_rows long", "o_orderkey", TOTAL, params=p, merge=added_rows)
            for p in ({"min_price": 100000.0, "label": "dear"}, {"min_price": 0.0, "label": "all"})]
    return runs[0].unionByName(runs[1])


def q_region_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.region_rollup(views.sales(spark, sf_dir), money_scale=MONEY)


def q_shape_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.shape_summary(views.table(spark, sf_dir, "part"), TOTAL)


def slice_stats(pdf: pd.DataFrame, params: dict) -> pd.DataFrame:
    """A user job: first/last key, row count and top price of its slice."""
    return pd.DataFrame({
        "min_key": [pdf["o_orderkey"].min() if len(pdf) else None],
        "max_key": [pdf["o_orderkey"].max() if len(pdf) else None],
        "n_rows": [len(pdf)],
        "max_price": [pdf["o_totalprice"].max() if len(pdf) else None],
    })


def merge_slice_stats(parts: pd.DataFrame, params: dict) -> pd.DataFrame:
    return pd.DataFrame({
        "min_key": [parts["min_key"].min()], "max_key": [parts["max_key"].max()],
        "n_rows": [parts["n_rows"].sum()], "max_price": [parts["max_price"].max()],
    })


SLICE_STATS_SCHEMA = "min_key long, max_key long, n_rows long, max_price double"


def q_slice_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return slices.slice_apply(o, slice_stats, SLICE_STATS_SCHEMA, "o_orderkey", TOTAL,
                              params={"note": "per-slice stats"}, merge=merge_slice_stats)


QUERIES = {
    "slice_rows": q_slice_rows,
    "slice_rows_many": q_slice_rows_many,
    "slice_apply": q_slice_apply,
    "slice_stream": q_slice_stream,
    "region_rollup_by_slice": q_region_rollup_by_slice,
    "region_rollup": q_region_rollup,
    "shape_summary": q_shape_summary,
    "slice_rows_by_text": q_slice_rows_by_text,
    "schema_dispatch": q_schema_dispatch,
    "job_parameters": q_job_parameters,
}

_SALES = """
  SELECT o.o_orderkey, r.r_name AS region, o.o_totalprice AS revenue
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
"""

_ROLLUP_AGGS = """
  CAST(COALESCE(SUM(CAST(revenue AS DECIMAL(18,2))), 0) AS DOUBLE) AS total_revenue,
  CASE WHEN COUNT(revenue) > 0
       THEN CAST(SUM(CAST(revenue AS DECIMAL(18,2))) AS DOUBLE) / COUNT(revenue) END AS avg_revenue,
  COUNT(revenue) AS row_count
"""

ORACLE = {
    "slice_rows": """
SELECT o_orderkey,
       CAST(LEAST((row_number() OVER (ORDER BY o_orderkey) - 1)
                  // GREATEST(1, count(*) OVER () // 3), 2) AS INTEGER) AS partition_index
FROM orders
""",
    "slice_rows_many": """
SELECT o_orderkey, o_custkey,
       CAST(LEAST((row_number() OVER (ORDER BY o_orderkey) - 1)
                  // GREATEST(1, count(*) OVER () // 100000), 99999) AS INTEGER) AS partition_index
FROM orders
""",
    "slice_stream": """
WITH s AS (
  SELECT o_orderkey, o_totalprice,
         CAST(LEAST((row_number() OVER (ORDER BY o_orderkey) - 1)
                    // GREATEST(1, count(*) OVER () // 8), 7) AS INTEGER) AS partition_index
  FROM orders),
h AS (SELECT *, max(o_totalprice) OVER (PARTITION BY partition_index ORDER BY o_orderkey
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM s)
SELECT i AS partition_index, count(o_orderkey) AS n_rows,
       count(*) FILTER (WHERE o_orderkey IS NOT NULL AND (before IS NULL OR o_totalprice > before)) AS new_highs, max(o_totalprice) AS top
FROM (SELECT CAST(unnest(range(8)) AS INTEGER) AS i) LEFT JOIN h ON partition_index = i GROUP BY i
""",
    "slice_apply": """
WITH p AS (
  SELECT o_orderkey, o_totalprice,
         CAST(LEAST((row_number() OVER (ORDER BY o_orderkey) - 1)
                    // GREATEST(1, count(*) OVER () // 3), 2) AS INTEGER) AS partition_index
  FROM orders)
SELECT partition_index, min(o_orderkey) AS min_key, max(o_orderkey) AS max_key,
       count(*) AS n_rows, max(o_totalprice) AS max_price
FROM p GROUP BY partition_index
""",
    "region_rollup_by_slice": f"""
WITH s AS ({_SALES}),
p AS (
  SELECT region, revenue,
         CAST(LEAST((row_number() OVER (ORDER BY o_orderkey) - 1)
                    // GREATEST(1, count(*) OVER () // 3), 2) AS INTEGER) AS partition_index
  FROM s)
SELECT partition_index, region, {_ROLLUP_AGGS}
FROM p WHERE region IS NOT NULL GROUP BY partition_index, region
""",
    "region_rollup": f"""
WITH s AS ({_SALES})
SELECT region, {_ROLLUP_AGGS}
FROM s WHERE region IS NOT NULL GROUP BY region
""",
    "shape_summary": """
WITH i AS (SELECT row_number() OVER () - 1 AS idx, count(*) OVER () AS n FROM part),
p AS (SELECT CAST(LEAST(idx // GREATEST(1, n // 3), 2) AS INTEGER) AS pi FROM i),
s AS (SELECT CAST(r.range AS INTEGER) AS partition_index, count(p.pi) AS n_rows
      FROM range(3) r LEFT JOIN p ON p.pi = r.range GROUP BY 1)
SELECT partition_index, 'row_count' AS metric, n_rows AS value FROM s
UNION ALL
SELECT partition_index, 'col_count' AS metric, CAST(6 AS BIGINT) AS value FROM s
""",
    "slice_rows_by_text": """
SELECT o_orderkey,
       CAST(LEAST((row_number() OVER (ORDER BY sha256(CAST(o_orderkey AS VARCHAR))) - 1)
                  // GREATEST(1, count(*) OVER () // 5), 4) AS INTEGER) AS partition_index
FROM orders
""",
    "job_parameters": """
WITH p AS (
  SELECT o_totalprice,
         CAST(LEAST((row_number() OVER (ORDER BY o_orderkey) - 1)
                    // GREATEST(1, count(*) OVER () // 3), 2) AS INTEGER) AS partition_index
  FROM orders)
SELECT partition_index, 'dear' AS label, count(*) FILTER (WHERE o_totalprice >= 100000) AS n_rows FROM p GROUP BY 1
UNION ALL SELECT partition_index, 'all', count(*) FROM p GROUP BY 1
""",
}
ORACLE["schema_dispatch"] = f"""
SELECT 'sales' AS dataset, partition_index, region AS name, total_revenue AS value FROM ({ORACLE['region_rollup_by_slice']})
UNION ALL SELECT 'part', partition_index, metric, CAST(value AS DOUBLE) FROM ({ORACLE['shape_summary']})"""
