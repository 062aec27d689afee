"""The sample analytics job re-expressed natively.

Per slice: group by region -> total (sum), mean and count of revenue, with
pandas defaults: null regions are dropped, missing revenue is skipped, the sum
of no values is 0.  The merge of slices is a two-phase aggregate: totals and
counts are summed and the mean is recomputed as total / count -- never a mean
of means.

``money_scale``: when given, revenue is cast to ``DECIMAL(18, scale)`` and
summed as a decimal.  The sum is then exact and does not depend on how Spark split the rows (a double sum
does), which makes results reproducible between runs and cluster sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .slices import plan_slices, assign_slices


def _measure(c: str) -> Column:
    """NaN counts as missing, as in pandas."""
    return F.when(F.isnan(F.col(c).cast("double")), F.lit(None)).otherwise(F.col(c).cast("double"))


def _sum(c: Column, money_scale: int | None) -> Column:
    if money_scale is None:
        return F.sum(c)
    return F.sum(c.cast(f"decimal(18,{money_scale})"))


def _rollup_aggs(revenue: str, money_scale: int | None) -> list[Column]:
    total = _sum(_measure(revenue), money_scale)
    cnt = F.count(_measure(revenue))
    return [
        F.coalesce(total.cast("double"), F.lit(0.0)).alias("total_revenue"),
        F.when(cnt > 0, total.cast("double") / cnt).alias("avg_revenue"),
        cnt.alias("row_count"),
    ]


def by_slice_rollup(sliced: DataFrame, region: str = "region", revenue: str = "revenue",
                    money_scale: int | None = None,
                    slice_col: str = "partition_index") -> DataFrame:
    """P4 on rows that already carry their slice index."""
    return (sliced.where(F.col(region).isNotNull())
            .groupBy(F.col(slice_col).alias("partition_index"), F.col(region).alias("region"))
            .agg(*_rollup_aggs(revenue, money_scale)))


def region_rollup_by_slice(df: DataFrame, key: str, total: int = 3, region: str = "region",
                           revenue: str = "revenue", money_scale: int | None = None,
                           keys: DataFrame | None = None) -> DataFrame:
    """Slice ``df`` by ``key`` and roll each slice up by region.

    Slices are planned on the key column alone; ``keys`` gives a cheaper
    table of the same keys (for a join: the semi-join of its key side)."""
    plan = plan_slices((df if keys is None else keys).select(key), key, total)
    sliced = assign_slices(df.select(key, region, revenue), plan)
    return by_slice_rollup(sliced, region, revenue, money_scale)


def region_rollup(df: DataFrame, region: str = "region", revenue: str = "revenue",
                  money_scale: int | None = None) -> DataFrame:
    """P5: the merged answer.

    The merge of slice partials equals one group-by over all rows, and Spark
    already runs that as partial (map-side) + final aggregation, so the slices
    need not be computed at all.
    """
    return (df.where(F.col(region).isNotNull())
            .groupBy(F.col(region).alias("region"))
            .agg(*_rollup_aggs(revenue, money_scale)))


def merge_rollup(partials: DataFrame, money_scale: int | None = None) -> DataFrame:
    """P5 from per-slice partial results (e.g. artifacts read back)."""
    tot = F.col("total_revenue")
    if money_scale is not None:
        tot = tot.cast(f"decimal(38,{money_scale})")
    total = F.sum(tot)
    cnt = F.sum(F.col("row_count").cast("long"))
    return (partials.groupBy("region")
            .agg(total.cast("double").alias("total_revenue"),
                 F.when(cnt > 0, total.cast("double") / cnt).alias("avg_revenue"),
                 cnt.alias("row_count")))


def shape_summary(df: DataFrame, total: int = 3) -> DataFrame:
    """Per slice, ``row_count`` and ``col_count``; empty slices give 0 rows.

    Slice sizes follow from the number of rows alone: one count, whose single
    row becomes one row per slice.  No row is moved.
    """
    n, i = F.col("n"), F.col("i")
    rps = F.greatest(F.lit(1), F.floor(n / F.lit(total)))
    lo = F.least(n, i * rps)
    hi = F.when(i == total - 1, n).otherwise(F.least(n, (i + 1) * rps))
    spine = (df.agg(F.count(F.lit(1)).alias("n"))
             .select("n", F.explode(F.sequence(F.lit(0), F.lit(total - 1))).alias("i"))
             .select(i.cast("int").alias("partition_index"),
                     F.greatest(hi - lo, F.lit(0)).cast("long").alias("rows")))
    return spine.select(
        "partition_index",
        F.expr(f"stack(2, 'row_count', rows, 'col_count', CAST({len(df.columns)} AS BIGINT))")
        .alias("metric", "value"))


def analyze_slices(df: DataFrame, key: str, total: int = 3,
                   money_scale: int | None = None) -> DataFrame:
    """The sample job's dispatch on the (static) schema."""
    if "region" in df.columns and "revenue" in df.columns:
        return region_rollup_by_slice(df, key, total, money_scale=money_scale)
    return shape_summary(df, total)
