"""Top statements by resource over a trailing window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.functions.model import POINT_LABELS

TIES = ("sql_digest", "plan_digest", "tag_label")


def trailing(points: DataFrame, at: Column, seconds: int, ts: str = "ts") -> DataFrame:
    """Points in (at - seconds, at]; ts and at in the same unit of seconds, or timestamps."""
    start = at - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds)) if dict(points.dtypes)[ts].startswith("timestamp") else at - seconds
    return points.where((F.col(ts) > start) & (F.col(ts) <= at))


def sum_over_time(points: DataFrame) -> DataFrame:
    """Sum of the values of each series, in doubles; counters, which are whole numbers, add up exactly in any order."""
    return points.groupBy("metric", *POINT_LABELS).agg(F.sum("value").alias("total"))


def top_k(totals: DataFrame, k: int) -> DataFrame:
    """The k largest totals of each metric and instance, ties by label; the partial limit runs before the shuffle."""
    order = Window.partitionBy("metric", "instance", "instance_type").orderBy(F.desc("total"), *TIES)
    return totals.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def with_statement(tops: DataFrame, meta: DataFrame) -> DataFrame:
    """Adds normalized_sql by an equi-join on sql_digest; statements without metadata stay, with null."""
    return tops.join(meta.select("sql_digest", "normalized_sql").distinct(), "sql_digest", "left")
