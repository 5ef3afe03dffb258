"""Series to import lines, endpoints and batches."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.operators.common import materialised

BATCH_EVENTS = 1000


def sorted_map(labels: Column) -> Column:
    return F.map_from_entries(F.array_sort(F.map_entries(labels)))


def encodable() -> Column:
    """False for an event that lacks a part or has one bad element: a null label or time, a null, NaN or infinite value."""
    bad_value = F.exists("values", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.col("labels").isNotNull() & F.col("timestamps").isNotNull() & F.col("values").isNotNull() & ~F.exists(F.map_values("labels"), lambda v: v.isNull()) & ~F.exists("timestamps", lambda t: t.isNull()) & ~bad_value


def import_line() -> Column:
    """JSON of a series: metric (keys in order), timestamps in milliseconds, values."""
    return F.to_json(F.struct(sorted_map(F.col("labels")).alias("metric"), F.transform("timestamps", F.unix_millis).alias("timestamps"), F.col("values").alias("values")))


def compile_template(template: str) -> Column:
    """An endpoint template as an expression over labels: {{ labels.x }} or {{ .labels.x }}; null where a label is missing."""
    parts: list[Column] = []
    at = 0
    for m in re.finditer(r"\{\{\s*\.?labels\.([\w-]+)\s*\}\}", template):
        parts += [F.lit(template[at : m.start()]), F.element_at("labels", F.lit(m[1]))]
        at = m.end()
    if "{{" in template[at:]:
        raise ValueError(f"template field not understood: {template[at:]}")
    return F.concat(*parts, F.lit(template[at:]))


def encode(series: DataFrame, template: str) -> DataFrame:
    """(endpoint, line) of the series that can be encoded and have an endpoint."""
    return series.where(encodable()).select(compile_template(template).alias("endpoint"), import_line().alias("line")).where("endpoint IS NOT NULL")


def batches(events: DataFrame, endpoint: str, order: str, size: int = BATCH_EVENTS) -> DataFrame:
    """events with a batch number: size events of an endpoint each, in order.

    An endpoint may hold any share of the rows, so they aren't numbered by one window. Rows are range-partitioned by
    endpoint and order; each part is numbered on its own, on top of what the parts before it hold of the endpoint.
    """
    part = events.repartitionByRange(max(int(events.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1), endpoint, order).withColumn("__part", F.spark_partition_id())
    part = materialised(part)  # numbers and totals must come from the same partitioning
    within = part.withColumn("__at", F.row_number().over(Window.partitionBy("__part", endpoint).orderBy(order)))
    held = part.groupBy(endpoint, "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = held.withColumn("__before", F.coalesce(F.sum("__n").over(Window.partitionBy(endpoint).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    joined = within.join(before.drop("__n"), [endpoint, "__part"])
    return joined.withColumn("batch", F.floor((F.col("__before") + F.col("__at") - 1) / size)).drop("__part", "__at", "__before")
