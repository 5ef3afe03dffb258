"""Usage records to labelled points and series.

A point is a row (metric, five labels, ts, value); a series is a label map with parallel arrays, used at sinks only.
Counters of zero give no point; the six labels of a point are always complete, with empty text for unset ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import model as M
from sparkloom.functions.scalars import digest_text, seconds_to_timestamp, tag_label


def unpivot_counters(items: DataFrame, counters: dict[str, str], ids: list[str]) -> DataFrame:
    """One row (ids, metric, value) for each item and counter above zero; the filter runs on the scan's side of any shuffle."""
    wide = items.select(*ids, *[F.col(c).cast("double").alias(metric) for c, metric in counters.items()])
    return wide.unpivot(ids, list(counters.values()), "metric", "value").where("value > 0")


def _labelled(points: DataFrame) -> DataFrame:
    return points.select("metric", *M.POINT_LABELS, "ts", "value").where("ts IS NOT NULL")


def sql_record_items(records: DataFrame) -> DataFrame:
    """records (instance, record) to one row for each item, with its labels and time."""
    items = records.where("record IS NOT NULL").select("instance", digest_text(F.col("record.sql_digest")).alias("sql_digest"), digest_text(F.col("record.plan_digest")).alias("plan_digest"), F.explode("record.items").alias("i"))
    return items.select("instance", F.lit(M.SQL_LAYER).alias("instance_type"), "sql_digest", "plan_digest", F.lit("").alias("tag_label"), "i.*").withColumn("ts", seconds_to_timestamp(F.col("timestamp_sec")))


def sql_record_points(records: DataFrame) -> DataFrame:
    """Points of SQL-layer records: the instance's own counters and the executions it saw on each row store."""
    items = sql_record_items(records)
    own = unpivot_counters(items, M.SQL_COUNTERS, [*M.POINT_LABELS, "ts"])
    return _labelled(own).unionByName(remote_exec_points(items))


def remote_exec_points(items: DataFrame) -> DataFrame:
    """Executions by row-store address (a map of each item): the address is the instance, and its type is the row store's."""
    seen = items.select("sql_digest", "plan_digest", "tag_label", "ts", F.explode("stmt_kv_exec_count").alias("instance", "value")).where("value > 0")
    return _labelled(seen.select(F.lit(M.EXEC_COUNT).alias("metric"), "instance", F.lit(M.ROW_STORE).alias("instance_type"), "sql_digest", "plan_digest", "tag_label", "ts", F.col("value").cast("double")))


def tagged(records: DataFrame) -> DataFrame:
    """records (record with a decoded tag) with the tag's digests and label; tags that are null or have no sql_digest drop the record."""
    kept = records.where("record.tag.sql_digest IS NOT NULL")
    return kept.withColumns({"sql_digest": digest_text(F.col("record.tag.sql_digest")), "plan_digest": digest_text(F.col("record.tag.plan_digest")), "tag_label": tag_label(F.col("record.tag.label"))})


def store_record_points(records: DataFrame) -> DataFrame:
    """Points of row-store records (instance, record with a decoded tag)."""
    items = tagged(records).select("instance", F.lit(M.ROW_STORE).alias("instance_type"), "sql_digest", "plan_digest", "tag_label", F.explode("record.items").alias("i"))
    return _labelled(unpivot_counters(items.select(*M.POINT_LABELS, "i.*").withColumn("ts", seconds_to_timestamp(F.col("timestamp_sec"))), M.STORE_COUNTERS, [*M.POINT_LABELS, "ts"]))


def sql_meta(responses: DataFrame) -> DataFrame:
    """(sql_digest, normalized_sql, is_internal_sql as text) of responses that carry statement metadata."""
    m = responses.where("sql_meta IS NOT NULL").select("sql_meta.*")
    return m.select(digest_text(F.col("sql_digest")).alias("sql_digest"), F.coalesce("normalized_sql", F.lit("")).alias("normalized_sql"), F.coalesce("is_internal_sql", F.lit(False)).cast("string").alias("is_internal_sql"))


def plan_meta(responses: DataFrame) -> DataFrame:
    m = responses.where("plan_meta IS NOT NULL").select("plan_meta.*")
    return m.select(digest_text(F.col("plan_digest")).alias("plan_digest"), F.coalesce("normalized_plan", F.lit("")).alias("normalized_plan"), F.coalesce("encoded_normalized_plan", F.lit("")).alias("encoded_normalized_plan"))


def labels_map(pairs: dict[str, Column]) -> Column:
    """A label map with its keys in order."""
    return F.map_from_entries(F.array(*[F.struct(F.lit(k).alias("key"), pairs[k].alias("value")) for k in sorted(pairs)]))


def meta_series(rows: DataFrame, metric: str, now: Column | None = None) -> DataFrame:
    """Metadata rows or instances as series of one point, 1.0 at now; every column becomes a label."""
    labels = labels_map({M.NAME: F.lit(metric), **{c: F.col(c) for c in rows.columns}})
    return rows.select(labels.alias("labels"), F.array(F.current_timestamp() if now is None else now).alias("timestamps"), F.array(F.lit(1.0)).alias("values"))


def point_series(points: DataFrame, group: list[str], position: str) -> DataFrame:
    """Series of the points of each group and label set, in order of position; a group is a record, so its arrays are bounded."""
    packed = points.groupBy(*group, "metric", *M.POINT_LABELS).agg(F.array_sort(F.collect_list(F.struct(F.col(position).alias("position"), "ts", "value"))).alias("p"))
    labels = labels_map({M.NAME: F.col("metric"), **{c: F.col(c) for c in M.POINT_LABELS}})
    return packed.select(*group, labels.alias("labels"), F.col("p.ts").alias("timestamps"), F.col("p.value").alias("values"))


def series_points(series: DataFrame) -> DataFrame:
    """The inverse: long points of series with the six labels."""
    long = series.select("labels", F.explode(F.arrays_zip("timestamps", "values")).alias("p"))
    return long.select(F.element_at("labels", F.lit(M.NAME)).alias("metric"), *[F.coalesce(F.element_at("labels", F.lit(c)), F.lit("")).alias(c) for c in M.POINT_LABELS], F.col("p.timestamps").alias("ts"), F.col("p.values").alias("value"))


def heartbeats(instances: DataFrame, now: Column | None = None) -> DataFrame:
    """A series for each connected instance (instance, instance_type), 1.0 at now."""
    return meta_series(instances.select("instance", "instance_type").distinct(), M.INSTANCE, now)
