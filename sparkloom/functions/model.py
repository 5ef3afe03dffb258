"""Schemas, metric names and labels of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Metric names.
CPU_TIME = "topsql_cpu_time_ms"
READ_KEYS = "topsql_read_keys"
WRITE_KEYS = "topsql_write_keys"
EXEC_COUNT = "topsql_stmt_exec_count"
DURATION_SUM = "topsql_stmt_duration_sum_ns"
DURATION_COUNT = "topsql_stmt_duration_count"
SQL_META = "topsql_sql_meta"
PLAN_META = "topsql_plan_meta"
INSTANCE = "topsql_instance"

# Label names, instance types and tag labels.
NAME = "__name__"
POINT_LABELS = ("instance", "instance_type", "sql_digest", "plan_digest", "tag_label")
PLACEMENT, SQL_LAYER, ROW_STORE, COLUMN_STORE = "pd", "tidb", "tikv", "tiflash"
INSTANCE_TYPES = (PLACEMENT, SQL_LAYER, ROW_STORE, COLUMN_STORE)
TAG_LABELS = {1: "row", 2: "index"}
TAG_UNKNOWN = "unknown"

#: Counters of a SQL-layer item in the order in which their points are emitted, and those of a row-store item.
SQL_COUNTERS = {"cpu_time_ms": CPU_TIME, "stmt_exec_count": EXEC_COUNT, "stmt_duration_sum_ns": DURATION_SUM, "stmt_duration_count": DURATION_COUNT}
STORE_COUNTERS = {"cpu_time_ms": CPU_TIME, "read_keys": READ_KEYS, "write_keys": WRITE_KEYS}

#: An unsigned 64-bit number from the wire: BIGINT would turn the upper half into nulls.
UNSIGNED = T.DecimalType(20, 0)

POINT = T.StructType(
    [T.StructField(n, T.StringType(), False) for n in ("metric", *POINT_LABELS)] + [T.StructField("ts", T.TimestampType(), False), T.StructField("value", T.DoubleType(), False)]
)
SERIES = T.StructType(
    [T.StructField("labels", T.MapType(T.StringType(), T.StringType()), False), T.StructField("timestamps", T.ArrayType(T.TimestampType()), False), T.StructField("values", T.ArrayType(T.DoubleType()), False)]
)
SQL_ITEM = T.StructType(
    [
        T.StructField("timestamp_sec", UNSIGNED),
        T.StructField("cpu_time_ms", T.LongType()),
        T.StructField("stmt_exec_count", UNSIGNED),
        T.StructField("stmt_kv_exec_count", T.MapType(T.StringType(), UNSIGNED)),
        T.StructField("stmt_duration_sum_ns", UNSIGNED),
        T.StructField("stmt_duration_count", UNSIGNED),
    ]
)
SQL_RECORD = T.StructType([T.StructField("sql_digest", T.BinaryType()), T.StructField("plan_digest", T.BinaryType()), T.StructField("items", T.ArrayType(SQL_ITEM))])
SQL_META_ROW = T.StructType([T.StructField("sql_digest", T.BinaryType()), T.StructField("normalized_sql", T.StringType()), T.StructField("is_internal_sql", T.BooleanType())])
PLAN_META_ROW = T.StructType([T.StructField("plan_digest", T.BinaryType()), T.StructField("normalized_plan", T.StringType()), T.StructField("encoded_normalized_plan", T.StringType())])
SQL_RESPONSE = T.StructType([T.StructField("record", SQL_RECORD), T.StructField("sql_meta", SQL_META_ROW), T.StructField("plan_meta", PLAN_META_ROW)])
STORE_ITEM = T.StructType([T.StructField("timestamp_sec", UNSIGNED), T.StructField("cpu_time_ms", T.LongType()), T.StructField("read_keys", T.LongType()), T.StructField("write_keys", T.LongType())])
RESOURCE_TAG = T.StructType([T.StructField("sql_digest", T.BinaryType()), T.StructField("plan_digest", T.BinaryType()), T.StructField("label", T.IntegerType())])
STORE_RECORD = T.StructType([T.StructField("tag", RESOURCE_TAG), T.StructField("items", T.ArrayType(STORE_ITEM))])

HEALTH = T.ArrayType(T.StructType([T.StructField("member_id", UNSIGNED), T.StructField("health", T.BooleanType())]))
MEMBERS = T.StructType([T.StructField("members", T.ArrayType(T.StructType([T.StructField("member_id", UNSIGNED), T.StructField("client_urls", T.ArrayType(T.StringType()))])))])
STORE_LABEL = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])
STORE = T.StructType([T.StructField("address", T.StringType()), T.StructField("status_address", T.StringType()), T.StructField("state_name", T.StringType()), T.StructField("labels", T.ArrayType(STORE_LABEL))])
STORES = T.StructType([T.StructField("stores", T.ArrayType(T.StructType([T.StructField("store", STORE)])))])
COMPONENT = T.StructType([T.StructField("instance_type", T.StringType()), T.StructField("host", T.StringType()), T.StructField("primary_port", T.IntegerType()), T.StructField("secondary_port", T.IntegerType())])
UPLOAD_KEY = T.StructType([T.StructField(n, T.StringType()) for n in ("filename", "bucket", "object_key")])
