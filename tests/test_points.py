"""Goldens of the usage streams: decoded frames, points, series and import lines."""

import datetime
import json

from pyspark.sql import functions as F

from sparkloom.functions import wire
from sparkloom.operators import encode, points
from sparkloom.sources import usage


def sql_frame():
    m = wire.messages()["SqlResponse"]()
    m.record.sql_digest, m.record.plan_digest = b"sql_digest", b"plan_digest"
    i = m.record.items.add(timestamp_sec=1655363650, cpu_time_ms=10, stmt_exec_count=20, stmt_duration_sum_ns=30, stmt_duration_count=20)
    i.stmt_kv_exec_count["127.0.0.1:20180"] = 10
    return m.SerializeToString()


def store_frame(tag, **item):
    m = wire.messages()["StoreResponse"]()
    m.record.resource_group_tag = tag
    m.record.items.add(timestamp_sec=1655363650, **item)
    return m.SerializeToString()


TAG = bytes.fromhex("0a0a73716c5f646967657374120b706c616e5f6469676573741801")


def point_rows(spark, frames):
    df = usage.usage_points(spark.createDataFrame(frames, usage.SCHEMA))
    return sorted((r.metric, r.instance, r.instance_type, r.sql_digest, r.plan_digest, r.tag_label, r.value) for r in df.collect())


def test_sql_layer_points(spark):
    s, p = "73716C5F646967657374", "706C616E5F646967657374"
    assert point_rows(spark, [("I", "tidb", sql_frame())]) == sorted(
        [
            ("topsql_cpu_time_ms", "I", "tidb", s, p, "", 10.0),
            ("topsql_stmt_exec_count", "I", "tidb", s, p, "", 20.0),
            ("topsql_stmt_duration_sum_ns", "I", "tidb", s, p, "", 30.0),
            ("topsql_stmt_duration_count", "I", "tidb", s, p, "", 20.0),
            ("topsql_stmt_exec_count", "127.0.0.1:20180", "tikv", s, p, "", 10.0),
        ]
    )


def test_row_store_points_and_tags(spark):
    full = {"cpu_time_ms": 10, "read_keys": 20, "write_keys": 30}
    got = point_rows(spark, [("I", "tikv", store_frame(TAG, **full))])
    assert [(m, v, label) for m, _, _, _, _, label, v in got] == [("topsql_cpu_time_ms", 10.0, "row"), ("topsql_read_keys", 20.0, "row"), ("topsql_write_keys", 30.0, "row")]
    empty = wire.messages()["ResourceTag"](sql_digest=b"").SerializeToString()
    none = wire.messages()["ResourceTag"](plan_digest=b"p").SerializeToString()
    index = wire.messages()["ResourceTag"](sql_digest=b"s", label=2).SerializeToString()
    frames = [("I", "tikv", store_frame(t, cpu_time_ms=1)) for t in (b"", none, b"\xff\xff", empty, index)] + [("I", "tikv", b"\xff\xff"), ("I", "tikv", store_frame(TAG)), ("I", "tikv", None)]
    assert [(r[3], r[5]) for r in point_rows(spark, frames)] == [("", "unknown"), ("73", "index")]


def test_meta_and_last_of_several_wins(spark):
    m = wire.messages()["SqlResponse"]()
    m.record.sql_digest = b"x"
    n = wire.messages()["SqlResponse"]()
    n.sql_meta.sql_digest, n.sql_meta.normalized_sql = b"s", "select 1"
    both = m.SerializeToString() + n.SerializeToString()
    assert wire.sql_response(both)["record"] is None
    p = wire.messages()["SqlResponse"]()
    p.plan_meta.plan_digest = b"p"
    frames = spark.createDataFrame([("I", "tidb", x) for x in (both, p.SerializeToString())], usage.SCHEMA)
    sql, plan = usage.usage_meta(frames)
    assert [tuple(r) for r in sql.collect()] == [("73", "select 1", "false")]
    assert [tuple(r) for r in plan.collect()] == [("70", "", "")]


def test_unsigned_numbers_and_bad_times(spark):
    m = wire.messages()["SqlResponse"]()
    m.record.sql_digest = b"s"
    m.record.items.add(timestamp_sec=2**64 - 1, cpu_time_ms=1)
    m.record.items.add(timestamp_sec=1, stmt_exec_count=2**64 - 1)
    assert [r[-1] for r in point_rows(spark, [("I", "tidb", m.SerializeToString())])] == [float(2**64 - 1)]


def series(spark, values, labels=None, times=None):
    from sparkloom.functions.model import SERIES

    times = times or [datetime.datetime.fromtimestamp(1661396787 + i, datetime.UTC) for i in range(len(values))]
    labels = labels or {"__name__": "topsql_cpu_time_ms", "instance": "db:10080", "instance_type": "tidb", "sql_digest": "DEAD", "plan_digest": "BEEF", "tag_label": ""}
    return spark.createDataFrame([(labels, times, values)], SERIES)


def test_import_line_golden(spark):
    row = encode.encode(series(spark, [80.0, 443.0]), "http://x/").first()
    assert json.loads(row.line) == {
        "metric": {"__name__": "topsql_cpu_time_ms", "instance": "db:10080", "instance_type": "tidb", "sql_digest": "DEAD", "plan_digest": "BEEF", "tag_label": ""},
        "timestamps": [1661396787000, 1661396788000],
        "values": [80.0, 443.0],
    }


def test_templates_and_dropped_events(spark):
    labels = {"cluster_id": "10086", "__name__": "m"}
    for t in ("http://localhost:8080/metrics/{{ .labels.cluster_id }}", "http://localhost:8080/metrics/{{ labels.cluster_id }}"):
        assert encode.encode(series(spark, [1.0], labels), t).first().endpoint == "http://localhost:8080/metrics/10086"
    assert encode.encode(series(spark, [1.0], labels), "http://x/{{ labels.no }}").isEmpty()
    for bad in (float("nan"), float("inf"), float("-inf")):
        assert encode.encode(series(spark, [1.0, bad]), "http://x/").isEmpty()


def test_series_round_trip_and_batches(spark):
    long = points.series_points(series(spark, [80.0, 443.0]))
    back = points.point_series(long.withColumn("record", F.lit(1)), ["record"], "ts").first()
    assert back["values"] == [80.0, 443.0] and back.labels["tag_label"] == ""
    events = spark.range(2500).select(F.when(F.col("id") < 2300, "a").otherwise("b").alias("endpoint"), "id")
    got = encode.batches(events, "endpoint", "id").groupBy("endpoint", "batch").agg(F.count("*").alias("n"), F.min("id").alias("low")).orderBy("endpoint", "batch").collect()
    assert [(r.endpoint, r.batch, r.n, r.low) for r in got] == [("a", 0, 1000, 0), ("a", 1, 1000, 1000), ("a", 2, 300, 2000), ("b", 0, 200, 2300)]
