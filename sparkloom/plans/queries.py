"""The reference operators as queries over the driver's tables, each with the same in SQL where SQL has it.

ITEM views events as usage items (see item_view); the other carriers are named in each query. Sessions are in UTC.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions import model as M
from sparkloom.functions.scalars import digest_text, epoch_micros, host_port, md5_base64, tag_label
from sparkloom.operators import encode, points, topology, uploads
from sparkloom.plans import topk
from sparkloom.streaming.retry import next_delay

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
WINDOW_SECONDS = 86_400
#: The instant that stands for now in queries about liveness and expiry (seconds).
NOW = 1_706_600_000


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ITEM_SQL = """
item AS (
  SELECT event_id, event_id // 10 AS record_id, epoch_us(ts) // 1000000 AS timestamp_sec, user_id, event_type,
    CAST(floor(value) AS BIGINT) AS cpu_time_ms, CAST(json_extract_string(props, '$.k') AS BIGINT) % 7 AS stmt_exec_count,
    CAST(round(value * 100) AS BIGINT) AS stmt_duration_sum_ns, CAST(json_extract_string(props, '$.k') AS BIGINT) AS stmt_duration_count,
    hex(event_type || '-' || CAST(user_id % 20 AS VARCHAR)) AS sql_digest, hex('p' || CAST(user_id % 8 AS VARCHAR)) AS plan_digest,
    'db-' || CAST(user_id % 4 AS VARCHAR) || ':10080' AS instance
  FROM events
)"""


def item_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    text = lambda c: c.cast("string")
    return e.select(
        "event_id",
        F.floor(F.col("event_id") / 10).alias("record_id"),
        F.floor(epoch_micros(F.col("ts")) / 1_000_000).alias("timestamp_sec"),
        "user_id",
        "event_type",
        F.floor("value").alias("cpu_time_ms"),
        (k % 7).alias("stmt_exec_count"),
        F.round(F.col("value") * 100).cast("long").alias("stmt_duration_sum_ns"),
        k.alias("stmt_duration_count"),
        F.hex(F.concat("event_type", F.lit("-"), text(F.col("user_id") % 20))).alias("sql_digest"),
        F.hex(F.concat(F.lit("p"), text(F.col("user_id") % 8))).alias("plan_digest"),
        F.concat(F.lit("db-"), text(F.col("user_id") % 4), F.lit(":10080")).alias("instance"),
    )


IDS = ["instance", "instance_type", "sql_digest", "plan_digest", "tag_label", "timestamp_sec"]


def _points_sql(counters: dict[str, str], kind: str, tag: str = "''") -> str:
    return " UNION ALL ".join(f"SELECT '{m}' AS metric, instance, '{kind}' AS instance_type, sql_digest, plan_digest, {tag} AS tag_label, timestamp_sec, CAST({c} AS DOUBLE) AS value FROM item WHERE {c} > 0" for c, m in counters.items())


SQL_POINTS = _points_sql(M.SQL_COUNTERS, M.SQL_LAYER)


def sql_layer_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = item_view(spark, sf_dir).withColumns({"instance_type": F.lit(M.SQL_LAYER), "tag_label": F.lit("")})
    return points.unpivot_counters(items, M.SQL_COUNTERS, IDS).select("metric", *IDS, "value")


@query(f"WITH {ITEM_SQL} {SQL_POINTS}")
def points_unpivot_sql_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql_layer_points(spark, sf_dir)


STORE_ITEM_SQL = f"WITH {ITEM_SQL.replace('item AS', 'base AS')}, item AS (SELECT *, stmt_exec_count AS read_keys, stmt_duration_count AS write_keys, CASE user_id % 4 WHEN 1 THEN 'row' WHEN 2 THEN 'index' ELSE 'unknown' END AS tag FROM base)"


@query(f"{STORE_ITEM_SQL} {_points_sql(M.STORE_COUNTERS, M.ROW_STORE, 'tag')}")
def points_unpivot_row_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = item_view(spark, sf_dir).withColumns({"instance_type": F.lit(M.ROW_STORE), "tag_label": tag_label(F.col("user_id") % 4), "read_keys": F.col("stmt_exec_count"), "write_keys": F.col("stmt_duration_count")})
    return points.unpivot_counters(items, M.STORE_COUNTERS, IDS).select("metric", *IDS, "value")


@query("""
SELECT l_orderkey AS record_id, 'store-' || CAST(l_suppkey AS VARCHAR) || ':20180' AS instance, CAST(max(CAST(l_quantity AS BIGINT) % 5) AS BIGINT) AS value
FROM lineitem GROUP BY ALL HAVING max(CAST(l_quantity AS BIGINT) % 5) > 0
""")
def kv_exec_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order is a record whose item maps each supplier's address to a count (the largest, where one comes twice)."""
    line = read(spark, sf_dir, "lineitem").select("l_orderkey", F.concat(F.lit("store-"), F.col("l_suppkey").cast("string"), F.lit(":20180")).alias("a"), (F.col("l_quantity").cast("long") % 5).alias("n"))
    best = line.groupBy("l_orderkey", "a").agg(F.max("n").alias("n"))
    items = best.groupBy("l_orderkey").agg(F.map_from_entries(F.collect_list(F.struct("a", "n"))).alias("stmt_kv_exec_count"))
    records = items.select(F.col("l_orderkey").cast("string").alias("sql_digest"), F.lit("").alias("plan_digest"), F.lit("").alias("tag_label"), F.timestamp_seconds(F.lit(NOW)).alias("ts"), "stmt_kv_exec_count")
    return points.remote_exec_points(records).select(F.col("sql_digest").cast("long").alias("record_id"), "instance", F.col("value").cast("long").alias("value"))


@query(f"""
WITH {ITEM_SQL}, p AS (SELECT record_id, event_id, sql_digest, plan_digest, instance, timestamp_sec, u.metric, u.v FROM item,
  LATERAL (VALUES ('{M.CPU_TIME}', cpu_time_ms), ('{M.EXEC_COUNT}', stmt_exec_count), ('{M.DURATION_SUM}', stmt_duration_sum_ns), ('{M.DURATION_COUNT}', stmt_duration_count)) u(metric, v) WHERE u.v > 0)
SELECT record_id, metric, instance, sql_digest, plan_digest, string_agg(CAST(timestamp_sec AS VARCHAR), ',' ORDER BY event_id) AS timestamps,
  string_agg(CAST(v AS VARCHAR), ',' ORDER BY event_id) AS series_values FROM p GROUP BY ALL
""")
def series_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = item_view(spark, sf_dir).withColumns({"instance_type": F.lit(M.SQL_LAYER), "tag_label": F.lit("")})
    long = points.unpivot_counters(items, M.SQL_COUNTERS, ["record_id", "event_id", *IDS]).withColumn("ts", F.timestamp_seconds("timestamp_sec"))
    series = points.point_series(long, ["record_id"], "event_id")
    label = lambda k: F.element_at("labels", F.lit(k))
    joined = lambda c: F.array_join(c, ",")
    return series.select(
        "record_id", label(M.NAME).alias("metric"), label("instance").alias("instance"), label("sql_digest").alias("sql_digest"), label("plan_digest").alias("plan_digest"),
        joined(F.transform("timestamps", lambda t: F.unix_seconds(t).cast("string"))).alias("timestamps"), joined(F.transform("values", lambda v: v.cast("long").cast("string"))).alias("series_values"),
    )


@query("SELECT event_id, CASE user_id % 4 WHEN 1 THEN 'row' WHEN 2 THEN 'index' ELSE 'unknown' END AS tag_label FROM events")
def tag_label_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("user_id") % 4 != 3, F.col("user_id") % 4)
    return read(spark, sf_dir, "events").select("event_id", tag_label(label).alias("tag_label"))


@query(f"WITH {ITEM_SQL} SELECT event_id, sql_digest, CASE WHEN stmt_duration_count % 3 = 0 THEN '' ELSE plan_digest END AS plan_digest FROM item WHERE stmt_duration_count % 5 <> 0")
def empty_digest_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags without a sql_digest drop the record, those without a plan_digest have an empty one."""
    k = F.col("stmt_duration_count")
    tag = F.struct(F.when(k % 5 != 0, F.unhex("sql_digest")).alias("sql_digest"), F.when(k % 3 != 0, F.unhex("plan_digest")).alias("plan_digest"), F.lit(1).alias("label"))
    return points.tagged(item_view(spark, sf_dir).select("event_id", F.struct(tag.alias("tag")).alias("record"))).select("event_id", "sql_digest", "plan_digest")


@query(f"WITH {ITEM_SQL} SELECT DISTINCT '{M.INSTANCE}' AS metric, instance, '{M.SQL_LAYER}' AS instance_type, CAST({NOW} AS BIGINT) AS timestamp_sec, CAST(1 AS DOUBLE) AS value FROM item")
def instance_heartbeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    beats = points.heartbeats(item_view(spark, sf_dir).select("instance", F.lit(M.SQL_LAYER).alias("instance_type")), F.timestamp_seconds(F.lit(NOW)))
    label = lambda k: F.element_at("labels", F.lit(k)).alias(k)
    return beats.select(label(M.NAME).alias("metric"), label("instance"), label("instance_type"), F.unix_seconds(F.get("timestamps", F.lit(0))).alias("timestamp_sec"), F.get("values", F.lit(0)).alias("value"))


def _responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses of which each carries a record, a statement, a plan, or nothing, by the part's key."""
    part = read(spark, sf_dir, "part")
    kind = F.col("p_partkey") % 4
    record = F.struct(F.concat(F.lit("s"), F.col("p_brand")).cast("binary").alias("sql_digest"), F.lit(None).cast("binary").alias("plan_digest"))
    statement = F.struct(F.concat(F.lit("s"), F.col("p_brand")).cast("binary").alias("sql_digest"), F.col("p_name").alias("normalized_sql"), (F.col("p_size") % 2 == 0).alias("is_internal_sql"))
    plan = F.struct(F.concat(F.lit("p"), F.col("p_brand")).cast("binary").alias("plan_digest"), F.col("p_type").alias("normalized_plan"), F.when(F.col("p_size") % 3 == 0, F.col("p_name")).alias("encoded_normalized_plan"))
    return part.select("p_partkey", F.when(kind == 0, record).alias("record"), F.when(kind == 1, statement).alias("sql_meta"), F.when(kind == 2, plan).alias("plan_meta"))


@query("SELECT DISTINCT hex('s' || p_brand) AS sql_digest, p_name AS normalized_sql, CASE WHEN p_size % 2 = 0 THEN 'true' ELSE 'false' END AS is_internal_sql FROM part WHERE p_partkey % 4 = 1")
def sql_meta_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points.sql_meta(_responses(spark, sf_dir)).distinct()


@query("SELECT DISTINCT hex('p' || p_brand) AS plan_digest, p_type AS normalized_plan, CASE WHEN p_size % 3 = 0 THEN p_name ELSE '' END AS encoded_normalized_plan FROM part WHERE p_partkey % 4 = 2")
def plan_meta_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points.plan_meta(_responses(spark, sf_dir)).distinct()


@query("""
SELECT 'record' AS kind, hex('s' || p_brand) AS digest, CAST(count(*) AS BIGINT) AS n FROM part WHERE p_partkey % 4 = 0 GROUP BY ALL
UNION ALL SELECT 'sql_meta', hex('s' || p_brand), CAST(count(*) AS BIGINT) FROM part WHERE p_partkey % 4 = 1 GROUP BY ALL
UNION ALL SELECT 'plan_meta', hex('p' || p_brand), CAST(count(*) AS BIGINT) FROM part WHERE p_partkey % 4 = 2 GROUP BY ALL
""")
def oneof_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _responses(spark, sf_dir)
    branch = lambda kind, digest: r.where(f"{kind} IS NOT NULL").select(F.lit(kind).alias("kind"), digest_text(F.col(f"{kind}.{digest}")).alias("digest"))
    every = branch("record", "sql_digest").unionByName(branch("sql_meta", "sql_digest")).unionByName(branch("plan_meta", "plan_digest"))
    return every.groupBy("kind", "digest").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT 'pd' AS instance_type, 'h' || CAST(s_suppkey AS VARCHAR) AS host, CAST(2379 AS INTEGER) AS primary_port, CAST(2379 AS INTEGER) AS secondary_port
FROM supplier WHERE s_suppkey % 7 <> 0 AND s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 0)
""")
def members_healthy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers are members, their nations' health decides; each seventh has no client URL."""
    health = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("member_id"), (F.col("n_regionkey") != 0).alias("health"))
    url = F.concat(F.lit("http://h"), F.col("s_suppkey").cast("string"), F.lit(":2379"))
    members = read(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("member_id"), F.when(F.col("s_suppkey") % 7 != 0, F.array(url, F.lit("x:1"))).otherwise(F.array().cast("array<string>")).alias("client_urls"))
    return topology.live_members(health, members)


@query(f"""
SELECT 'tidb' AS instance_type, 'db' || CAST(c_custkey AS VARCHAR) AS host, CAST(4000 AS INTEGER) AS primary_port, CAST(10080 AS INTEGER) AS secondary_port
FROM customer WHERE c_custkey % 3 <> 0 AND {NOW} - c_custkey % 90 + 45 >= {NOW}
""")
def info_ttl_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers are SQL layers; each third has no sign of life, the others' is up to 89 s old."""
    c = read(spark, sf_dir, "customer")
    address = F.concat(F.lit(topology.KEY_PREFIX + "db"), F.col("c_custkey").cast("string"), F.lit(":4000/"))
    info = c.select(F.concat(address, F.lit("info")).alias("key"), F.lit('{"status_port":10080,"version":"x"}').alias("value"))
    ns = (F.lit(NOW) - F.col("c_custkey") % 90).cast("decimal(38,0)") * F.lit(10**9).cast("decimal(10,0)")
    ttl = c.where("c_custkey % 3 <> 0").select(F.concat(address, F.lit("ttl")).alias("key"), ns.cast("decimal(38,0)").cast("string").alias("value"))
    return topology.live_sql_layers(info.unionByName(ttl), F.lit(NOW * 10**9))


def _components(spark: SparkSession, sf_dir: str, leave: int) -> DataFrame:
    s = read(spark, sf_dir, "supplier").where(F.col("s_suppkey") % leave != 0)
    return s.select(F.when(F.col("s_suppkey") % 2 == 0, M.SQL_LAYER).otherwise(M.ROW_STORE).alias("instance_type"), F.concat(F.lit("h"), (F.col("s_suppkey") % 50).cast("string")).alias("host"), F.col("s_nationkey").alias("primary_port"), F.lit(10080).alias("secondary_port"))


COMPONENTS_SQL = "SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'tidb' ELSE 'tikv' END AS instance_type, 'h' || CAST(s_suppkey % 50 AS VARCHAR) AS host, s_nationkey AS primary_port, CAST(10080 AS INTEGER) AS secondary_port FROM supplier WHERE s_suppkey % {} <> 0"


@query(f"{COMPONENTS_SQL.format(5)} EXCEPT {COMPONENTS_SQL.format(3)}")
def topology_newcomers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topology.changes(_components(spark, sf_dir, 5), _components(spark, sf_dir, 3))[0]


@query(f"{COMPONENTS_SQL.format(3)} EXCEPT {COMPONENTS_SQL.format(5)}")
def topology_leavers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topology.changes(_components(spark, sf_dir, 5), _components(spark, sf_dir, 3))[1]


@query(f"{COMPONENTS_SQL.format(2)} UNION {COMPONENTS_SQL.format(3)} UNION {COMPONENTS_SQL.format(5)}")
def topology_union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topology.live_components(*[_components(spark, sf_dir, n) for n in (2, 3, 5)])


@query(f"SELECT DISTINCT instance_type, host || ':' || CAST(CASE instance_type WHEN 'tidb' THEN secondary_port ELSE primary_port END AS VARCHAR) AS instance, instance_type || '(' || host || ':' || CAST(primary_port AS VARCHAR) || ', ' || host || ':' || CAST(secondary_port AS VARCHAR) || ')' AS shown FROM ({COMPONENTS_SQL.format(5)})")
def subscription_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topology.subscribable(_components(spark, sf_dir, 5).distinct()).select("instance_type", "instance", topology.display().alias("shown"))


def _stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    address = lambda port: F.concat(F.lit("s"), key.cast("string"), F.lit(f":{port}"))
    state = F.when(key % 3 == 0, "Up").when(key % 3 == 1, "UP").otherwise("Down")
    engine = F.array(F.struct(F.lit("engine").alias("key"), F.lit(M.COLUMN_STORE).alias("value")))
    return read(spark, sf_dir, "supplier").select(address(20160).alias("address"), address(20180).alias("status_address"), state.alias("state_name"), F.when(key % 4 == 0, engine).alias("labels"))


STORES_SQL = "SELECT CASE WHEN s_suppkey % 4 = 0 THEN 'tiflash' ELSE 'tikv' END AS instance_type, 's' || CAST(s_suppkey AS VARCHAR) AS host"


@query(f"{STORES_SQL}, CAST(20160 AS INTEGER) AS primary_port, CAST(20180 AS INTEGER) AS secondary_port FROM supplier WHERE s_suppkey % 3 <> 2")
def stores_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topology.live_stores(_stores(spark, sf_dir))


@query("SELECT 's' || CAST(s_suppkey AS VARCHAR) || ':20160' AS address FROM supplier WHERE s_suppkey % 3 <> 2")
def store_up_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topology.live_stores(_stores(spark, sf_dir)).select(F.concat("host", F.lit(":"), F.col("primary_port").cast("string")).alias("address"))


@query("SELECT CASE WHEN s_suppkey % 4 = 0 THEN 'tiflash' ELSE 'tikv' END AS instance_type, CAST(count(*) AS BIGINT) AS n FROM supplier GROUP BY ALL")
def store_engine_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stores(spark, sf_dir).groupBy(topology.store_kind(F.col("labels")).alias("instance_type")).agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN NULL WHEN page_id % 5 = 0 THEN NULL ELSE regexp_extract(url, '://([^/?#]*)', 1) END AS host,
  CAST(CASE WHEN page_id % 3 = 0 OR page_id % 5 = 0 THEN NULL ELSE page_id % 60000 END AS VARCHAR) AS port,
  CASE WHEN page_id % 5 = 0 THEN 'MissingHost' WHEN page_id % 3 = 0 THEN 'MissingPort' END AS error
FROM pages
""")
def host_port_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts of the pages with a port; each third has none, each fifth has no host, and only even ones keep their scheme."""
    p = F.col("page_id")
    host = F.regexp_extract("url", "://([^/?#]*)", 1)
    scheme = F.when(p % 2 == 0, F.regexp_extract("url", "^[a-z]+://", 0)).otherwise(F.lit(""))
    port = F.concat(F.lit(":"), (p % 60000).cast("string"))
    address = F.when(p % 5 == 0, F.concat(scheme, port)).when(p % 3 == 0, F.concat(scheme, host)).otherwise(F.concat(scheme, host, port, F.lit("/x")))
    h, n, error = host_port(address)
    return read(spark, sf_dir, "pages").select("page_id", h.alias("host"), n.cast("string").alias("port"), error.alias("error"))


@query("SELECT 'db' || CAST(c_custkey AS VARCHAR) || ':4000' AS address, CASE WHEN c_custkey % 2 = 0 THEN 'info' ELSE 'ttl/x' END AS kind FROM customer")
def key_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("c_custkey") % 2 == 0, "info").otherwise("ttl/x")
    kvs = read(spark, sf_dir, "customer").select(F.concat(F.lit(topology.KEY_PREFIX + "db"), F.col("c_custkey").cast("string"), F.lit(":4000/"), kind).alias("key"), F.lit("").alias("value"))
    return topology.split_keys(kvs).select("address", "kind")


@query("""
WITH r AS (SELECT DISTINCT o_custkey AS k, epoch_us(o_orderdate) // 1000000 AS mtime FROM orders),
  c AS (SELECT o_custkey AS k, max(epoch_us(o_orderdate) // 1000000) - 86400 * 30 AS upload_at FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1)
SELECT 'f' || CAST(k AS VARCHAR) AS filename, mtime FROM r WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.k = r.k AND c.upload_at >= r.mtime)
""")
def upload_dedup_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select(F.concat(F.lit("f"), F.col("o_custkey").cast("string")).alias("filename"), F.lit("b").alias("bucket"), F.lit("k").alias("object_key"), F.floor(epoch_micros(F.col("o_orderdate")) / 1_000_000).alias("mtime"), "o_orderkey")
    done = o.where("o_orderkey % 2 = 0").groupBy(*uploads.KEY).agg((F.max("mtime") - 86400 * 30).alias("upload_at"))
    return uploads.not_uploaded(o.select(*uploads.KEY, "mtime").distinct(), done).select("filename", "mtime")


PENDING_SECONDS = 21_600


@query(f"""
WITH RECURSIVE t AS (SELECT user_id AS k, epoch_us(ts) // 1000000 AS s FROM events),
a AS (SELECT k, min(s) AS s FROM t GROUP BY k UNION ALL SELECT a.k, (SELECT min(t.s) FROM t WHERE t.k = a.k AND t.s >= a.s + {PENDING_SECONDS}) FROM a WHERE EXISTS (SELECT 1 FROM t WHERE t.k = a.k AND t.s >= a.s + {PENDING_SECONDS}))
SELECT k AS user_id, s AS requested_at FROM a
""")
def upload_pending_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests that start an upload; those that come while one waits are answered with it."""
    e = read(spark, sf_dir, "events").select("user_id", F.floor(epoch_micros(F.col("ts")) / 1_000_000).alias("requested_at"))
    return uploads.accepted_requests(e, ["user_id"], "requested_at", PENDING_SECONDS)


@query(f"SELECT event_id FROM events WHERE epoch_us(ts) // 1000000 + 1800 >= {NOW} - 432000")
def checkpoint_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select("event_id", (F.floor(epoch_micros(F.col("ts")) / 1_000_000) + uploads.EXPIRE_SECONDS).alias("expire_at"))
    return uploads.live_checkpoints(e, F.lit(NOW - 432_000)).select("event_id")


@query("SELECT event_id, epoch_us(ts) // 1000 AS millis FROM events")
def import_encode_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("millis"))


@query("SELECT event_id FROM events WHERE user_id % 10 NOT IN (1, 2, 3) AND event_id % 11 <> 0 AND event_id % 13 <> 0")
def import_drop_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a NaN, infinite or null value, a null time or a null label are dropped whole."""
    u = F.col("user_id") % 10
    bad = F.when(u == 1, float("nan")).when(u == 2, float("inf")).when(u != 3, F.col("value"))
    labels = F.create_map(F.lit("a"), F.when(F.col("event_id") % 13 != 0, F.lit("x")))
    e = read(spark, sf_dir, "events").select("event_id", labels.alias("labels"), F.array(F.when(F.col("event_id") % 11 != 0, F.col("ts").cast("timestamp"))).alias("timestamps"), F.array("value", bad).alias("values"))
    return e.where(encode.encodable()).select("event_id")


@query(f"""
WITH {ITEM_SQL}, line AS (SELECT event_id, 'http://localhost:8080/metrics/' || instance AS endpoint,
  '{{"metric":{{"__name__":"{M.CPU_TIME}","cluster_id":"' || instance || '"}},"timestamps":[' || CAST(timestamp_sec * 1000 AS VARCHAR) || '],"values":[' || CAST(cpu_time_ms AS VARCHAR) || '.0]}}' AS line FROM item WHERE cpu_time_ms > 0)
SELECT endpoint, md5(line) AS line_md5 FROM line
""")
def import_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = item_view(spark, sf_dir).where("cpu_time_ms > 0")
    series = i.select(F.create_map(F.lit("cluster_id"), F.col("instance"), F.lit(M.NAME), F.lit(M.CPU_TIME)).alias("labels"), F.array(F.timestamp_seconds("timestamp_sec")).alias("timestamps"), F.array(F.col("cpu_time_ms").cast("double")).alias("values"))
    return encode.encode(series, "http://localhost:8080/metrics/{{ .labels.cluster_id }}").select("endpoint", F.md5(F.col("line").cast("binary")).alias("line_md5"))


@query(f"WITH {ITEM_SQL}, b AS (SELECT instance, (row_number() OVER (PARTITION BY instance ORDER BY event_id) - 1) // 1000 AS batch FROM item) SELECT 'http://store/' || instance AS endpoint, batch, CAST(count(*) AS BIGINT) AS n FROM b GROUP BY ALL")
def endpoint_partition_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = item_view(spark, sf_dir).select(F.create_map(F.lit("instance"), F.col("instance")).alias("labels"), "event_id")
    at = i.select(encode.compile_template("http://store/{{ labels.instance }}").alias("endpoint"), "event_id")
    return encode.batches(at, "endpoint", "event_id").groupBy("endpoint", "batch").agg(F.count(F.lit(1)).alias("n"))


TOP_SQL = """
, p AS ({points}), s AS (SELECT instance, instance_type, sql_digest, plan_digest, tag_label, metric, sum(CAST(value AS DOUBLE)) AS total
  FROM p WHERE metric = '{metric}' AND timestamp_sec > (SELECT max(timestamp_sec) FROM item) - {window} AND timestamp_sec <= (SELECT max(timestamp_sec) FROM item) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY metric, instance, instance_type ORDER BY total DESC, sql_digest, plan_digest, tag_label) AS rank FROM s)
"""


def _top(spark: SparkSession, sf_dir: str, metric: str, k: int = 5) -> DataFrame:
    """Top k of each instance over the last day of the data (300 s in production; the data has a point in some minutes)."""
    items = item_view(spark, sf_dir)
    end = items.agg(F.max("timestamp_sec")).scalar()  # part of the plan: nothing runs while it is made
    at = topk.trailing(sql_layer_points(spark, sf_dir).where(F.col("metric") == metric), end, WINDOW_SECONDS, "timestamp_sec")
    return topk.top_k(topk.sum_over_time(at), k)


def _top_sql(metric: str) -> str:
    return f"WITH {ITEM_SQL} {TOP_SQL.format(points=SQL_POINTS, metric=metric, window=WINDOW_SECONDS)}"


TOP_COLUMNS = "metric, instance, instance_type, sql_digest, plan_digest, tag_label, total, CAST(rank AS INTEGER) AS rank"


@query(f"{_top_sql(M.CPU_TIME)} SELECT {TOP_COLUMNS} FROM r WHERE rank <= 5")
def topk_cpu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(spark, sf_dir, M.CPU_TIME)


@query(f"{_top_sql(M.EXEC_COUNT)} SELECT {TOP_COLUMNS} FROM r WHERE rank <= 5")
def topk_exec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(spark, sf_dir, M.EXEC_COUNT)


@query(f"{_top_sql(M.DURATION_SUM)} SELECT {TOP_COLUMNS} FROM r WHERE rank <= 5")
def topk_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(spark, sf_dir, M.DURATION_SUM)


@query(f"{_top_sql(M.CPU_TIME)} SELECT {TOP_COLUMNS}, 'select `c` from `t_' || event_type || '` where `id` = ?' AS normalized_sql FROM r LEFT JOIN (SELECT DISTINCT sql_digest, event_type FROM item WHERE user_id % 3 <> 0) USING (sql_digest) WHERE rank <= 5")
def topk_with_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("select `c` from `t_"), F.col("event_type"), F.lit("` where `id` = ?"))
    meta = item_view(spark, sf_dir).where("user_id % 3 <> 0").select("sql_digest", text.alias("normalized_sql"))
    return topk.with_statement(_top(spark, sf_dir, M.CPU_TIME), meta)


@query(f"WITH {ITEM_SQL} SELECT DISTINCT metric FROM ({SQL_POINTS})")
def metric_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql_layer_points(spark, sf_dir).select("metric").distinct()


@query("SELECT doc_id, '\"' || md5(text) || '\"' AS etag, base64(unhex(md5(text))) AS md5_hash FROM documents")
def content_md5(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.col("text").cast("binary")
    return read(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit('"'), F.md5(raw), F.lit('"')).alias("etag"), md5_base64(raw).alias("md5_hash"))


@query("SELECT CAST(a AS INTEGER) AS attempt, CAST(d AS DOUBLE) AS delay FROM (VALUES (1, 2), (2, 4), (3, 8), (4, 16), (5, 32), (6, 60), (7, 60)) t(a, d)")
def backoff_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    delay, rows = 1.0, []
    for attempt in range(1, 8):
        delay = next_delay(delay)
        rows.append((attempt, delay))
    return spark.createDataFrame(rows, "attempt int, delay double")
