"""Live components from what the cluster's services report, and how the set changes between polls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import model as M
from sparkloom.functions.scalars import host_port

#: A component is live for this long after its last sign of life, the limit included.
SLACK_NS = 45 * 1_000_000_000
KEY_PREFIX = "/topology/tidb/"  # fixed value of the store's key layout
IDENTITY = ["instance_type", "host", "primary_port", "secondary_port"]


def _checked(value: Column, error: Column, what: str) -> Column:
    """value, or an error that ends the query: a fetch is whole or it fails."""
    return F.when(error.isNotNull(), F.raise_error(F.concat(F.lit(f"{what}: "), error)).cast("string")).otherwise(value)


def _component(kind: Column | str, host: Column, primary: Column, secondary: Column) -> list[Column]:
    return [(F.lit(kind) if isinstance(kind, str) else kind).alias("instance_type"), host.alias("host"), primary.cast("int").alias("primary_port"), secondary.cast("int").alias("secondary_port")]


def parsed(json: DataFrame, schema: object) -> DataFrame:
    """A column body of JSON text as body; malformed text ends the query, unknown fields are ignored."""
    kind = schema.simpleString()
    return json.select(F.from_json("body", kind, {"mode": "FAILFAST"}).alias("body"))


def live_members(health: DataFrame, members: DataFrame) -> DataFrame:
    """Placement members (member_id, client_urls) whose member_id is healthy; the first client URL gives both ports."""
    healthy = health.where("health").select("member_id").distinct()
    up = members.join(healthy, "member_id", "left_semi").select(F.get("client_urls", F.lit(0)).alias("url")).where("url IS NOT NULL")
    host, port, error = host_port(F.col("url"))
    return up.select(*_component(M.PLACEMENT, _checked(host, error, "client url"), port, port))


def split_keys(kvs: DataFrame) -> DataFrame:
    """(key, value) to (address, kind, value): the key is prefix, address and kind. A key without a kind ends the query."""
    rest = F.expr(f"substring(key, {len(KEY_PREFIX) + 1})")
    parts = F.split(rest, "/", 2)
    kind = F.get(parts, F.lit(1))
    return kvs.where(F.startswith("key", F.lit(KEY_PREFIX))).select(F.get(parts, F.lit(0)).alias("address"), F.coalesce(kind, F.raise_error(F.concat(F.lit("no kind in key "), F.col("key"))).cast("string")).alias("kind"), "value")


def live_sql_layers(kvs: DataFrame, now_ns: Column) -> DataFrame:
    """Components with an info value and a sign of life recent enough; all values must parse, dead ones too."""
    found = split_keys(kvs)
    ttl = F.col("value").try_cast("decimal(38,0)") if hasattr(F.col("value"), "try_cast") else F.expr("try_cast(value AS decimal(38,0))")
    ttls = found.where("kind = 'ttl'").select("address", F.coalesce(ttl, F.raise_error(F.concat(F.lit("bad ttl of "), F.col("address"))).cast("decimal(38,0)")).alias("ttl"))
    status = F.from_json("value", "status_port INT", {"mode": "FAILFAST"})["status_port"]
    infos = found.where("kind = 'info'").select("address", F.coalesce(status, F.raise_error(F.concat(F.lit("bad info of "), F.col("address"))).cast("int")).alias("status_port"))
    live = ttls.where(F.col("ttl") + F.lit(SLACK_NS).cast("decimal(38,0)") >= now_ns.cast("decimal(38,0)")).select("address").distinct()
    host, port, error = host_port(F.col("address"))
    return infos.join(live, "address", "left_semi").select(*_component(M.SQL_LAYER, _checked(host, error, "address"), port, F.col("status_port")))


def store_kind(labels: Column) -> Column:
    """The column store is the one that says so; every other store is a row store."""
    column_store = F.exists(F.coalesce(labels, F.array().cast(labels_type())), lambda x: (x["key"] == "engine") & (x["value"] == M.COLUMN_STORE))
    return F.when(column_store, M.COLUMN_STORE).otherwise(M.ROW_STORE)


def labels_type() -> str:
    return "array<struct<key:string,value:string>>"


def live_stores(stores: DataFrame) -> DataFrame:
    """Stores (address, status_address, state_name, labels) that are up; the secondary port is the status address's."""
    up = stores.where(F.lower("state_name") == "up")
    host, port, error = host_port(F.col("address"))
    _, status, status_error = host_port(F.col("status_address"))
    return up.select(*_component(store_kind(F.col("labels")), _checked(host, F.coalesce(error, status_error), "store address"), port, status))


def live_components(members: DataFrame, sql_layers: DataFrame, stores: DataFrame) -> DataFrame:
    return members.unionByName(sql_layers).unionByName(stores).distinct()


def subscription_address() -> Column:
    """Where a component's usage is read: the SQL layer's status port, the row store's primary port, else null."""
    port = F.when(F.col("instance_type") == M.SQL_LAYER, F.col("secondary_port")).when(F.col("instance_type") == M.ROW_STORE, F.col("primary_port"))
    return F.concat("host", F.lit(":"), port.cast("string"))


def subscribable(components: DataFrame) -> DataFrame:
    """Components with the instance they are read at; the others are left out."""
    return components.withColumn("instance", subscription_address()).where("instance IS NOT NULL")


def display() -> Column:
    return F.format_string("%s(%s:%d, %s:%d)", "instance_type", "host", "primary_port", "host", "secondary_port")


def changes(latest: DataFrame, current: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Newcomers and leavers, on all four fields."""
    return latest.select(*IDENTITY).subtract(current.select(*IDENTITY)), current.select(*IDENTITY).subtract(latest.select(*IDENTITY))
