"""Source of usage points: finds the live components, reads each one's stream, and gives its responses as rows.

The transport is an interface (Transport): there is no RPC library here, so the one built in replays captured frames
from files. One input partition reads one component, so a component's stream is never shared between tasks.
"""

from __future__ import annotations

import json
import os
import struct
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from sparkloom.functions import model as M
from sparkloom.functions.scalars import with_scheme
from sparkloom.functions.wire import decode_sql_response, decode_store_response
from sparkloom.operators import points, topology
from sparkloom.registry import source

SCHEMA = "instance string, instance_type string, frame binary"


def get_json(url: str, timeout: float = 10.0) -> str:
    """The body of a GET, whatever its status."""
    try:
        with urllib.request.urlopen(url, timeout=timeout) as answer:
            return answer.read().decode()
    except urllib.error.HTTPError as e:
        return e.read().decode()


@dataclass
class TopologyFetcher:
    """Reads the three services; fetch(path) returns a JSON body and scan(prefix) the store's (key, value) pairs."""

    fetch: Callable[[str], str]
    scan: Callable[[str], list[tuple[str, str]]]

    @classmethod
    def http(cls, address: str, tls: bool, scan: Callable[[str], list[tuple[str, str]]]) -> TopologyFetcher:
        base = with_scheme(address, tls)
        return cls(lambda path: get_json(base + path), scan)

    def live(self, spark: SparkSession, now_ns: int) -> DataFrame:
        """Live components. Any part that fails or doesn't parse fails the whole."""
        body = lambda path, schema: topology.parsed(spark.createDataFrame([(self.fetch(path),)], "body string"), schema)
        health = body("/pd/api/v1/health", M.HEALTH).select(F.inline("body"))
        members = body("/pd/api/v1/members", M.MEMBERS).select(F.inline("body.members"))
        stores = body("/pd/api/v1/stores", M.STORES).select(F.explode("body.stores.store").alias("s")).select("s.*")
        kvs = spark.createDataFrame(self.scan(topology.KEY_PREFIX), "key string, value string")
        return topology.live_components(topology.live_members(health, members), topology.live_sql_layers(kvs, F.lit(now_ns)), topology.live_stores(stores))


class Transport:
    """A component's frames. position counts those already read, so that a stream goes on where it stopped."""

    def instances(self) -> list[tuple[str, str]]:
        raise NotImplementedError

    def end(self, instance: str) -> int:
        raise NotImplementedError

    def frames(self, instance: str, start: int, end: int) -> Iterator[bytes]:
        raise NotImplementedError


class Replay(Transport):
    """Captured frames: a folder with instances.json ([[instance, type], ...]) and a file of length-prefixed frames for each instance."""

    def __init__(self, folder: str):
        self.folder = folder

    def instances(self) -> list[tuple[str, str]]:
        with open(os.path.join(self.folder, "instances.json")) as file:
            return [(a, b) for a, b in json.load(file) if b in (M.SQL_LAYER, M.ROW_STORE)]

    def _read(self, instance: str) -> Iterator[bytes]:
        path = os.path.join(self.folder, instance.replace(":", "_"))
        if not os.path.exists(path):
            return
        with open(path, "rb") as file:
            while len(head := file.read(4)) == 4:
                yield file.read(struct.unpack(">I", head)[0])

    def end(self, instance: str) -> int:
        return sum(1 for _ in self._read(instance))

    def frames(self, instance: str, start: int, end: int) -> Iterator[bytes]:
        for at, frame in enumerate(self._read(instance)):
            if start <= at < end:
                yield frame

    @staticmethod
    def capture(folder: str, instance: str, frames: list[bytes]) -> None:
        with open(os.path.join(folder, instance.replace(":", "_")), "ab") as file:
            for frame in frames:
                file.write(struct.pack(">I", len(frame)) + frame)


@dataclass
class Part(InputPartition):
    instance: str
    kind: str
    start: int
    end: int

    def __post_init__(self) -> None:
        super().__init__(self.instance)


def _emit(transport: Transport, part: Part) -> Iterator[tuple]:
    for frame in transport.frames(part.instance, part.start, part.end):
        yield part.instance, part.kind, frame


class _Batch(DataSourceReader):
    def __init__(self, transport: Transport):
        self.transport = transport

    def partitions(self) -> list[InputPartition]:
        return [Part(a, b, 0, self.transport.end(a)) for a, b in self.transport.instances()]

    def read(self, partition: Part) -> Iterator[tuple]:
        yield from _emit(self.transport, partition)


class _Stream(DataSourceStreamReader):
    """Offsets are {instance: {kind, frames}}. A component that has left keeps its offset, and is read on when it returns.

    What a batch reads is in its offsets alone, so a component that leaves while the batch is planned is read all the
    same. If a stream is started again while a component is away, its offset is taken from the batch that is planned first.
    """

    def __init__(self, transport: Transport):
        self.transport = transport
        self.known: dict[str, dict] = {}
        self.away: dict[str, dict] = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        for a, kind in self.transport.instances():
            self.known[a] = {"kind": kind, "frames": max(self.transport.end(a), self.known.get(a, {}).get("frames", 0))}
        return {a: dict(x) for a, x in self.known.items()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        parts = []
        for a, x in end.items():
            before = start.get(a) or self.away.pop(a, None) or {"frames": 0}
            if x["frames"] > before["frames"]:
                parts.append(Part(a, x["kind"], before["frames"], x["frames"]))
        for a, x in start.items():
            if a not in end:  # from before a restart
                self.away[a] = dict(x)
                self.known.setdefault(a, dict(x))
        return parts

    def read(self, partition: Part) -> Iterator[tuple]:
        yield from _emit(self.transport, partition)

    def commit(self, end: dict) -> None:
        pass


@source("topsql")
class UsageSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "topsql"

    def __init__(self, options: dict):
        super().__init__(options)
        self.transport = Replay(options["replay"])

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: object) -> DataSourceReader:
        return _Batch(self.transport)

    def streamReader(self, schema: object) -> DataSourceStreamReader:
        return _Stream(self.transport)


def received(frames: DataFrame, name: object = "received") -> DataFrame:
    """frames, with the number of events and bytes that pass as an observed metric."""
    return frames.observe(name, F.count(F.lit(1)).alias("events"), F.coalesce(F.sum(F.octet_length("frame")), F.lit(0)).alias("bytes"))


def usage_points(frames: DataFrame) -> DataFrame:
    """Points of the frames of either kind; decoding is the one step in Python, all else is native."""
    sql = frames.where(F.col("instance_type") == M.SQL_LAYER).select("instance", decode_sql_response(F.col("frame")).alias("r")).select("instance", "r.*")
    store = frames.where(F.col("instance_type") == M.ROW_STORE).select("instance", decode_store_response(F.col("frame")).alias("r")).select("instance", "r.*").where("record IS NOT NULL")
    return points.sql_record_points(sql.select("instance", "record")).unionByName(points.store_record_points(store))


def usage_meta(frames: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Statement and plan metadata of the SQL layers' frames."""
    sql = frames.where(F.col("instance_type") == M.SQL_LAYER).select(decode_sql_response(F.col("frame")).alias("r")).select("r.*")
    return points.sql_meta(sql), points.plan_meta(sql)
