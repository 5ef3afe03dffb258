import pytest
from pyspark.sql import functions as F

from sparkloom.functions import model as M
from sparkloom.functions.scalars import host_port, with_scheme
from sparkloom.operators import topology
from sparkloom.sources.usage import TopologyFetcher

NOW = 1_700_000_000_000_000_000


def test_host_port(spark):
    cases = {
        "localhost:2379": ("localhost", 2379, None), "http://localhost:2379": ("localhost", 2379, None), "https://localhost:2379": ("localhost", 2379, None),
        "localhost": (None, None, "MissingPort"), ":2379": (None, None, "MissingHost"), "!@#": (None, None, "ParseAddress"), "h:99999": (None, None, "ParseAddress"),
    }
    df = spark.createDataFrame([(k,) for k in cases], "a string")
    h, p, e = host_port(F.col("a"))
    assert {r.a: (r.h, r.p, r.e) for r in df.select("a", h.alias("h"), p.alias("p"), e.alias("e")).collect()} == cases
    assert with_scheme("a:1/", False) == "http://a:1" and with_scheme("a:1", True) == "https://a:1" and with_scheme("http://a:1/", True) == "http://a:1"


def fetcher(**change):
    bodies = {
        "/pd/api/v1/health": '[{"member_id": 18446744073709551615, "health": true, "x": 1}, {"member_id": 2, "health": false}, {"member_id": 3, "health": true}]',
        "/pd/api/v1/members": '{"members": [{"member_id": 18446744073709551615, "client_urls": ["http://pd:2379", "http://no:1"]}, {"member_id": 2, "client_urls": ["http://bad:1"]}, {"member_id": 3, "client_urls": []}]}',
        "/pd/api/v1/stores": '{"stores": [{"store": {"address": "kv:20160", "status_address": "other:20180", "state_name": "UP"}}, {"store": {"address": "fl:3930", "status_address": "fl:20292", "state_name": "Up", "labels": [{"key": "engine", "value": "tiflash"}]}}, {"store": {"address": "gone:1", "status_address": "gone:2", "state_name": "Down", "labels": []}}]}',
        "kvs": [("/topology/tidb/127.0.0.1:4000/info", '{"status_port": 10080, "v": 1}'), ("/topology/tidb/127.0.0.1:4000/ttl", str(NOW - 45 * 10**9)), ("/topology/tidb/dead:4000/info", '{"status_port": 1}'), ("/topology/tidb/dead:4000/ttl", str(NOW - 45 * 10**9 - 1)), ("/topology/tidb/lone:4000/info", '{"status_port": 1}'), ("/topology/tidb/x:1/other", "?")],
    } | change
    return TopologyFetcher(bodies.__getitem__, lambda prefix: bodies["kvs"])


def test_live_components(spark):
    got = fetcher().live(spark, NOW)
    assert sorted(map(tuple, got.collect())) == [("pd", "pd", 2379, 2379), ("tidb", "127.0.0.1", 4000, 10080), ("tiflash", "fl", 3930, 20292), ("tikv", "kv", 20160, 20180)]
    assert {r.instance for r in topology.subscribable(got).collect()} == {"127.0.0.1:10080", "kv:20160"}
    assert got.where("instance_type = 'tidb'").select(topology.display()).first()[0] == "tidb(127.0.0.1:4000, 127.0.0.1:10080)"


@pytest.mark.parametrize("kvs", [[("/topology/tidb/a:1", "")], [("/topology/tidb/a:1/ttl", "x")], [("/topology/tidb/a:1/info", "{")]])
def test_a_bad_part_fails_the_fetch(spark, kvs):
    with pytest.raises(Exception):  # noqa: B017
        fetcher(kvs=kvs).live(spark, NOW).collect()
    with pytest.raises(Exception):  # noqa: B017
        fetcher(**{"/pd/api/v1/health": "{"}).live(spark, NOW).collect()


def test_changes(spark):
    row = lambda n, p: ("tidb", n, 1, p)
    a, b = (spark.createDataFrame(x, M.COMPONENT) for x in ([row("a", 1), row("b", 1)], [row("b", 1), row("a", 2)]))
    new, gone = topology.changes(a, b)
    assert [tuple(r) for r in new.collect()] == [row("a", 1)] and [tuple(r) for r in gone.collect()] == [row("a", 2)]
