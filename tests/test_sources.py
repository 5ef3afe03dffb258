import gzip
import http.server
import json
import threading

import pytest
from pyspark.sql import functions as F

from sparkloom import config, registry
from sparkloom.sinks import http_import
from sparkloom.sources.usage import Replay, received, usage_points
from tests.test_points import TAG, series, sql_frame, store_frame


def test_file_names(spark, tmp_path):
    registry.register_all(spark)
    for name in ("a.log", "b.log", "sub/c.log", "sub/d.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("x")
    df = spark.read.format("filename").option("include", f"{tmp_path}/**").option("exclude", f"{tmp_path}/b*,*.txt").load()
    assert sorted(r.message for r in df.collect()) == [f"{tmp_path}/a.log", f"{tmp_path}/sub/c.log"]
    with pytest.raises(Exception):  # noqa: B017
        spark.read.format("filename").option("include", "[").option("nonsense", "1").load().collect()


def test_usage_replay_batch_and_stream(spark, tmp_path):
    registry.register_all(spark)
    (tmp_path / "instances.json").write_text(json.dumps([["db:10080", "tidb"], ["kv:20160", "tikv"], ["pd:2379", "pd"]]))
    Replay.capture(str(tmp_path), "db:10080", [sql_frame()])
    Replay.capture(str(tmp_path), "kv:20160", [store_frame(TAG, cpu_time_ms=1)])
    assert usage_points(spark.read.format("topsql").option("replay", str(tmp_path)).load()).count() == 6
    from pyspark.sql import Observation

    seen = Observation("seen")
    frames = spark.read.format("topsql").option("replay", str(tmp_path)).load()
    assert received(frames, seen).count() == 2 and seen.get["events"] == 2 and seen.get["bytes"] > 0
    stream = spark.readStream.format("topsql").option("replay", str(tmp_path)).load()
    query = stream.writeStream.format("memory").queryName("frames").option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        query.processAllAvailable()
        Replay.capture(str(tmp_path), "kv:20160", [store_frame(TAG, read_keys=1)])
        query.processAllAvailable()
        assert spark.table("frames").count() == 3
    finally:
        query.stop()


def test_components_that_leave_and_return(tmp_path):
    from sparkloom.sources.usage import _Stream

    live = lambda *names: (tmp_path / "instances.json").write_text(json.dumps([[n, "tidb"] for n in names]))
    for n in ("a:1", "b:1"):
        Replay.capture(str(tmp_path), n, [b"x"] * 5)
    live("a:1", "b:1")
    stream, start, read = _Stream(Replay(str(tmp_path))), {}, []

    def step(stream, start, end):
        for p in stream.partitions(start, end):
            read.extend((p.instance, k) for k in range(p.start, p.end))
        return json.loads(json.dumps(end))

    end = stream.latestOffset()
    live("b:1")  # gone before the batch is planned: read all the same
    start = step(stream, start, end)
    start = step(stream, start, stream.latestOffset())
    Replay.capture(str(tmp_path), "a:1", [b"y"] * 2)
    start = step(stream, start, stream.latestOffset())
    stream = _Stream(Replay(str(tmp_path)))  # started again while a:1 is away
    start = step(stream, start, stream.latestOffset())
    live("a:1", "b:1")
    start = step(stream, start, stream.latestOffset())
    assert sorted(read) == [("a:1", k) for k in range(7)] + [("b:1", k) for k in range(5)]


def test_sums_are_those_of_the_values(spark):
    from sparkloom.functions.model import POINT_LABELS
    from sparkloom.plans.topk import sum_over_time

    rows = [("m", *["x"] * len(POINT_LABELS), 0.004)] * 3 + [("n", *["x"] * len(POINT_LABELS), 1e17)]
    schema = ", ".join(f"{c} string" for c in ("metric", *POINT_LABELS)) + ", value double"
    got = {r.metric: r.total for r in sum_over_time(spark.createDataFrame(rows, schema)).collect()}
    assert got["m"] == pytest.approx(0.012, abs=1e-12) and got["n"] == 1e17


def test_requests_are_made_as_set(tmp_path):
    asked = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            self.rfile.read(int(self.headers["Content-Length"]))
            asked.append(self.path)
            self.send_response({"/busy": 503 if asked.count("/busy") < 3 else 204, "/wrong": 400}.get(self.path, 500))
            self.end_headers()

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    how = http_import.Request.of(config.ImportSink(base, request={"retry_attempts": 2, "retry_initial_backoff_secs": 0.01, "timeout_secs": 5}))
    assert http_import.post(f"{base}/busy", ["{}"], how) == 204 and asked.count("/busy") == 3
    for path, times in (("/wrong", 1), ("/down", 3)):
        with pytest.raises(OSError):
            http_import.post(f"{base}{path}", ["{}"], how)
        assert asked.count(path) == times
    with pytest.raises(config.ConfigError):
        http_import.Request.of(config.ImportSink(base, request={"nonsense": 1}))
    server.shutdown()


def test_http_import(spark):
    got = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            raw = self.rfile.read(int(self.headers["Content-Length"]))
            got.append((self.path, self.headers["Content-Encoding"], gzip.decompress(raw).decode()))
            self.send_response(204)
            self.end_headers()

        def do_GET(self):
            self.send_response(200 if self.path == "/ok" else 500)
            self.end_headers()

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    many = series(spark, [1.0], {"__name__": "m", "c": "x"}).crossJoin(spark.range(5).select(F.lit(1).alias("n"))).drop("n")
    http_import.HttpImport(config.ImportSink(f"{base}/{{{{ labels.c }}}}", batch_events=2, batch_seconds=60)).write(many.coalesce(1))
    assert [(p, e, t.count("\n")) for p, e, t in got] == [("/x", "gzip", 2), ("/x", "gzip", 2), ("/x", "gzip", 1)]
    assert http_import.healthy(None) and http_import.healthy(f"{base}/ok") and not http_import.healthy(f"{base}/no")
    with pytest.raises(ValueError):
        http_import.post("nowhere", ["{}"])
    server.shutdown()
