import hashlib
import os
import time

import pytest

from sparkloom import config
from sparkloom.sinks import objects
from sparkloom.streaming.retry import Shutdown, keep_connected, next_delay


def write(path, n):
    path.write_bytes(bytes(n))
    return str(path)


def test_etag(tmp_path):
    size = objects.PART_BYTES
    md5 = lambda n: hashlib.md5(bytes(n))
    assert objects.etag(write(tmp_path / "a", 0)) == '"d41d8cd98f00b204e9800998ecf8427e"'
    assert objects.etag(write(tmp_path / "b", size - 1)) == f'"{md5(size - 1).hexdigest()}"'
    assert objects.etag(write(tmp_path / "c", size)) == f'"{hashlib.md5(md5(size).digest()).hexdigest()}-1"'
    assert objects.etag(write(tmp_path / "d", size + 1)) == f'"{hashlib.md5(md5(size).digest() + md5(1).digest()).hexdigest()}-2"'
    assert objects.file_md5(str(tmp_path / "a")) == "1B2M2Y8AsgTpgAmY7PhCfg=="
    with pytest.raises(objects.TooLarge):
        objects.etag(str(tmp_path / "d"), 10, 2)


@pytest.mark.parametrize("kind", [objects.MultipartStore, objects.ResumableStore])
def test_stores_skip_what_is_there(tmp_path, kind):
    client = objects.FolderClient(str(tmp_path))
    store = kind(client, part_bytes=4)
    for n in (0, 3, 4, 9):
        path = write(tmp_path / f"f{n}", n)
        assert store.upload(path, "b", f"k{n}") == n
        assert store.upload(path, "b", f"k{n}") == 0
        assert (tmp_path / "b" / f"k{n}").read_bytes() == bytes(n)


def test_failures_end_the_session(tmp_path):
    client = objects.FolderClient(str(tmp_path))
    client.part = client.send = lambda *a: (_ for _ in ()).throw(OSError("no"))
    path = write(tmp_path / "f", 9)
    for kind, call in ((objects.MultipartStore, "abort"), (objects.ResumableStore, "cancel")):
        with pytest.raises(OSError):
            kind(client, part_bytes=4).put(path, "b", "k")
        assert client.calls[-1] == (call,)
    assert objects.range_end("bytes=0-8388607") == 8388607


def test_checkpoint_file(tmp_path):
    c = lambda f: {"upload_key": {"filename": f, "bucket": "b", "object_key": "k"}, "upload_at": "2022-08-25T03:06:27Z", "expire_at": "2022-08-25T03:36:27Z"}
    folder = str(tmp_path)
    assert objects.write_checkpoints(folder, [c("/d/b"), c("/d/a")]) and not objects.write_checkpoints(folder, [c("/d/a"), c("/d/b")])
    assert [x["upload_key"]["filename"] for x in objects.read_checkpoints(folder)] == ["/d/a", "/d/b"]
    os.rename(tmp_path / "checkpoints.json", tmp_path / "checkpoints.new.json")
    assert len(objects.read_checkpoints(folder)) == 2 and (tmp_path / "checkpoints.json").exists()


def test_upload_stream(spark, tmp_path):
    from sparkloom.streaming.upload import uploads

    source, store = tmp_path / "in", tmp_path / "store"
    source.mkdir(), store.mkdir()
    path = write(tmp_path / "file", 5)
    root = str(store)
    lines = lambda *rows: spark.createDataFrame(rows, "message string, key string").coalesce(1).write.mode("append").json(str(source))
    lines((path, "k"), (path, "k"), (path, None), (str(tmp_path / "none"), "k"))
    out = uploads(spark.readStream.schema("message string, key string").json(str(source)), "b", lambda: objects.MultipartStore(objects.FolderClient(root)), delay=1)
    query = out.writeStream.format("memory").queryName("outcomes").option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").start()
    try:
        end = time.time() + 60
        while time.time() < end and spark.table("outcomes").where("bytes = 5").isEmpty():
            time.sleep(0.5)
        lines((path, "k"))
        while time.time() < end and spark.table("outcomes").count() < 5:
            time.sleep(0.5)
        got = sorted((r.filename == path, r.object_key or "", r.status, r.bytes) for r in spark.table("outcomes").collect())
        assert got == [(False, "k", "rejected", 0), (True, "", "rejected", 0), (True, "k", "delivered", 0), (True, "k", "delivered", 0), (True, "k", "delivered", 5)]
        assert (store / "b" / "k").read_bytes() == bytes(5)
    finally:
        query.stop()


def test_settings(tmp_path):
    made = config.S3Upload.of({"bucket": "b", "delay_upload": 3})
    assert (made.delay_upload_secs, made.expire_after_secs) == (3, 1800)
    for cls, bad in ((config.S3Upload, {"bucket": "b", "x": 1}), (config.GcsUpload, {}), (config.FileNames, {"include": (), "y": 1})):
        with pytest.raises(config.ConfigError):
            cls.of(bad)
    with pytest.raises(config.ConfigError):
        config.Tls(ca_file=str(tmp_path / "a"))
    with pytest.raises(config.ConfigError):
        config.Tls(str(tmp_path / "a"), str(tmp_path / "b"), str(tmp_path / "c"))
    assert config.GcsUpload("b", metadata={"k": "v"}).headers()["x-goog-meta-k"] == "v"
    with pytest.raises(config.ConfigError):
        config.GcsUpload("b", metadata={"k": "a\nb"}).headers()


def test_retry_and_shutdown():
    delay, seen = 1.0, []
    for _ in range(7):
        delay = next_delay(delay)
        seen.append(delay)
    assert seen == [2, 4, 8, 16, 32, 60, 60]
    stop, slept, results = Shutdown(), [], iter([False, False, True, False])
    keep_connected(lambda: next(results, None) if slept.__len__() < 3 else stop.shutdown() or True, stop.event, sleep=slept.append)
    assert slept == [2, 4, 2]
    parent = Shutdown()
    child = parent.child()
    with child:
        parent.shutdown()
        assert child.event.is_set() and not parent.wait(0.01)
    assert parent.wait(1) and parent.child().event.is_set()


def test_watcher():
    from sparkloom.streaming.watch import Watcher

    polls = iter([{"a", "pd"}, OSError("away"), {"b", "pd"}])
    events = []

    def fetch():
        found = next(polls)
        if isinstance(found, OSError):
            raise found
        return found

    watcher = Watcher(fetch, lambda c: events.append(("start", c)) or c != "pd", lambda c: events.append(("stop", c)))
    assert watcher.poll() and watcher.current == {"a"}
    assert not watcher.poll() and watcher.current == {"a"}
    assert watcher.poll() and watcher.current == {"b"} and ("stop", "a") in events
    assert events.count(("start", "pd")) == 2
