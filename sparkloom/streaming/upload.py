"""Stateful uploads: requests wait, are joined with those that wait already, and are checked against checkpoints that expire.

State is kept by (filename, bucket, object_key), with timers in processing time, so a restart loses no request. The upload
runs in the timer, and the checkpoint is set only if it ends well: after a failure between the two it runs again, and the
content hash makes that cheap.
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sparkloom.operators.uploads import DELAY_SECONDS, EXPIRE_SECONDS, KEY

OUT = "filename string, bucket string, object_key string, status string, bytes long, at timestamp"
DELIVERED, REJECTED = "delivered", "rejected"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class UploadProcessor(StatefulProcessor):
    """make_store makes the object store, on the executor that runs the uploads."""

    def __init__(self, make_store: Callable[[], object], delay: int = DELAY_SECONDS, expire: int = EXPIRE_SECONDS):
        self.make_store, self.delay, self.expire = make_store, delay, expire

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "pending boolean, upload_at double, expire_at double")
        self.store = self.make_store()

    def _out(self, key: tuple, status: str, n: int, at: float) -> pd.DataFrame:
        return pd.DataFrame([(*key, status, n, pd.Timestamp(int(at * 1000), unit="ms"))], columns=[*KEY, "status", "bytes", "at"])

    def _now(self) -> tuple[bool, float, float]:
        return self.state.get() if self.state.exists() else (False, 0.0, 0.0)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        n = sum(len(r) for r in rows)
        now = timerValues.getCurrentProcessingTimeInMs() / 1000
        filename, _, object_key = key
        if filename is None or object_key is None:
            for _ in range(n):
                yield self._out(key, REJECTED, 0, now)
            return
        try:
            changed = os.stat(filename).st_mtime
        except OSError:
            for _ in range(n):
                yield self._out(key, REJECTED, 0, now)
            return
        pending, upload_at, expire_at = self._now()
        if pending or upload_at >= changed:
            for _ in range(n):
                yield self._out(key, DELIVERED, 0, now)
            return
        self.state.update((True, upload_at, expire_at))
        self.handle.registerTimer(int((now + self.delay) * 1000))
        for _ in range(n - 1):  # those beside the first are answered while it waits
            yield self._out(key, DELIVERED, 0, now)

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs() / 1000
        pending, upload_at, expire_at = self._now()
        if not pending:
            if expire_at <= now:
                self.state.clear()
            return
        started = time.time()  # before the upload: a file that changes meanwhile is uploaded again
        try:
            n = self.store.upload(*key)
        except Exception:  # noqa: BLE001  whatever goes wrong rejects this file and no other
            self.state.update((False, upload_at, expire_at)) if upload_at else self.state.clear()
            yield self._out(key, REJECTED, 0, now)
            return
        self.state.update((False, started, started + self.expire))
        self.handle.registerTimer(int((started + self.expire) * 1000) + 1)
        yield self._out(key, DELIVERED, n, now)

    def close(self) -> None:
        pass


def uploads(events: DataFrame, bucket: str, make_store: Callable[[], object], delay: int = DELAY_SECONDS, expire: int = EXPIRE_SECONDS) -> DataFrame:
    """A stream of events (message, key) to a stream of outcomes. Needs spark.sql.streaming.stateStore.providerClass = STATE_STORE."""
    text = lambda c: F.make_valid_utf8(F.col(c).cast("string"))
    requests = events.select(text("message").alias("filename"), F.lit(bucket).alias("bucket"), text("key").alias("object_key"))
    return requests.groupBy(*KEY).transformWithStateInPandas(UploadProcessor(make_store, delay, expire), OUT, "Append", "processingTime")
