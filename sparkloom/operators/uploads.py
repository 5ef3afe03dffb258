"""Which files to upload: requests against checkpoints, in batch form. sparkloom.streaming has the stateful form."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ["filename", "bucket", "object_key"]
DELAY_SECONDS, EXPIRE_SECONDS = 10, 1800


def upload_requests(events: DataFrame, bucket: str) -> DataFrame:
    """Events (message, key) as upload keys; events that lack either are rejected and left out."""
    return events.where("message IS NOT NULL AND key IS NOT NULL").select(F.make_valid_utf8(F.col("message").cast("string")).alias("filename"), F.lit(bucket).alias("bucket"), F.make_valid_utf8(F.col("key").cast("string")).alias("object_key"))


def not_uploaded(requests: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Requests (KEY, mtime) without a checkpoint (KEY, upload_at) from the file's last change or later."""
    same = [requests[k].eqNullSafe(checkpoints[k]) for k in KEY]
    condition = same[0] & same[1] & same[2] & (checkpoints["upload_at"] >= requests["mtime"])
    return requests.join(checkpoints, condition, "left_anti")


def live_checkpoints(checkpoints: DataFrame, now: Column) -> DataFrame:
    """Those that have not expired; one that expires now is kept."""
    return checkpoints.where(F.col("expire_at") >= now)


def content_differs(local: DataFrame, remote: DataFrame) -> DataFrame:
    """local (KEY, hash) that remote (KEY, hash) lacks or has with another hash."""
    return local.join(remote, [local[k].eqNullSafe(remote[k]) for k in KEY] + [local["hash"] == remote["hash"]], "left_anti")


def accepted_requests(requests: DataFrame, key: list[str], at: str, delay: int) -> DataFrame:
    """Requests that start an upload: the first of a key, and after each the first that comes delay or more later; the rest wait with it.

    Times are numbers. A key's requests are streamed in order and only the last start is held, however many there are.
    """
    rows = requests.select(*key, at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, last = None, None
        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(len(key))), strict=True))
            starts = []
            for k, t in zip(keys, batch.column(len(key)).to_pylist(), strict=True):
                new = k != current or t >= last + delay
                starts.append(new)
                if new:
                    current, last = k, t
            yield batch.filter(pa.array(starts, pa.bool_()))

    return rows.where(F.col(at).isNotNull()).repartition(*key).sortWithinPartitions(*key, at).mapInArrow(run, rows.schema)
