"""Shared folder, written tables and word handling used by the training-data operators."""

from __future__ import annotations

import atexit
import gc
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_ROWS, SLICE_BYTES = 256, 1 << 20
#: The temporary folder of sessions on this machine that name none.
_made: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is what the session names in spark.checkpoint.dir. Only where that is unset and the master is this machine
    (tests) a temporary folder is made, one for each process; on a cluster there is no folder that could be guessed.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or _made.get("folder")
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="sparkloom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _made["folder"] = folder  # the session's setting can't be changed while it runs
    return folder.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used before."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Removes a path of the shared folder, on whichever file system it lies."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch, few rows and few bytes of the string column each, so that the Python objects made from one part stay small."""
    for part in slices_by_bytes(batch, column, SLICE_BYTES):
        for at in range(0, part.num_rows, SLICE_ROWS):
            yield part.slice(at, SLICE_ROWS)


def slices_by_bytes(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about most bytes in a string column, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).cumsum()
    at = 0
    while at < batch.num_rows:
        done = int(sizes[at - 1]) if at else 0
        to = max(at + 1, int(sizes.searchsorted(done + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def numbered(docs: DataFrame) -> DataFrame:
    """docs with its columns named c0, c1, ...: names of a table's own can then clash with no helper column and need no quotes."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])


def place_of(docs: DataFrame, name: str) -> str:
    """The name that numbered() gives a column."""
    return f"c{docs.columns.index(name)}"


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files and broadcasts of plans that nothing refers to any more, now and not at some later collection."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def make_path(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(target)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A group with more than 1/HOT_SHARE of all rows (and HOT_LEAST at least) is hot; there are HOT_SHARE such groups at most.
HOT_SHARE = 4096
HOT_LEAST = 4096


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Inner join of rows with one row for each group, without bringing a hot group's rows together.

    groups has key and size (the number of rows of the group). The hot groups are few by their definition, so they
    are broadcast; all others are joined by a shuffle in which no key has more than total / HOT_SHARE rows.
    """
    least = max(HOT_LEAST, total // HOT_SHARE)
    hot = groups.where(F.col(size) > least)
    cold = groups.where(F.col(size) <= least)
    some = rows.join(F.broadcast(hot), key)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold.hint("merge"), key)
    return some.unionByName(rest)
