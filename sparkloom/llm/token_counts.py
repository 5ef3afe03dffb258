"""Operator 3: token counts by source, language and tokenizer version, kept up to date by signed deltas.

A batch of changes is reduced to signed rows: an insert adds a document's counts, a delete takes away what the
document contributes now, a revision does both. The rows are appended to a log, their sums by (source, lang, version)
to the rollup, each under the batch's name; then the batch is entered in the list of commits. Totals are the sums over
committed batches, so they are additive and never recounted. Committing a batch again is a no-op once it is in the
list; before that (a driver lost halfway) it overwrites its own parts and nothing else.

Texts are counted once for each tokenizer version, in Arrow batches; the sums shuffle one row for each task and group.
Deletes and revisions join the log by doc_id, without reading texts, by sort-merge at every size. Where only some ids
of a table of documents are revised, the texts stay where they are: a bitmap of the ids' hashes (SLOTS bits, a fixed
size) goes to the tasks, which count the documents it admits, and the counts are then semi-joined with the ids.

Null text counts no tokens but is a document; null source or lang is a group of its own. Inserting a doc_id again
adds another document with that id, and deleting it takes away all of them. Deleting what isn't there does nothing.
A null doc_id can be inserted but is never deleted or revised. Texts of any length are counted whole. Empty tables
give empty batches and totals. Columns other than doc_id, source, lang and text are ignored, whatever their names.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.common import scratch, slices_by_bytes, written

SLICE_BYTES = 1 << 20
#: Bits of the filter on ids: 2 MB.
SLOTS = 1 << 24
#: Version name and vocabulary file of each tokenizer that op3 counts with.
VERSIONS = {"byte-bpe-50k": "byte_bpe_50k.tiktoken", "byte-bpe-multi-50k": "byte_bpe_multi_50k.tiktoken"}
KEYS = ("source", "lang", "version")
LOG = "doc_id long, source string, lang string, version string, docs long, tokens long"

_ENCODINGS: dict[str, object] = {}


def encoding(path: str, pattern: str) -> object:
    """A byte-pair encoding from a file of ranks; made once for each worker."""
    if path not in _ENCODINGS:
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        _ENCODINGS[path] = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path]


def file_counter(path: str, pattern: str) -> Callable[[list[str]], list[int]]:
    return lambda texts: [len(ids) for ids in encoding(path, pattern).encode_ordinary_batch(texts, num_threads=1)]


def default_counters() -> dict[str, Callable[[list[str]], list[int]]]:
    import public_tokenizers as files

    return {name: file_counter(files.path(file), files.PATTERN) for name, file in VERSIONS.items()}


def _slots_of(ids: DataFrame, slot: Column) -> np.ndarray:
    """A bit for each slot that any of the ids falls into: SLOTS / 8 bytes, however many ids there are."""
    slots = ids.select((slot.cast("long") + 1).alias("slot"))  # Spark's bitmaps count from 1
    parts = slots.groupBy(F.bitmap_bucket_number("slot").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    bits = np.zeros(SLOTS // 8, np.uint8)
    for part, some in parts.toLocalIterator():
        bits[(part - 1) * 4096 : part * 4096] = np.frombuffer(some, np.uint8)
    return bits


class TokenRollup:
    """A rollup at a path of a shared store. counters: for each tokenizer version a function from texts to their token counts."""

    def __init__(self, spark: SparkSession, path: str, counters: dict[str, Callable[[list[str]], list[int]]] | None = None):
        self.spark, self.path = spark, path
        self.counters = default_counters() if counters is None else counters

    def _exists(self, part: str) -> bool:
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{part}")
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(target)

    def _read(self, part: str, schema: str) -> DataFrame:
        """The rows of a part that belong to committed batches."""
        if not self._exists(part) or not self._exists("commits"):
            return self.spark.createDataFrame([], f"{schema}, batch string")
        rows = self.spark.read.schema(f"{schema}, batch string").parquet(f"{self.path}/{part}")
        done = self.spark.read.schema("at timestamp, batch string").parquet(f"{self.path}/commits").select("batch").distinct()
        return rows.join(F.broadcast(done), "batch", "left_semi")  # one row for each batch, whatever the batches hold

    def committed(self, batch: str) -> bool:
        return self._exists(f"commits/batch={batch}/_SUCCESS")

    def count(self, docs: DataFrame, only: DataFrame | None = None) -> DataFrame:
        """One row (see LOG) for each document and version; with only (doc_ids), of those documents. No text is shuffled."""
        counters = self.counters
        slot = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(SLOTS)).cast("int")
        bits = None if only is None else self.spark.sparkContext.broadcast(_slots_of(only, slot))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if bits is not None:
                    at = batch.column(4).to_numpy()
                    batch = batch.filter(pa.array(bits.value[at >> 3] >> (at & 7) & 1 > 0))
                for part in slices_by_bytes(batch, 3, SLICE_BYTES):
                    texts = [t or "" for t in part.column(3).to_pylist()]
                    n = len(texts)
                    for version, counter in counters.items():
                        yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array([version] * n), pa.array([1] * n, pa.int64()), pa.array(counter(texts), pa.int64())], ["doc_id", *KEYS, "docs", "tokens"])

        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", "text", *([] if only is None else [slot.alias("slot")])).mapInArrow(run, LOG)
        return rows if only is None else rows.join(only.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi")

    def commit(self, batch: str, insert: DataFrame | None = None, delete: DataFrame | None = None, revise: DataFrame | None = None, revise_ids: DataFrame | None = None) -> bool:
        """insert and revise: documents; delete: doc_ids; revise_ids: of revise only these doc_ids count. False if the batch was committed before."""
        if self.committed(batch):
            return False
        rows = self.spark.createDataFrame([], LOG)
        if insert is not None:
            rows = rows.unionByName(self.count(insert))
        if revise is not None:
            rows = rows.unionByName(self.count(revise, revise_ids))
        changed = revise.select("doc_id") if revise is not None else None
        if changed is not None and revise_ids is not None:
            changed = changed.join(revise_ids.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi")
        ids = [x.select(F.col("doc_id").cast("long").alias("doc_id")) for x in (delete, changed) if x is not None]
        if ids:
            gone = (ids[0] if len(ids) == 1 else ids[0].unionByName(ids[1])).distinct()
            held = self._read("log", LOG).join(gone.hint("merge"), "doc_id", "left_semi").groupBy("doc_id", *KEYS).agg((-F.sum("docs")).alias("docs"), (-F.sum("tokens")).alias("tokens"))
            rows = rows.unionByName(held.where("docs <> 0 OR tokens <> 0"))
        rows.write.mode("overwrite").parquet(f"{self.path}/log/batch={batch}")
        log = self.spark.read.schema(LOG).parquet(f"{self.path}/log/batch={batch}")
        log.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).write.mode("overwrite").parquet(f"{self.path}/rollup/batch={batch}")
        self.spark.range(1).select(F.current_timestamp().alias("at")).write.mode("overwrite").parquet(f"{self.path}/commits/batch={batch}")
        return True

    def totals(self) -> DataFrame:
        """source, lang, version, n_docs, n_tokens; groups that have come down to nothing are left out."""
        rows = self._read("rollup", "source string, lang string, version string, docs long, tokens long")
        return rows.groupBy(*KEYS).agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens")).where("n_docs <> 0 OR n_tokens <> 0")


def op3(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All documents are inserted, then those labelled toxic are deleted and those of low quality counted anew; each batch is sent twice."""
    rollup = TokenRollup(spark, scratch(spark, "token-rollup"))
    toxic = labels.where("toxic = 1").select("doc_id").distinct()
    poor = labels.where("quality = 0").select("doc_id").distinct().join(toxic.hint("merge"), "doc_id", "left_anti")
    for _ in range(2):
        rollup.commit("load", insert=docs)
    for _ in range(2):
        rollup.commit("review", delete=toxic, revise=docs, revise_ids=poor)
    return written(rollup.totals(), "token-totals")
