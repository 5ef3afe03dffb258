"""Operator 2: line deduplication by a suffix array over line-id sequences, built by distributed prefix doubling.

Each text is the sequence of its lines' ids (64-bit hashes of the lines between line feeds). A suffix's rank at length
h is its place in the suffix array as far as its first h lines tell. Ranks at 2h come from the pairs of ranks at h of
a position and of the position h lines on; suffixes whose prefix is unique already can be in no repeated run and drop
out, so each round sorts only what is still tied. Ranks are dealt by ranges: distinct pairs are range-partitioned and
numbered within each part, and only the parts' sizes (one number each) come to the driver. Suffixes of equal rank at
MIN_LINES are the intervals of the suffix array whose longest common prefix has that length at least. In each, the
first suffix (by doc_id, then position) is the original; the lines of all others' prefixes are deleted. Overlapping
and adjacent intervals of a text join to maximal runs. Doubling on beyond MIN_LINES would delete nothing else.

Null and empty texts have no lines. Rows that repeat doc_id and text are one document. A null doc_id is the least.
An original that overlaps a later copy of itself (one line many times) is cut down to what no later copy covers.
An empty table gives an empty result. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.common import join_groups, written

MIN_LINES = 3
NO_ID = -(1 << 63)


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, "\n"))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("th"), lines.alias("lines"))


def _ranked(pairs: DataFrame) -> DataFrame:
    """pairs (id, th, at, x, y): those whose (x, y) is not unique, as (id, th, at, rank), rank in the order of (x, y)."""
    spark = pairs.sparkSession
    pairs = written(pairs, "pairs")
    tied = pairs.groupBy("x", "y").agg(F.count(F.lit(1)).alias("size")).where("size > 1")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            sizes = batch.column(2).to_numpy()
            ends = at + sizes.cumsum()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * batch.num_rows, pa.int32()), pa.array(ends - sizes, pa.int64())], ["x", "y", "size", "part", "at"])
            at = int(ends[-1]) if batch.num_rows else at

    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    numbered = written(tied.repartitionByRange(n, "x", "y").sortWithinPartitions("x", "y").mapInArrow(number, "x long, y long, size long, part int, at long"), "numbered")
    total, before = 0, []
    for r in numbered.groupBy("part").agg(F.sum("size").alias("n")).orderBy("part").collect():
        before.append((r.part, total))
        total += r.n
    starts = F.broadcast(spark.createDataFrame(before, "part int, before long"))
    groups = numbered.join(starts, "part").select(F.struct("x", "y").alias("xy"), "size", (F.col("before") + F.col("at")).alias("rank"))
    rows = join_groups(pairs.select("id", "th", "at", F.struct("x", "y").alias("xy")), groups, "xy", "size", total)
    return written(rows.select("id", "th", "at", "rank"), "ranks")


def _paired(ranks: DataFrame, ahead: int) -> DataFrame:
    """Each suffix with the rank of the one that starts ahead lines on; those without one drop out."""
    later = ranks.select("id", "th", (F.col("at") - ahead).alias("at"), F.col("rank").alias("y"))
    return ranks.withColumnRenamed("rank", "x").join(later.hint("merge"), ["id", "th", "at"])


def repeated_starts(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """(id, th, at, rank): starts of runs of min_lines lines that occur more than once; equal rank means equal run."""
    lines = _keyed(docs).dropDuplicates(["id", "th"]).select("id", "th", F.posexplode("lines").alias("at", "line"))
    ranks = _ranked(lines.select("id", "th", "at", F.xxhash64("line").alias("x"), F.lit(0).cast("long").alias("y")))
    length = 1
    while length < min_lines:
        step = min(length, min_lines - length)
        ranks = _ranked(_paired(ranks, step))
        length += step
    return ranks


def strip_repeated_lines(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """id, lines, kept (the lines that stay, in order) of each row of docs."""
    starts = repeated_starts(docs, min_lines)
    place = F.struct("id", "th", "at")
    groups = starts.groupBy("rank").agg(F.min(place).alias("original"), F.count(F.lit(1)).alias("size"))
    later = join_groups(starts, written(groups, "intervals"), "rank", "size", starts.count()).where(place != F.col("original"))
    gone = later.groupBy("id", "th").agg(F.collect_list("at").alias("starts"))
    gone = gone.select("id", "th", F.array_distinct(F.flatten(F.transform("starts", lambda s: F.sequence(s, s + min_lines - 1)))).alias("gone"))
    rows = _keyed(docs).join(written(gone, "gone").hint("merge"), ["id", "th"], "left")
    every = F.when(F.size("lines") > 0, F.sequence(F.lit(0), F.size("lines") - 1)).otherwise(F.array().cast("array<int>"))
    kept = F.transform(F.array_except(every, F.coalesce("gone", F.array().cast("array<int>"))), lambda i: F.get("lines", i))
    return rows.select("id", "lines", F.when(F.col("gone").isNull(), F.col("lines")).otherwise(kept).alias("kept"))


def op2(spark: SparkSession, docs: DataFrame) -> DataFrame:
    rows = strip_repeated_lines(docs)
    n, left = F.size("lines").cast("long"), F.size("kept").cast("long")
    return rows.select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), n.alias("n_lines"), (n - left).alias("n_removed"), F.sha2(F.array_join("kept", "\n").cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH doc AS (
  SELECT doc_id, CASE WHEN coalesce(text, '') = '' THEN [] ELSE string_split(text, chr(10)) END AS l FROM documents
), line AS (
  SELECT doc_id, unnest(l) AS t, unnest(range(1, len(l) + 1)) AS p FROM doc
), run AS (
  SELECT doc_id, p, md5(t) || md5(lead(t, 1) OVER w) || md5(lead(t, 2) OVER w) AS g FROM line WINDOW w AS (PARTITION BY doc_id ORDER BY p)
), later AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY g ORDER BY doc_id, p) AS k FROM run WHERE g IS NOT NULL) WHERE k > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 3)) AS p FROM later
), kept AS (
  SELECT doc_id, string_agg(t, chr(10) ORDER BY p) AS k FROM line ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
), removed AS (
  SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.l) AS BIGINT) AS n_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM doc d LEFT JOIN kept ON kept.doc_id = d.doc_id LEFT JOIN removed ON removed.doc_id = d.doc_id
"""
