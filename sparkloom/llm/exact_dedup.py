"""Operator 7: exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by the SHA-256 of the text. A batch of documents is reduced to one row
for each digest (partial aggregation, so a text that a third of all rows share costs one row a task), the digests
that the index has are removed by a sort-merge anti-join whose index side needs no shuffle, and the rest is
appended under the batch's name. Committing a batch again replaces its own partition and changes nothing else.

Null text counts as empty; empty texts are equal to each other. Of equal texts in a batch the row with the largest
doc_id stays (a null doc_id is smallest); of repeated rows with one doc_id exactly one stays, and a text that an
earlier batch has brought drops all rows of this one. An empty table gives an empty result. keep_one() keeps all other
columns, whatever their names. Texts are hashed whole, at any length. Batches are committed one after another: two that
are committed at the same time don't see each other's digests.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.common import join_groups, make_path, numbered, place_of, scratch, written


def digest(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


class DigestIndex:
    """Digests seen so far, at a path of a shared store. buckets is fixed when the index is made."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 32):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = "digest_index_" + re.sub(r"\W", "_", path)[-40:] + "_" + uuid.uuid5(uuid.NAMESPACE_URL, path).hex[:12]
        make_path(spark, path)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest STRING, keep_id BIGINT, keep_row BIGINT, n BIGINT, batch STRING) "
            f"USING parquet PARTITIONED BY (batch) CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")

    def entries(self) -> DataFrame:
        return self.spark.table(self.name)

    def commit(self, digests: DataFrame, batch: str) -> None:
        """Appends what digests (digest, doc_id, row_no) bring that no other batch has brought."""
        groups = digests.groupBy("digest").agg(F.max(F.struct("doc_id", "row_no")).alias("keep"), F.count(F.lit(1)).alias("n"))
        known = self.entries().where(F.col("batch") != batch).select("digest")
        fresh = groups.join(known.hint("merge"), "digest", "left_anti")
        rows = fresh.select("digest", F.col("keep.doc_id").alias("keep_id"), F.col("keep.row_no").alias("keep_row"), "n", F.lit(batch).alias("batch"))
        rows = written(rows, "fresh-digests")  # the table that is written may not be read by the same plan
        # The named partition is overwritten, and no setting of the session decides it.
        rows.drop("batch").repartition(self.buckets, "digest").createOrReplaceTempView(f"fresh_{self.name}")
        name = batch.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.name} PARTITION (batch = '{name}') SELECT * FROM fresh_{self.name}")
        self.spark.catalog.dropTempView(f"fresh_{self.name}")
        self.spark.catalog.refreshTable(self.name)


def deduplicate(docs: DataFrame, index: DigestIndex | None = None, batch: str = "batch-0", carry: tuple[str, ...] = ()) -> DataFrame:
    """docs' doc_id and the columns named in carry, with keep_id, group_size (rows of this batch with the text), kept, text_sha256."""
    spark = docs.sparkSession
    index = index or DigestIndex(spark, scratch(spark, "digest-index"))
    seen = written(docs.select("doc_id", *carry, digest(F.col("text")).alias("digest"), F.monotonically_increasing_id().alias("row_no")), "digests")
    index.commit(seen.select("digest", "doc_id", "row_no"), batch)
    held = index.entries().select("digest", "keep_id", "keep_row", F.col("batch").alias("of"))
    sizes = seen.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
    groups = written(sizes.join(held.hint("merge"), "digest"), "digest-groups")
    both = join_groups(seen, groups, "digest", "group_size", seen.count())
    kept = (F.col("of") == batch) & (F.col("row_no") == F.col("keep_row"))
    return both.select("doc_id", *carry, "keep_id", "group_size", kept.alias("kept"), F.col("digest").alias("text_sha256"), "row_no")


def op7(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return deduplicate(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns, whatever their names. Only ids and digests are shuffled to decide; rows that go are anti-joined."""
    place = lambda i, d: F.struct(F.col(i).isNull().alias("none"), F.coalesce(F.col(i), F.lit(0)).alias("id"), d.alias("digest"))
    found = deduplicate(docs.select("doc_id", "text")).select(place("doc_id", F.col("text_sha256")).alias("place"), "kept")
    places = written(found.groupBy("place").agg(F.count(F.lit(1)).alias("rows"), F.max("kept").alias("kept")), "places")
    # A place is a doc_id with a text; where it comes more than once, one row of it stays.
    rows = numbered(docs)
    once = rows.withColumn("place", place(place_of(docs, "doc_id"), digest(F.col(place_of(docs, "text")))))
    single = once.join(places.where("NOT kept OR rows > 1").select("place").hint("merge"), "place", "left_anti")
    several = once.join(places.where("kept AND rows > 1").select("place").hint("merge"), "place", "left_semi").dropDuplicates(["place"])
    return single.unionByName(several).select(*rows.columns).toDF(*docs.columns)


ORACLE = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
