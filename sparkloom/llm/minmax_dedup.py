"""Operator 1: near-duplicate detection by min-max hashing.

A document's set is its distinct 5-word shingles (64-bit hashes of lower-cased words; with fewer words the whole
sequence is one shingle). Each hash function is evaluated once and both its minimum and its maximum over the set are
kept, so the signature has twice as many values as evaluations; the two agree between sets with the probability of the
Jaccard similarity, each without bias. Bands of ROWS values each find candidates, as many as the threshold needs
(BANDS): at a similarity of 0.85 (op1) a pair is missed with a probability of (1 - 0.85^4)^20, at 0.80 (the pipeline)
of (1 - 0.8^4)^30, both under one in a million.

Documents with equal sets are one class, found by aggregation: copies cost one row. Between classes, links are
confirmed on the full sets, and pairs that can't join two components are not made:

1. each bucket tests its members against its least id, and components are updated;
2. in buckets that still hold several components, the shingles that one document alone has are counted. The document
   with the fewest is the most central one, and the others are tested against it. A pair x, y of the bucket has at
   most min(|x & p|, |y & p|) + min(x', y') shingles in common, p being the central document and x' what x shares
   with anyone but p: in a large group of copies, each edited in its own way, this rules out many pairs, and members
   that can reach no other are done with;
3. what is left is tested against the most central documents of 16, 256, ... parts of the bucket, until the buckets'
   untested members lie in one component each. By then p may be an edited copy itself, so that all others share what p
   lost. Each document's shared shingles are therefore counted by SLICES ranges of their hashes: a pair has at most the
   sum over all slices of the lesser count in common, so documents that lost different shingles of what the
   group has in common are told apart without their texts.

Nothing is left out but by these exact bounds, and the rounds end by themselves. A pivot with many members is sent to
several tasks, its members dealt among them.

Null, empty and wordless texts have an empty set (n_shingles 0) and are linked with nothing. Rows that repeat a
doc_id are one document that has the links of all of them. A null doc_id counts as the least id. An empty table gives
an empty result. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.common import join_groups, numbered, place_of, release, slices, written
from sparkloom.llm.components import components

SHINGLE, THRESHOLD = 5, 85
#: Number of bands by threshold in percent.
BANDS = {85: 20, 80: 30}
ROWS = 4
PERMUTATIONS = max(BANDS.values()) * ROWS // 2
SALT_STEP = 16
PIVOT_LOAD = 2000
#: Number of parts of the shingles' hashes by which shared shingles are counted.
SLICES = 256
NO_ID = -(1 << 63)
BLOCK = 1 << 14

_random = np.random.Generator(np.random.PCG64(20240229))
A = _random.integers(1, 1 << 63, PERMUTATIONS, np.uint64) << np.uint64(1) | np.uint64(1)
B = _random.integers(1, 1 << 63, PERMUTATIONS, np.uint64)
MIX = _random.integers(1, 1 << 63, ROWS + 1, np.uint64) << np.uint64(1) | np.uint64(1)
STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingles(text: bytes | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles. bytes.lower() and bytes.split() know ASCII only, as the words' definition does."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(width, len(h))
    out = np.full(len(h) - width + 1, np.uint64(width))
    for j in range(width):
        out = out * STEP + h[j : len(h) - width + 1 + j]
    return np.unique(_mixed(out))


def min_max(found: np.ndarray, functions: int = PERMUTATIONS) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest value of the set under each of the first hash functions; blocks bound the memory for long texts."""
    low, high = np.full(functions, np.uint64(2**64 - 1)), np.zeros(functions, np.uint64)
    for at in range(0, len(found), BLOCK):
        values = np.multiply.outer(A[:functions], found[at : at + BLOCK])
        values += B[:functions, None]
        np.minimum(low, values.min(1), out=low)
        np.maximum(high, values.max(1), out=high)
    return low, high


def bands(found: np.ndarray, count: int) -> np.ndarray:
    """One key for each of count bands: minimum and maximum of ROWS / 2 hash functions, and the band's number."""
    signature = np.stack(min_max(found, count * ROWS // 2), 1).reshape(count, ROWS)
    return _mixed((signature * MIX[:ROWS]).sum(1, dtype=np.uint64) + np.arange(count, dtype=np.uint64) * MIX[ROWS]).view(np.int64)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.col("text").cast("binary").alias("text"))


def sketch(docs: DataFrame, count: int) -> DataFrame:
    """id, n, set_a and set_b (128 bits that stand for the set), bands (count keys, none for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                n, a, b, keys, ends = [], [], [], [], [0]
                for text in part.column(1).to_pylist():
                    found = shingles(text)
                    n.append(len(found))
                    a.append(found.sum(dtype=np.uint64))
                    b.append(np.bitwise_xor.reduce(_mixed(found * MIX[0])) if len(found) else np.uint64(0))
                    if len(found):
                        keys.append(bands(found, count))
                    ends.append(len(keys) * count)
                flat = np.concatenate(keys) if keys else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(np.array(a, np.uint64).view(np.int64)), pa.array(np.array(b, np.uint64).view(np.int64)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                    ["id", "n", "set_a", "set_b", "bands"],
                )

    return _texts(docs).mapInArrow(run, "id long, n long, set_a long, set_b long, bands array<long>")


def confirm(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """(u, v, nu, nv, common) of each of the pairs (member, pivot): sizes of the full sets and of their intersection."""
    parts = pairs.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / PIVOT_LOAD).cast("int").alias("parts"))
    members = pairs.join(parts.hint("merge"), "pivot").select("pivot", F.pmod(F.xxhash64("member"), F.col("parts")).cast("int").alias("part"), F.col("member").alias("id"))
    pivots = parts.select("pivot", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("pivot").alias("id"))
    rows = members.unionByName(pivots).join(texts.hint("merge"), "id").select("pivot", "part", "id", "text")
    n = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, base = None, []
        for batch in batches:
            for part in slices(batch, 3):
                out = []
                for pivot, salt, own, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    found = shingles(text)
                    if group != (pivot, salt):
                        group, base = (pivot, salt), []
                    if own == pivot:  # first in its group
                        base.append(found)
                    else:
                        out += [(own, pivot, len(found), len(b), len(np.intersect1d(found, b, assume_unique=True))) for b in base]
                cols = list(zip(*out, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["u", "v", "nu", "nv", "common"])

    dealt = rows.repartition(n, "pivot", "part").sortWithinPartitions("pivot", "part", (F.col("id") != F.col("pivot")))
    return dealt.mapInArrow(run, "u long, v long, nu long, nv long, common long")


def private_counts(texts: DataFrame) -> DataFrame:
    """(id, own, slices): how many shingles of each document no other document of texts has, and how many others in each slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                sets = [shingles(t) for t in part.column(1).to_pylist()]
                ids = np.repeat(part.column(0).to_numpy(), [len(x) for x in sets])
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.concatenate(sets).view(np.int64))], ["id", "s"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                counts = [np.bincount(shingles(t) & np.uint64(SLICES - 1), minlength=SLICES) for t in part.column(1).to_pylist()]
                ends = pa.array(np.arange(part.num_rows + 1) * SLICES, pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(counts), pa.int32()))], ["id", "every"])

    rows = texts.select("id", "text").mapInArrow(run, "id long, s long")
    private = rows.groupBy("s").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n")).where("n = 1")
    by_slice = private.groupBy("id", F.pmod("s", F.lit(SLICES)).cast("int").alias("slice")).agg(F.count(F.lit(1)).cast("int").alias("n"))
    own = by_slice.groupBy("id").agg(F.sum("n").alias("own"), F.map_from_entries(F.collect_list(F.struct("slice", "n"))).alias("private"))
    found = texts.select("id", "text").mapInArrow(count, "id long, every array<int>").join(own.hint("merge"), "id", "left")
    others = F.transform("every", lambda n, i: n - F.coalesce(F.element_at("private", i), F.lit(0)))
    return found.select("id", F.coalesce("own", F.lit(0)).alias("own"), F.when(F.col("private").isNull(), F.col("every")).otherwise(others).alias("slices"))


def most_common(x: Column, y: Column) -> Column:
    """No two sets with these counts by slice have more elements in common."""
    return F.aggregate(F.zip_with(x, y, lambda a, b: F.least(a, b)), F.lit(0), lambda total, n: total + n)


def may_link(common: Column, sizes: Column, threshold: int) -> Column:
    """Whether so many common shingles reach the threshold for sets whose sizes add up to sizes."""
    return (100 + threshold) * common >= threshold * sizes


def _open(members: DataFrame, threshold: int) -> DataFrame:
    """Members of the buckets in which two components are left, without those that can reach no other member.

    shared + extra is the most that a member can have in common with anyone: what it shares with the pivot and what
    else of it is not its own. Each join is with one row for each bucket, so none makes more rows than members has; those
    able to reach another are written, as two plans read them.
    """
    spans = members.groupBy("bucket").agg(F.min("n").alias("least"))
    able = members.join(spans.hint("merge"), "bucket").where(may_link(F.col("shared") + F.col("extra"), F.col("n") + F.col("least"), threshold)).drop("least")
    able = written(able, "able")
    sides = able.groupBy("bucket").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select("bucket")
    return able.join(sides.hint("merge"), "bucket")


def near_components(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """id (NO_ID for null), n_shingles, component_id: one row for each row of docs. threshold: least similarity of a link, in percent."""
    spark = docs.sparkSession
    found = written(sketch(docs, BANDS[threshold]), "sketches")
    key = F.struct("n", "set_a", "set_b")
    classes = written(found.where("n > 0").groupBy("n", "set_a", "set_b").agg(F.min("id").alias("class"), F.count(F.lit(1)).alias("size"), F.first("bands").alias("bands")), "classes")
    placed = classes.select(F.explode("bands").alias("bucket"), F.col("class").alias("id"), "n").distinct()
    shared = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = written(placed.join(shared.hint("merge"), "bucket").select("bucket", "id", "n"), "buckets")
    # Classes that share an id (rows that repeat a doc_id) are one node; the bounds, which are a set's, aren't used then.
    single = classes.count() == classes.select("class").distinct().count()
    # Texts are joined once, by sort-merge at every size, for the documents that share a bucket with any other.
    texts = written(_texts(docs).join(members.select("id").distinct().hint("merge"), "id", "left_semi"), "texts")
    component = None

    def test(pairs: DataFrame) -> DataFrame:
        """Confirms pairs and updates the components."""
        nonlocal component
        tested = written(confirm(texts, pairs), "tested")
        links = tested.where(may_link(F.col("common"), F.col("nu") + F.col("nv"), threshold)).select("u", "v")
        if not links.isEmpty():
            component = components(links if component is None else links.unionByName(component.where("id <> component").select(F.col("id").alias("u"), F.col("component").alias("v"))))
        return tested

    def labelled(rows: DataFrame) -> DataFrame:
        if component is None:
            return rows.withColumn("c", F.col("id"))
        return rows.join(component.hint("merge"), "id", "left").withColumn("c", F.coalesce("component", "id")).drop("component")

    # Round 1: the bucket's least id against the others.
    first = members.groupBy("bucket").agg(F.min(F.struct("id", "n")).alias("p")).select("bucket", F.col("p.id").alias("pivot"), F.col("p.n").alias("pn"))
    sizes_fit = 100 * F.least("n", "pn") >= threshold * F.greatest("n", "pn")
    test(written(members.join(first.hint("merge"), "bucket").where((F.col("id") != F.col("pivot")) & sizes_fit).select(F.col("id").alias("member"), "pivot").distinct(), "pairs"))
    live = written(_open(labelled(members).withColumns({"shared": F.col("n"), "extra": F.lit(0).cast("long")}), threshold), "live")
    release(spark)
    if not live.isEmpty():
        # Round 2: what each document shares with no other bounds what it can share with anyone. The document with the
        # least of its own is the most central one; what the others share with it bounds all other pairs of the bucket.
        texts = written(texts.join(live.select("id").distinct().hint("merge"), "id", "left_semi"), "texts")
        own = written(private_counts(texts), "own") if single else None
        if single:
            live = live.join(own.hint("merge"), "id")
        else:
            live = live.withColumns({"own": F.lit(0).cast("long"), "slices": F.array().cast("array<int>")})
        live = written(_open(live.withColumn("shared", F.col("n") - F.col("own")), threshold), "live")
        pivots = written(live.groupBy("bucket").agg(F.min(F.struct("own", "id")).alias("p")).select("bucket", F.col("p.id").alias("pivot")), "pivots")
        tested = test(written(live.join(pivots.hint("merge"), "bucket").where("id <> pivot").select(F.col("id").alias("member"), "pivot").distinct(), "pairs"))
        rest = live.drop("c", "shared", "extra").join(pivots.hint("merge"), "bucket").where("id <> pivot")
        if single:
            rest = rest.join(tested.select(F.col("u").alias("id"), F.col("v").alias("pivot"), F.col("common").alias("shared")).hint("merge"), ["id", "pivot"])
        else:
            rest = rest.withColumn("shared", F.col("n"))
        rest = rest.withColumn("extra", F.col("n") - F.col("shared") - F.col("own")).drop("pivot")
        live = written(_open(labelled(rest), threshold), "live")
    salts = 1
    while not live.isEmpty():
        # Later rounds: what is left, against the most central documents of ever more parts of the bucket.
        salts *= SALT_STEP
        chosen = live.groupBy("bucket", F.pmod(F.xxhash64("id"), F.lit(salts)).alias("s")).agg(F.min(F.struct("own", "id", "n", "c", "shared", "extra", "slices")).alias("p"))
        pivots = written(chosen.select("bucket", F.col("p.id").alias("pivot"), *[F.col(f"p.{x}").alias(f"p_{x}") for x in ("n", "c", "shared", "extra", "slices")]), "pivots")
        pairs = live.join(pivots.hint("merge"), "bucket").where(F.col("c") != F.col("p_c"))
        if single:  # else the pivot's bounds are those of one of its texts, while it leaves the bucket with all of them
            fits = may_link(F.least("shared", "p_shared") + F.least("extra", "p_extra"), F.col("n") + F.col("p_n"), threshold)
            pairs = pairs.where(fits & (100 * F.least("n", "p_n") >= threshold * F.greatest("n", "p_n")) & may_link(most_common(F.col("slices"), F.col("p_slices")), F.col("n") + F.col("p_n"), threshold))
        pairs = written(pairs.select(F.col("id").alias("member"), "pivot").distinct(), "pairs")
        if not pairs.isEmpty():
            test(pairs)
        rest = live.drop("c").join(pivots.select("bucket", F.col("pivot").alias("id")).hint("merge"), ["bucket", "id"], "left_anti")
        live = written(_open(labelled(rest), threshold), "live")
        release(spark)
    groups = classes.select("n", "set_a", "set_b", "class", "size")
    if component is None:
        groups = groups.withColumn("component_id", F.col("class"))
    else:
        groups = groups.join(component.withColumnRenamed("id", "class").hint("merge"), "class", "left").withColumn("component_id", F.coalesce("component", "class"))
    groups = written(groups.select(key.alias("key"), "size", "component_id"), "classes")
    full = found.where("n > 0").select("id", F.col("n").alias("n_shingles"), key.alias("key"))
    rows = join_groups(full, groups, "key", "size", full.count()).select("id", "n_shingles", "component_id")
    return rows.unionByName(found.where("n = 0").select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component_id")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable by links), kept (the component's own row)."""
    rows = near_components(docs)
    back = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias("doc_id" if c == "id" else c)
    return rows.select(back("id"), "n_shingles", back("component_id"), (F.col("id") == F.col("component_id")).alias("kept"))


def op1(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)


def keep_one(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """docs with its own columns, whatever their names, one document of each component."""
    gone = near_components(docs, threshold).where("id <> component_id").select("id").distinct()
    rows = numbered(docs)
    own = F.coalesce(rows[place_of(docs, "doc_id")].cast("long"), F.lit(NO_ID))
    return rows.join(gone.hint("merge"), own == gone["id"], "left_anti").toDF(*docs.columns)


ORACLE = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM doc WHERE len(w) > 0)
), size AS (
  SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), inter AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM shingle a JOIN shingle b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), link AS (
  SELECT x, y FROM inter JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y WHERE 100 * i >= 85 * (p.n + q.n - i)
), edge AS (
  SELECT x, y FROM link UNION ALL SELECT y, x FROM link
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM doc UNION SELECT reach.a, edge.y FROM reach JOIN edge ON edge.x = reach.b
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, c AS component_id, d.doc_id = c AS kept
FROM doc d JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) r ON r.a = d.doc_id LEFT JOIN size ON size.doc_id = d.doc_id
"""
