"""Operator 4: substring deduplication by suffix automata of reference shards.

The corpus is its own reference, and it has no size bound, so its automata can't all be broadcast, nor can every
document be streamed through every shard: that grows with the square of the corpus. Both are avoided by content:

1. Every window of WINDOW words chooses its anchor, the least GRAM-word hash in it (the rightmost of equal ones).
   Equal windows choose equal anchors, wherever they are. The windows that share an anchor's place form a segment;
   each window lies in one segment only. One pass over the documents emits (anchor, segment hash) and no text.
2. Anchors that occur once are dropped. Segments that occur more than once are repeated as a whole.
3. The distinct segments of the other anchors, one of each kind, are the reference. They are sharded by anchor, so that each shard holds all places at which
   its windows occur; for each shard a task builds the suffix automaton (bounded by SHARD_WORDS and one anchor's
   segments) and streams the shard's segments through it. Where the matched length reaches the window and the
   matched string ends at two places or more, the window is repeated; runs of such windows give maximal spans.
4. An anchor with more than HOT distinct segments would outgrow a shard (the edge of a passage that many documents share).
   Its windows are dealt one by one, keyed by their own hash and counted by partial aggregation instead.

With a reference of its own of a checked size, matching_spans() broadcasts the automaton and streams documents
through it, with no shuffle.

Words are [^\\x20\\x09-\\x0D]+, unchanged. Null, empty and wordless texts and those shorter than a window lose nothing.
Repeated rows are copies of each other like any two documents. A null doc_id is an id of its own. An empty table gives
an empty result. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.common import join_groups, slices, written
from sparkloom.llm.word_automaton import SuffixAutomaton

WINDOW, GRAM = 35, 8
SHARD_WORDS = 40_000
HOT = 2048
NO_ID = -(1 << 63)
MAX_REFERENCE_WORDS = 2_000_000
STEP = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
UNIFORM, MIXED, DEALT = 0, 1, 2
SPAN = pa.struct([("f", pa.int32()), ("t", pa.int32())])


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


class Prefixes:
    """Hashes of any run of words, from sums of hash * STEP^position."""

    def __init__(self, h: np.ndarray):
        n = len(h)
        up, self.down = np.full(n, STEP), np.full(n + 1, BACK)
        up[:1] = 1
        self.down[0] = 1
        self.down = np.cumprod(self.down)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * np.cumprod(up))])

    def run(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return mixed((self.sums[start + length] - self.sums[start]) * self.down[start] + np.uint64(1) * np.asarray(length).astype(np.uint64))


def segments(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, segment hash, first window and number of windows of each segment of a text."""
    if len(h) < WINDOW:
        none = np.empty(0, np.uint64)
        return none, none, np.empty(0, np.int64), np.empty(0, np.int64)
    sums = Prefixes(h)
    grams = sums.run(np.arange(len(h) - GRAM + 1), GRAM)
    seen = np.lib.stride_tricks.sliding_window_view(grams, WINDOW - GRAM + 1)
    anchor = np.arange(len(seen)) + (WINDOW - GRAM) - seen[:, ::-1].argmin(1)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    count = np.diff(np.concatenate([first, [len(anchor)]]))
    offset = (anchor[first] - first).astype(np.uint64)
    return grams[anchor[first]], mixed(sums.run(first, count + WINDOW - 1) + offset), first, count


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))


def scan(docs: DataFrame) -> DataFrame:
    """id, th (the text's hash; both name the row), n_words, sha (of all words), marks: the segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                n, sha, found, ends = [], [], [], [0]
                for text in part.column(2).to_pylist():
                    words = text.split()
                    n.append(len(words))
                    sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
                    found.append(segments(word_hashes(words)))
                    ends.append(ends[-1] + len(found[-1][0]))
                a, s, at, count = (np.concatenate(x) for x in zip(*found, strict=True))
                marks = pa.StructArray.from_arrays([pa.array(a.view(np.int64)), pa.array(s.view(np.int64)), pa.array(at.astype(np.int32)), pa.array(count.astype(np.int32))], ["a", "s", "at", "n"])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(sha), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), marks)], ["id", "th", "n_words", "sha", "marks"])

    return _keyed(docs).mapInArrow(run, "id long, th long, n_words long, sha string, marks array<struct<a:long,s:long,at:int,n:int>>")


def _segment_texts(work: DataFrame) -> DataFrame:
    """a, id, th, at, words: the text of each mixed segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                out: list[tuple] = []
                for own, th, text, marks in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    words = text.split()
                    out += [(m["a"], own, th, m["at"], b" ".join(words[m["at"] : m["at"] + m["n"] + WINDOW - 1])) for m in marks]
                cols = list(zip(*out, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.binary())], ["a", "id", "th", "at", "words"])

    rows = work.select("id", "th", "text", F.filter("marks", lambda m: m["kind"] == MIXED).alias("marks")).where(F.size("marks") > 0)
    return rows.mapInArrow(run, "a long, id long, th long, at int, words binary")


def _dealt_windows(work: DataFrame) -> DataFrame:
    """a, w (the window's hash), id, th, at: each window of the hot anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                for own, th, text, marks in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    sums = Prefixes(word_hashes(text.split()))
                    at = np.concatenate([np.arange(m["at"], m["at"] + m["n"]) for m in marks])
                    a = np.concatenate([np.full(m["n"], m["a"], np.int64) for m in marks])
                    same = [pa.array(np.full(len(at), x, np.int64)) for x in (own, th)]
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(sums.run(at, WINDOW).view(np.int64)), *same, pa.array(at.astype(np.int32))], ["a", "w", "id", "th", "at"])

    rows = work.select("id", "th", "text", F.filter("marks", lambda m: m["kind"] == DEALT).alias("marks")).where(F.size("marks") > 0)
    return rows.mapInArrow(run, "a long, w long, id long, th long, at int")


class Shard:
    """A reference shard: distinct segments with the places they come from, its automaton, and the repeated windows."""

    def __init__(self) -> None:
        self.places: dict[bytes, list[tuple[int, int, int]]] = {}
        self.words = 0

    def add(self, words: bytes, place: tuple[int, int, int]) -> None:
        if words not in self.places:
            self.places[words] = []
            self.words += words.count(b" ") + 1
        self.places[words].append(place)

    def repeated(self) -> Iterator[tuple[int, int, int, int]]:
        """(id, th, from, to) of the maximal spans of repeated windows."""
        automaton = SuffixAutomaton()
        texts = {text: text.split(b" ") for text in self.places}
        for text, words in texts.items():
            automaton.add(words, len(self.places[text]))
        automaton.count_ends()
        link, length, ends = automaton.link, automaton.len, automaton.ends
        for text, words in texts.items():
            states, lengths = automaton.stream(words)
            spans: list[list[int]] = []
            for end in range(WINDOW - 1, len(words)):
                if lengths[end] < WINDOW:
                    continue
                state = states[end]
                while length[link[state]] >= WINDOW:
                    state = link[state]
                if ends[state] > 1:
                    start = end - WINDOW + 1
                    if spans and start <= spans[-1][1]:
                        spans[-1][1] = end + 1
                    else:
                        spans.append([start, end + 1])
            for own, th, at in self.places[text]:
                for start, stop in spans:
                    yield own, th, at + start, at + stop


def _match_shards(texts: DataFrame) -> DataFrame:
    """id, th, f, t: repeated spans, by one automaton for each shard of anchors."""
    n = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, last = Shard(), None

        def flush() -> pa.RecordBatch:
            cols = list(zip(*shard.repeated(), strict=True)) or [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int32())], ["id", "th", "f", "t"])

        for batch in batches:
            for part in slices(batch, 4):
                for a, own, th, at, words in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if a != last and shard.words > SHARD_WORDS:
                        yield flush()
                        shard = Shard()
                    shard.add(words, (own, th, at))
                    last = a
        yield flush()

    return texts.repartition(n, "a").sortWithinPartitions("a").mapInArrow(run, "id long, th long, f int, t int")


def _strip(work: DataFrame) -> DataFrame:
    """id, n_words, n_removed, sha of the documents that have marks; spans: what shards and dealt windows found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                n, removed, sha = [], [], []
                for text, marks, spans in zip(*(c.to_pylist() for c in part.columns[1:]), strict=True):
                    words = text.split()
                    gone = np.zeros(len(words), bool)
                    for m in marks:
                        gone[m["at"] : m["at"] + m["n"] + WINDOW - 1] = True
                    for s in spans or ():
                        gone[s["f"] : s["t"]] = True
                    n.append(len(words))
                    removed.append(int(gone.sum()))
                    sha.append(hashlib.sha256(b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])).hexdigest())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha)], ["id", "n_words", "n_removed", "sha"])

    rows = work.select("id", "text", F.filter("marks", lambda m: m["kind"] == UNIFORM).alias("marks"), "spans")
    return rows.mapInArrow(run, "id long, n_words long, n_removed long, sha string")


def strip_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the kept words, joined by one space)."""
    scanned = written(scan(docs), "scanned")
    places = scanned.select("id", "th", F.explode("marks").alias("m")).select("id", "th", "m.*")
    groups = places.groupBy("a").agg(F.count(F.lit(1)).alias("size"), F.min("s").alias("low"), F.max("s").alias("high")).where("size > 1")
    groups = written(groups.select("a", "size", (F.col("low") == F.col("high")).alias("same")), "anchors")
    total = scanned.agg(F.sum(F.size("marks"))).first()[0] or 0
    found = written(join_groups(places.select("id", "th", "a", "s", "at", "n"), groups, "a", "size", total), "found")
    # Of equal segments one stands for all in the shards; the others, and it too, are repeated as they are.
    other = found.where("NOT same").select("id", "th", "a", F.struct("a", "s").alias("segment"), "at", "n")
    distinct = written(other.groupBy("segment").agg(F.min(F.struct("id", "th", "at", "n")).alias("one"), F.count(F.lit(1)).alias("size")), "segments")
    several = join_groups(other, distinct.where("size > 1").select("segment", "size"), "segment", "size", other.count())
    loads = distinct.groupBy("segment.a").agg(F.count(F.lit(1)).alias("load"))
    loads = written(loads, "loads")
    standing = join_groups(distinct.select("segment.a", "one"), loads, "a", "load", distinct.count()).select("one.id", "one.th", "a", "one.at", "one.n", F.when(F.col("load") <= HOT, MIXED).otherwise(DEALT).alias("kind"))
    whole_ones = found.where("same").unionByName(several, allowMissingColumns=True).select("id", "th", "a", "at", "n", F.lit(UNIFORM).alias("kind"))
    marked = written(whole_ones.unionByName(standing).groupBy("id", "th").agg(F.collect_list(F.struct("a", "at", "n", "kind")).alias("marks")), "marked")
    work = written(_keyed(docs).join(marked, ["id", "th"]), "work")
    shards = _match_shards(_segment_texts(work))
    windows = _dealt_windows(work).select("id", "th", "at", F.struct("a", "w").alias("w"))
    windows = written(windows, "windows")
    counts = windows.groupBy("w").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    repeated = join_groups(windows, written(counts, "window-counts"), "w", "size", windows.count()).select("id", "th", F.col("at").alias("f"), (F.col("at") + WINDOW).alias("t"))
    spans = shards.unionByName(repeated).groupBy("id", "th").agg(F.collect_list(F.struct("f", "t")).alias("spans"))
    stripped = _strip(work.join(written(spans, "spans"), ["id", "th"], "left"))
    whole = scanned.select("id", "th", "n_words", "sha").join(marked.select("id", "th"), ["id", "th"], "left_anti").select("id", "n_words", F.lit(0).cast("long").alias("n_removed"), "sha")
    return stripped.unionByName(whole).select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "n_words", "n_removed", F.col("sha").alias("kept_sha256"))


def matching_spans(docs: DataFrame, reference: list[str], window: int = WINDOW) -> DataFrame:
    """doc_id and spans [f, t) of words that lie in a window of the given reference texts, by one broadcast automaton."""
    automaton, total = SuffixAutomaton(), 0
    for text in reference:
        words = text.encode().split()
        total += len(words)
        if total > MAX_REFERENCE_WORDS:
            raise ValueError("the reference is too large to be broadcast; cut it into shards")
        automaton.add(words)
    shared = docs.sparkSession.sparkContext.broadcast(automaton)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                out = []
                for text in part.column(1).to_pylist():
                    spans: list[dict[str, int]] = []
                    for end, n in enumerate(shared.value.stream((text or b"").split())[1], 1):
                        if n >= window:
                            if spans and end - window <= spans[-1]["t"]:
                                spans[-1]["t"] = end
                            else:
                                spans.append({"f": end - window, "t": end})
                    out.append(spans)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.list_(SPAN))], ["doc_id", "spans"])

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, "doc_id long, spans array<struct<f:int,t:int>>")


def op4(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return strip_repeats(docs)


ORACLE = r"""
WITH doc AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), word AS (
  SELECT doc_id, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS p FROM doc
), win AS (
  SELECT doc_id, p, string_agg(t, ' ') OVER f AS g, count(*) OVER f AS n
  FROM word WINDOW f AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)
), rep AS (
  SELECT doc_id, p, count(*) OVER (PARTITION BY md5(g)) AS c FROM win WHERE n = 35
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS p FROM rep WHERE c > 1
), kept AS (
  SELECT doc_id, string_agg(t, ' ' ORDER BY p) AS k FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
), removed AS (
  SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM doc d LEFT JOIN kept ON kept.doc_id = d.doc_id LEFT JOIN removed ON removed.doc_id = d.doc_id
"""
