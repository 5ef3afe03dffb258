"""Operator 6: language-model scoring with an Elias-Fano n-gram trie.

Words. Level 1 counts words (64-bit hashes; the end of a text is a word too, the empty one) and is cut into shards by
ranges of hashes; a word's id is its rank. Texts are tokenised once more, then stored as ids, in blocks of some
BLOCK_TOKENS tokens in the shared folder; all that follows reads these.

N-grams. Each block's distinct trigrams (with the bigrams they begin with, and how often each comes in training texts)
are sorted and cut by ranges of (first, second, third word), and sent, packed, to the parts that own the ranges. So each n-gram of
a block is shuffled as some six bytes and not as a row, and a context that a third of all texts share is dealt
to several parts like any other range. All n-grams are kept, also those that occur once.

Trie. A part's merged n-grams are one shard of the trie: a file that is memory-mapped, with the second words of all
first words and the third words of all bigrams, each as one monotone sequence (each context's words on top of the last
value of the context before) with the pointers to where a context's children start, all Elias-Fano coded; 16-bit
quantised log10 probabilities and weights. A look-up takes the context's pointers and the value before them, and
searches the successor of the word relative to it. A context in which a range is cut lies in two shards or more; the
totals of these, two words and two bigrams for each shard, are added up on the driver before probabilities are written.

Scores. The blocks' n-grams are dealt to the parts once more (which takes less disk than keeping them there). Each part
looks them up in its shard, and sends back the probabilities, in the order of the block's n-grams, and the block's task
puts them together, ROUNDS groups of blocks after one another. So a task opens one shard, and
never the trie as a whole, however large it grows. Level 1 alone is read by all tasks.

Smoothing. Interpolated absolute discounting: p(w|c) = (n(cw) - D) / n(c) + g(c) p(w|c'), g(c) = D times the distinct
words after c / n(c); p(w) = (n(w) + 1) / (N + V + 1), which gives unseen words 1 / (N + V + 1). The shards hold the first term
and g; the sum is taken at scoring.

Null and empty texts have one token, the end. A null doc_id counts as empty text in the split. An empty table gives an
empty result; without training documents all words are unseen. Repeated rows are counted and scored each. A text longer
than a block is a block of its own. Columns other than doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.common import drop_path, make_path, release, scratch, slices_by_bytes, written
from sparkloom.llm.elias_fano import EliasFano

DISCOUNT = 0.75
#: Words of a shard of level 1, tokens of a block and of a part, samples of each part from which the ranges are cut.
SHARD_WORDS, BLOCK_TOKENS, PART_TOKENS, SAMPLES = 1_000_000, 1_500_000, 2_000_000, 64
SLICE_BYTES, LOOK_UPS = 1 << 20, 200_000
FOLDS, HELD_FOLD = 7, 2
#: Groups of blocks that are scored one after another: what is on its way to the parts and back is never more than a group's.
ROUNDS = 4
END = xxhash.xxh3_64_intdigest(b"")
SIGN = np.uint64(1 << 63)
SCORED = "doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double"
#: Quantisation: log10 values from LEAST to 0 in 65534 steps; NONE stands for a probability of nought.
LEAST, STEPS, NONE = -13.0, 65534, 65535


def quantised(log10: np.ndarray) -> np.ndarray:
    return np.rint(np.clip(log10 / LEAST, 0, 1) * STEPS).astype(np.uint16)


def probability(q: np.ndarray) -> np.ndarray:
    return np.where(q == NONE, 0.0, 10.0 ** (q.astype(np.float64) * (LEAST / STEPS)))


def pack(arrays: list[np.ndarray]) -> bytes:
    """Arrays of numbers from 0 up, in as few bytes each as their greatest needs, byte by byte, compressed."""
    head, planes = [], []
    for a in arrays:
        top = int(a.max(initial=0))
        width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
        head += [len(a), width]
        planes.append(np.ascontiguousarray(a, f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join([np.array(head, "<i8").tobytes(), *planes]))


def unpack(blob: bytes, n: int) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    head, at, out = np.frombuffer(raw, "<i8", 2 * n).tolist(), 16 * n, []
    for size, width in zip(head[::2], head[1::2], strict=True):
        plane = np.frombuffer(raw, np.uint8, size * width, at).reshape(width, size)
        out.append(np.ascontiguousarray(plane.T).view(f"<u{width}").ravel().astype(np.int64))
        at += size * width
    return out


def save_arrays(uri: str, arrays: dict[str, np.ndarray]) -> None:
    """One file with a line of JSON and the arrays; written under another name first, so that it is whole or absent."""
    from pyarrow import fs

    at, head, blobs = 0, {}, []
    for name, a in arrays.items():
        raw = np.ascontiguousarray(a).tobytes()
        head[name] = (a.dtype.str, at, len(a))
        blobs.append(raw + bytes(-len(raw) % 8))
        at += len(blobs[-1])
    line = json.dumps(head).encode()
    line += b" " * (-(len(line) + 1) % 8) + b"\n"
    store, path = fs.FileSystem.from_uri(uri)
    with store.open_output_stream(f"{path}.part") as out:
        out.write(line)
        for b in blobs:
            out.write(b)
    store.move(f"{path}.part", path)


def load_arrays(uri: str) -> dict[str, np.ndarray]:
    """The arrays of a file, memory-mapped; from a remote store by way of an unnamed local copy."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    local = path
    if not isinstance(store, fs.LocalFileSystem):
        handle, local = tempfile.mkstemp()
        os.close(handle)
        with store.open_input_stream(path) as src, open(local, "wb") as out:
            while chunk := src.read(1 << 22):
                out.write(chunk)
    whole = np.memmap(local, np.uint8, "r")
    if local != path:
        os.unlink(local)  # the mapping stays
    start = bytes(whole[: 1 << 16]).index(b"\n") + 1
    return {name: whole[start + at : start + at + n * np.dtype(kind).itemsize].view(kind) for name, (kind, at, n) in json.loads(bytes(whole[:start])).items()}


#: Shards of level 1 are read again and again by a worker.
_words_file = lru_cache(maxsize=1024)(load_arrays)


def coded(arrays: dict[str, np.ndarray], name: str) -> EliasFano:
    return EliasFano(*(arrays[f"{name}.{x}"] for x in ("low", "high", "ones", "zeros", "shape")))


def coding(name: str, values: np.ndarray) -> dict[str, np.ndarray]:
    return {f"{name}.{k}": v for k, v in EliasFano.parts(values).items()}


@dataclass
class Shard:
    """A shard of level 1: its file, the first and last word hash it holds, and the rank of its first."""

    uri: str
    first: int
    last: int
    n: int
    rank: int = 0


@dataclass
class Part:
    """A shard of levels 2 and 3: its files, and the totals of the contexts in which its range is cut.

    words: first word of a cut -> (count, distinct words after it) in all parts; pairs: the same of the first two.
    """

    number: int
    counts: str
    file: str = ""
    words: dict[int, tuple[int, int]] = field(default_factory=dict)
    pairs: dict[tuple[int, int], tuple[int, int]] = field(default_factory=dict)


@dataclass
class Words:
    """Level 1. tokens is N, count is V."""

    shards: list[Shard] = field(default_factory=list)
    tokens: int = 0
    count: int = 0

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Rank of each word hash, -1 for unseen words."""
        out = np.full(len(hashes), -1, np.int64)
        if not self.shards:
            return out
        firsts = np.array([s.first for s in self.shards], np.uint64)
        of = np.searchsorted(firsts, hashes, "right") - 1
        for k in np.unique(of[of >= 0]):
            shard = self.shards[k]
            at = np.flatnonzero((of == k) & (hashes <= np.uint64(shard.last)))
            i, same = coded(_words_file(shard.uri), "words").successor(hashes[at] - np.uint64(shard.first))
            out[at[same]] = shard.rank + i[same]
        return out

    def counts(self, ids: np.ndarray) -> np.ndarray:
        """How often each word occurs in the training texts; 0 for unseen words."""
        out = np.zeros(len(ids), np.int64)
        of = np.searchsorted(np.array([s.rank for s in self.shards]), ids, "right") - 1
        for k in np.unique(of[ids >= 0]):
            at = np.flatnonzero((of == k) & (ids >= 0))
            out[at] = _words_file(self.shards[k].uri)["counts"][ids[at] - self.shards[k].rank]
        return out


@dataclass
class Trie:
    """words: level 1; cuts: where the ranges of the parts after the first begin; parts: levels 2 and 3, in order."""

    words: Words
    cuts: list[tuple[int, int, int]] = field(default_factory=list)
    parts: list[Part] = field(default_factory=list)


def in_training(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS != HELD_FOLD


def hashes_of(text: bytes | None) -> np.ndarray:
    words = text.lower().split() if text else []
    words.append(b"")
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _by_tokens(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Rows (doc_id, text, train) in groups of about most tokens: their (doc_id, train), and the token hashes of their texts."""
    rows: list[tuple] = []
    tokens: list[np.ndarray] = []
    n = 0
    for batch in batches:
        for part in slices_by_bytes(batch, 1, SLICE_BYTES):
            for doc_id, text, train in zip(*(c.to_pylist() for c in part.columns), strict=True):
                found = hashes_of(text)
                if rows and n + len(found) > most:
                    yield rows, tokens
                    rows, tokens, n = [], [], 0
                rows.append((doc_id, train))
                tokens.append(found)
                n += len(found)
    if rows:
        yield rows, tokens


def _rows(docs: DataFrame, train: Column) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), train.alias("train"))


def count_words(docs: DataFrame, train: Column, folder: str) -> Words:
    """Level 1 of the training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, tokens in _by_tokens(batches, BLOCK_TOKENS):
            words, n = np.unique(np.concatenate(tokens), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array((words ^ SIGN).view(np.int64)), pa.array(n)], ["w", "n"])

    counts = written(_rows(docs.where(train), train).mapInArrow(run, "w long, n long").groupBy("w").agg(F.sum("n").alias("n")), "words")
    found = Words()
    found.count, found.tokens = (x or 0 for x in counts.agg(F.count(F.lit(1)), F.sum("n")).first())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            w, n = (np.concatenate([b.column(i).to_numpy() for b in held]) for i in (0, 1))
            keys = w.view(np.uint64) ^ SIGN
            uri = f"{folder}/words-{uuid.uuid4().hex}"
            save_arrays(uri, coding("words", keys - keys[0]) | {"counts": n.astype(np.uint32) if n.max() < 1 << 32 else n})
            yield pa.RecordBatch.from_pylist([{"uri": uri, "first": str(keys[0]), "last": str(keys[-1]), "n": len(n)}])

    if found.count:
        cut = counts.repartitionByRange(-(-found.count // SHARD_WORDS), "w").sortWithinPartitions("w")
        made = cut.mapInArrow(write, "uri string, first string, last string, n long").collect()
        found.shards = sorted((Shard(r.uri, int(r.first), int(r.last), r.n) for r in made), key=lambda s: s.first)
        for before, shard in zip(found.shards, found.shards[1:], strict=False):
            shard.rank = before.rank + before.n
    _drop(counts)
    return found


def _drop(table: DataFrame) -> None:
    """Removes the files of a written table."""
    for file in table.inputFiles()[:1]:
        drop_path(table.sparkSession, file.rpartition("/")[0])


def _unique_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of numbers from 0 up, in order, and of each row its pair's place."""
    width = int(b.max(initial=0)) + 1
    if int(a.max(initial=0)) + 1 < (1 << 62) // width:
        keys, inverse = np.unique(a * width + b, return_inverse=True)
        return keys // width, keys % width, inverse
    order = np.lexsort((b, a))
    new = np.concatenate([[True], (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)])
    first, inverse = order[new], np.empty(len(a), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return a[first], b[first], inverse


def _starts(of: np.ndarray, n: int) -> np.ndarray:
    """Where the rows of each of n numbers start in a sorted array, and its length."""
    return np.searchsorted(of, np.arange(n + 1))


class Grams:
    """The n-grams of a block: one for each token that has another one behind it and is a known word.

    a, b, c: that word and the two behind it, b and c as unseen where they are, c as none where the text ends or b is
    unseen. at: the token's place. Distinct pairs (a, b) are numbered, and distinct (pair, c).
    """

    def __init__(self, ids: np.ndarray, ends: np.ndarray, count: int):
        unseen, none = count, count + 1
        last = np.zeros(len(ids) + 2, bool)
        last[ends - 1] = True
        word = np.concatenate([np.where(ids < 0, unseen, ids), [none, none]])
        self.at = np.flatnonzero(~last[: len(ids)] & (ids >= 0))
        a, b = word[self.at], word[self.at + 1]
        c = np.where(last[self.at + 1] | (b == unseen), none, word[self.at + 2])
        self.third = c != none
        self.a, self.b, self.pair = _unique_pairs(a, b)
        self.of, self.c, self.gram = _unique_pairs(self.pair, c)
        self.start = _starts(self.of, len(self.a))

    def place(self, cut: tuple[int, int, int]) -> int:
        """How many of the distinct trigrams lie before a cut."""
        low, high = np.searchsorted(self.a, cut[0], "left"), np.searchsorted(self.a, cut[0], "right")
        p = low + np.searchsorted(self.b[low:high], cut[1], "left")
        if p < high and self.b[p] == cut[1]:
            return int(self.start[p] + np.searchsorted(self.c[self.start[p] : self.start[p + 1]], cut[2], "left"))
        return int(self.start[p])

    def parts(self, cuts: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """Of each part that has any: its number, the range of its trigrams, their distinct first words, how many pairs each of these has, and how many trigrams each pair."""
        marks = [0, *map(self.place, cuts), len(self.c)]
        for k, (low, high) in enumerate(zip(marks, marks[1:], strict=False)):
            if low < high:
                p = self.of[low]
                words, pairs = np.unique(self.a[p : self.of[high - 1] + 1], return_counts=True)
                yield k, low, high, words, pairs, np.bincount(self.of[low:high] - p)


@dataclass
class Blocks:
    """Texts as ids: the names of the blocks, a file for each, and their tokens."""

    spark: SparkSession
    names: list[str]
    folder: str
    tokens: int
    cuts: list[tuple[int, int, int]]

    def table(self) -> DataFrame:
        """number, name of the blocks, one in a partition."""
        return self.spark.createDataFrame(list(enumerate(self.names)), "number int, name string").repartitionById(max(1, len(self.names)), F.col("number"))

    def rounds(self) -> list[Blocks]:
        """The blocks in ROUNDS groups."""
        return [Blocks(self.spark, self.names[k::ROUNDS], self.folder, self.tokens, self.cuts) for k in range(ROUNDS) if self.names[k::ROUNDS]]


def encode(docs: DataFrame, train: Column, words: Words, folder: str) -> Blocks:
    """Tokenises all texts and stores them as ids; samples tokens with the two behind them to cut the ranges of parts."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(words)
    step = max(1, PART_TOKENS // SAMPLES, words.tokens // 2_000_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for rows, tokens in _by_tokens(batches, BLOCK_TOKENS):
            ends = np.cumsum([len(x) for x in tokens])
            distinct, inverse = np.unique(np.concatenate(tokens), return_inverse=True)
            ids = known.ids(distinct)[inverse]
            name = uuid.uuid4().hex
            train = np.array([bool(x[1]) for x in rows])
            doc_ids, null = np.array([x[0] or 0 for x in rows], np.int64), np.array([x[0] is None for x in rows])
            packed = pack([ids + 1, np.diff(ends, prepend=0)])  # 0 stands for unseen words
            save_arrays(f"{folder}/block-{name}", {"texts": np.frombuffer(packed, np.uint8), "doc_id": doc_ids, "null": null, "train": train})
            some = np.where(ids < 0, known.count, ids)[::step]
            behind = [np.concatenate([np.where(ids < 0, known.count, ids)[k:], np.full(k, known.count + 1)])[::step] for k in (1, 2)]
            sample = [pa.array([x.tolist()], pa.list_(pa.int64())) for x in (some, *behind)]
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(rows)], pa.int64()), pa.array([len(ids)], pa.int64()), *sample], ["block", "docs", "tokens", "a", "b", "c"])

    table = written(_rows(docs, train).mapInArrow(run, "block string, docs long, tokens long, a array<long>, b array<long>, c array<long>"), "blocks")
    total = table.agg(F.sum("tokens")).first()[0] or 0
    n = -(-total // PART_TOKENS)
    cuts: list[tuple[int, int, int]] = []
    if n > 1:
        held = table.select("a", "b", "c").toArrow()
        a, b, c = (np.concatenate([x.values.to_numpy() for x in held.column(k).chunks]) for k in range(3))
        order = np.lexsort((c, b, a))
        picked = order[np.arange(1, n) * len(order) // n]
        cuts = sorted(set(zip(a[picked].tolist(), b[picked].tolist(), c[picked].tolist(), strict=True)))
    names = sorted(r.block for r in table.select("block").collect())
    _drop(table)
    return Blocks(spark, names, folder, total, cuts)


def _texts(held: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the tokens of a block's file, and where its texts end."""
    ids, sizes = unpack(bytes(held["texts"]), 2)
    return ids - 1, np.cumsum(sizes)


def _dealt(blocks: Blocks, count: int) -> DataFrame:
    """part, block (its number), grams: each block's distinct trigrams of each part, packed: first words, pairs of each, second words, trigrams of each, third words, counts in training."""
    folder, shared = blocks.folder, blocks.spark.sparkContext.broadcast(blocks.cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, name in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held = load_arrays(f"{folder}/block-{name}")
                ids, ends = _texts(held)
                grams = Grams(ids, ends, count)
                train = np.repeat(held["train"], np.diff(np.concatenate([[0], ends])))[grams.at]
                n = np.bincount(grams.gram[train], minlength=len(grams.c))
                for k, low, high, words, pairs, children in grams.parts(shared.value):
                    seconds = grams.b[grams.of[low] : grams.of[high - 1] + 1]
                    blob = pack([words, pairs, seconds, children, grams.c[low:high], n[low:high]])
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([number], pa.int32()), pa.array([blob])], ["part", "block", "grams"])

    return blocks.table().mapInArrow(run, "part int, block int, grams binary")


def _at_parts(blocks: Blocks, count: int) -> DataFrame:
    """_dealt(), one part in each partition."""
    return _dealt(blocks, count).repartitionById(len(blocks.cuts) + 1, F.col("part"))


def _by_key(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[object, list[tuple]]]:
    """Rows of a stream in which equal values of a column are together, by these values."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if rows and row[column] != key:
                yield key, rows
                rows = []
            key = row[column]
            rows.append(row)
    if rows:
        yield key, rows


def _merge(blobs: list[bytes], count: int) -> list[np.ndarray]:
    """The training n-grams of some blocks added up: first words, pairs of each, second words, counts, trigrams of each pair, third words, counts."""
    kind = np.int32 if count < (1 << 31) - 2 else np.int64
    cols: list[list[np.ndarray]] = [[], [], [], []]
    for blob in blobs:
        words, pairs, seconds, children, thirds, n = unpack(blob, 6)
        some = n > 0
        for held, x in zip(cols, (np.repeat(np.repeat(words, pairs), children), np.repeat(seconds, children), thirds, n), strict=True):
            held.append(x[some].astype(kind))
    joined = []
    while cols:  # one column after another, so that the parts of each can go
        held = cols.pop(0)
        joined.append(np.concatenate(held) if held else np.empty(0, kind))
        held.clear()
    a, b, pair = _unique_pairs(joined[0].astype(np.int64), joined[1].astype(np.int64))
    c, n = joined[2].astype(np.int64), joined[3]
    joined.clear()
    n2 = np.bincount(pair, n, len(a)).astype(np.int64)
    whole = c < count
    of, c, gram = _unique_pairs(pair[whole], c[whole])
    n3 = np.bincount(gram, n[whole], len(c)).astype(np.int64)
    words, pairs = np.unique(a, return_counts=True)
    return [words, pairs, b, n2, np.bincount(of, minlength=len(a)), c, n3]


def _cut_contexts(merged: list[np.ndarray], cuts: list[tuple[int, int, int]]) -> dict:
    """What a part has of the contexts in which its range is cut: [word, count, distinct pairs] and [word, word, count, distinct trigrams]."""
    words, pairs, seconds, n2, children, _, _ = merged
    of = np.repeat(words, pairs)
    told: dict[str, list] = {"words": [], "pairs": []}
    for a in sorted({cut[0] for cut in cuts}):
        told["words"].append([a, int(n2[of == a].sum()), int((of == a).sum())])
    for a, b in sorted({cut[:2] for cut in cuts}):
        at = (of == a) & (seconds == b)
        told["pairs"].append([a, b, int(n2[at].sum()), int(children[at].sum())])
    return told


def _totals(parts: list[Part], told: list[dict]) -> None:
    """Gives each part the totals of the contexts in which its range is cut, over all parts that hold some of them."""
    words: dict[int, list[int]] = {}
    pairs: dict[tuple[int, int], list[int]] = {}
    for some in told:
        for a, n, distinct in some["words"]:
            held = words.setdefault(a, [0, 0])
            held[0] += n
            held[1] += distinct
        for a, b, n, distinct in some["pairs"]:
            held = pairs.setdefault((a, b), [0, 0])
            if held[0] and n:  # a pair that several parts have is one child of its word
                words[a][1] -= 1
            held[0] += n
            held[1] += distinct
    for part, some in zip(parts, told, strict=True):
        part.words = {a: tuple(words[a]) for a, _, _ in some["words"]}
        part.pairs = {(a, b): tuple(pairs[a, b]) for a, b, _, _ in some["pairs"]}


def _log_weight(distinct: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Quantised log10 of what a context leaves to the shorter one; a context without children leaves all."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return quantised(np.where(distinct > 0, np.log10(DISCOUNT * distinct / n), 0.0))


def _sequence(contexts: int, context: np.ndarray, word: np.ndarray, name: str) -> dict[str, np.ndarray]:
    """Pointers of contexts 0 to contexts - 1 and the words of each, on top of the last value of the context before."""
    size = np.bincount(context, minlength=contexts)
    pointers = np.concatenate([[0], np.cumsum(size)])
    some = np.flatnonzero(size)
    bases = np.concatenate([[0], np.cumsum(word[pointers[some + 1] - 1] + 1)[:-1]]).astype(np.uint64) if len(some) else np.empty(0, np.uint64)
    return coding(f"pointers{name}", pointers) | coding(f"words{name}", np.repeat(bases, size[some]) + word.astype(np.uint64))


def shard_arrays(merged: list[np.ndarray], part: Part) -> dict[str, np.ndarray]:
    """The arrays of a part's file."""
    words, pairs, seconds, n2, children, thirds, n3 = merged
    first = int(words[0])
    context, pair = np.repeat(words - first, pairs), np.repeat(np.arange(len(seconds)), children)
    n1, after = np.bincount(context, n2), np.bincount(context)
    for a, (n, distinct) in part.words.items():
        if first <= a <= words[-1]:
            n1[a - first], after[a - first] = n, distinct
    of = np.repeat(words, pairs)
    total, behind = n2.astype(np.float64), children.astype(np.float64)
    for (a, b), (n, distinct) in part.pairs.items():
        p = np.flatnonzero((of == a) & (seconds == b))
        total[p], behind[p] = n, distinct
    arrays = {"first": np.array([first, int(words[-1])], np.int64), "weights2": _log_weight(after, n1), "weights3": _log_weight(behind, total)}
    arrays |= {"probs2": quantised(np.log10((total - DISCOUNT) / n1[context])), "probs3": quantised(np.log10((n3 - DISCOUNT) / total[pair]))}
    return arrays | _sequence(int(words[-1]) - first + 1, context, seconds, "2") | _sequence(len(seconds), pair, thirds, "3")


class TrieShard:
    """A part's file, memory-mapped."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.arrays = arrays
        self.first, self.last = arrays["first"].tolist()
        self.levels = {n: (coded(arrays, f"pointers{n}"), coded(arrays, f"words{n}")) for n in "23"}

    def find(self, level: str, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Place of each context's child, -1 where there is none."""
        pointers, words = self.levels[level]
        out = np.full(len(context), -1, np.int64)
        start, stop = pointers.get(context).astype(np.int64), pointers.get(context + 1).astype(np.int64)
        some = np.flatnonzero(start < stop)
        start, stop = start[some], stop[some]
        base = np.where(start > 0, words.get(np.maximum(start - 1, 0)) + np.uint64(1), np.uint64(0))
        i, same = words.successor(base + word[some].astype(np.uint64))
        good = same & (i < stop)
        out[some[good]] = i[good]
        return out


def answer(part: Part, shard: TrieShard | None, grams: list[np.ndarray]) -> list[np.ndarray]:
    """Of n-grams as _dealt() packs them: weights of the first words, probabilities and weights of the pairs, probabilities of the trigrams."""
    words, pairs, seconds, children, thirds = grams[:5]
    of = np.repeat(words, pairs)
    weights2, weights3 = np.zeros(len(words), np.uint16), np.zeros(len(seconds), np.uint16)
    probs2, probs3 = np.full(len(seconds), NONE, np.uint16), np.full(len(thirds), NONE, np.uint16)
    if shard:
        inside = (words >= shard.first) & (words <= shard.last)
        weights2[inside] = shard.arrays["weights2"][words[inside] - shard.first]
        place = np.full(len(seconds), -1, np.int64)
        asked = np.flatnonzero(np.repeat(inside, pairs))
        place[asked] = shard.find("2", of[asked] - shard.first, seconds[asked])
        known = place >= 0
        probs2[known], weights3[known] = shard.arrays["probs2"][place[known]], shard.arrays["weights3"][place[known]]
        context = np.repeat(place, children)
        asked = np.flatnonzero(context >= 0)
        found = shard.find("3", context[asked], thirds[asked])
        hit = found >= 0
        probs3[asked[hit]] = shard.arrays["probs3"][found[hit]]
    # Of contexts in which the range is cut, this part may hold nothing but others do.
    for a, (n, distinct) in part.words.items():
        weights2[words == a] = _log_weight(np.array([distinct]), np.array([n]))
    for (a, b), (n, distinct) in part.pairs.items():
        if n:
            at = np.flatnonzero((of == a) & (seconds == b))
            probs2[at], weights3[at] = quantised(np.log10([(n - DISCOUNT) / part.words[a][0]])), _log_weight(np.array([distinct]), np.array([n]))
    return [weights2, probs2, weights3, probs3]


def train_trie(blocks: Blocks, words: Words) -> Trie:
    """Levels 2 and 3 of the blocks' training texts."""
    spark, folder, count = blocks.spark, blocks.folder, words.count
    trie = Trie(words, blocks.cuts)
    if not blocks.tokens:
        return trie

    cuts = spark.sparkContext.broadcast(blocks.cuts)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, rows in _by_key(batches, 0):
            merged = _merge([blob for _, _, blob in rows], count)
            uri = f"{folder}/part-{uuid.uuid4().hex}"
            some = len(merged[0]) > 0
            if some:
                save_arrays(f"{uri}-counts", {"packed": np.frombuffer(pack(merged), np.uint8)})
            told = _cut_contexts(merged, cuts.value[max(0, k - 1) : k + 1])
            yield pa.RecordBatch.from_pylist([{"part": k, "uri": uri, "some": some, "told": json.dumps(told)}])

    made = written(_at_parts(blocks, count).mapInArrow(merge, "part long, uri string, some boolean, told string"), "parts")
    rows = made.orderBy("part").collect()
    release(spark)  # the n-grams are in the parts' files: their shuffle can go
    trie.parts = [Part(r.part, f"{r.uri}-counts" if r.some else "") for r in rows]
    _totals(trie.parts, [json.loads(r.told) for r in rows])
    shared = spark.sparkContext.broadcast({p.number: p for p in trie.parts})

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column(0).to_pylist():
                part = shared.value[number]
                uri = f"{folder}/trie-{uuid.uuid4().hex}"
                save_arrays(uri, shard_arrays(unpack(bytes(load_arrays(part.counts)["packed"]), 7), part))
                yield pa.RecordBatch.from_pylist([{"part": number, "uri": uri}])

    full = [(p.number,) for p in trie.parts if p.counts]
    if full:
        files = spark.createDataFrame(full, "part int").repartition(len(full)).mapInArrow(finish, "part long, uri string").collect()
        of = {r.part: r.uri for r in files}
        for p in trie.parts:
            p.file = of.get(p.number, "")
            if p.counts:
                drop_path(spark, p.counts)
    _drop(made)
    return trie


def _answers(blocks: Blocks, trie: Trie) -> DataFrame:
    """block, part, found: what each part has of each block's n-grams."""
    spark, count = blocks.spark, trie.words.count
    shared = spark.sparkContext.broadcast({p.number: p for p in trie.parts})

    def answered(number: int, names: list[int], asked: list[list[np.ndarray]], shard: TrieShard | None) -> pa.RecordBatch:
        """Many blocks' n-grams are looked up together: single look-ups of few n-grams would cost more than what they find."""
        whole = answer(shared.value[number], shard, [np.concatenate(x) for x in zip(*asked, strict=True)])
        ends = [np.cumsum([len(grams[k]) for grams in asked])[:-1] for k in (0, 2, 2, 4)]
        found = [pack(list(x)) for x in zip(*(np.split(x, e) for x, e in zip(whole, ends, strict=True)), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array([number] * len(names), pa.int32()), pa.array(found)], ["block", "part", "found"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard, names, asked, n = None, None, [], [], 0
        for batch in batches:
            for part, block, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if names and (part != number or n > LOOK_UPS):
                    yield answered(number, names, asked, shard)
                    names, asked, n = [], [], 0
                if part != number:
                    number, file = part, shared.value[part].file
                    shard = TrieShard(load_arrays(file)) if file else None
                names.append(block)
                asked.append(unpack(blob, 6)[:5])
                n += len(asked[-1][4])
        if names:
            yield answered(number, names, asked, shard)

    return _at_parts(blocks, count).mapInArrow(run, "block int, part int, found binary")


def _scores(held: dict[str, np.ndarray], found: list[bytes], trie: Trie) -> tuple[np.ndarray, ...]:
    """For each text of a block: tokens, known tokens, base and model log10 probability. found: the parts' answers, in order."""
    words = trie.words
    ids, ends = _texts(held)
    starts = np.concatenate([[0], ends[:-1]])
    distinct, inverse = np.unique(ids, return_inverse=True)
    alone = ((words.counts(distinct) + 1) / (words.tokens + words.count + 1))[inverse]
    grams = Grams(ids, ends, words.count)
    cols: list[list[np.ndarray]] = [[], [], [], []]
    for (_, _, _, _, pairs, children), blob in zip(grams.parts(trie.cuts), found, strict=True):
        weights2, probs2, weights3, probs3 = unpack(blob, 4)
        for col, x in zip(cols, (np.repeat(np.repeat(weights2, pairs), children), np.repeat(probs2, children), np.repeat(weights3, children), probs3), strict=True):
            col.append(x)
    weight2, prob2, weight3, prob3 = (probability(np.concatenate(x)) if x else np.empty(0) for x in cols)
    p = alone.copy()
    p[grams.at + 1] = prob2[grams.gram] + weight2[grams.gram] * p[grams.at + 1]
    at, gram = grams.at[grams.third], grams.gram[grams.third]
    p[at + 2] = prob3[gram] + weight3[gram] * p[at + 2]
    add = lambda x: np.add.reduceat(x, starts)
    return np.diff(np.concatenate([[0], ends])), add((ids >= 0).astype(np.int64)), add(np.log10(alone)), add(np.log10(p))


def score(blocks: Blocks, trie: Trie) -> DataFrame:
    """doc_id, train, n_tokens, n_known, base_score, score of each row."""
    spark, folder = blocks.spark, blocks.folder
    shared = spark.sparkContext.broadcast(Trie(trie.words, trie.cuts))
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_key(batches, 0):
            held = load_arrays(f"{folder}/block-{rows[0][3]}")
            found = _scores(held, [blob for _, part, blob, _ in rows if part >= 0], shared.value)
            ids = pa.array(held["doc_id"], mask=np.array(held["null"]))
            cols = [pa.array(x.astype(k)) for x, k in zip(found, (np.int64, np.int64, np.float64, np.float64), strict=True)]
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.array(held["train"])), *cols], ["doc_id", "train", "n_tokens", "n_known", "base_score", "score"])

    # A block of texts without pairs has no answers, and is there all the same: its name comes as part -1.
    every = blocks.table().select(F.col("number").alias("block"), F.lit(-1).alias("part"), F.lit(None).cast("binary").alias("found"), "name")
    answers = every if not trie.parts else _answers(blocks, trie).withColumn("name", F.lit(None).cast("string")).unionByName(every)
    dealt = answers.repartitionById(max(1, len(blocks.names)), F.col("block")).sortWithinPartitions("block", "part")
    return dealt.mapInArrow(run, SCORED)


def op6(spark: SparkSession, docs: DataFrame) -> DataFrame:
    folder = scratch(spark, "ngram-trie")
    make_path(spark, folder)
    train = in_training(F.col("doc_id"))
    words = count_words(docs, train, folder)
    release(spark)
    blocks = encode(docs, train, words, folder)
    trie = train_trie(blocks, words)
    release(spark)
    scored = spark.createDataFrame([], SCORED)
    for some in blocks.rounds():
        scored = scored.unionByName(written(score(some, trie), "scores"))
        release(spark)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", F.lit(words.tokens).cast("long").alias("train_tokens"), "base_score", "score")
