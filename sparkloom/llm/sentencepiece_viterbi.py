"""Operator 10: SentencePiece encoding and decoding by an Aho-Corasick automaton over the pieces.

The automaton reads a word's characters once. At each position its output links give every piece that ends there,
and each such piece relaxes the best score of the position:

* a unigram model adds the piece's score to the best score at the piece's start (ties: the longer last piece);
* a BPE model ranks segmentations by merge order, which no sum of scores expresses. There a piece may relax the
  position only if merging would leave the boundary between it and the best segmentation's last piece at its start
  (checked on the two pieces alone, and remembered). One piece at most qualifies, so the survivor is the BPE result.

Characters that no piece covers become byte pieces (byte fallback) or the unknown piece. No piece of a model that
splits by white space goes over a word's start, so words are encoded one by one and the results remembered (up to
CACHE_WORDS words in a task); runs of white space are words of their own kind. Models that don't split by white
space are encoded text by text. The model is a file that is already there (path is a parameter); it is read on the
driver and broadcast: its size is the vocabulary's, whatever the corpus. No shuffle.

A null text gives null ids; an empty text gives none. Texts that hold U+2581 decode with spaces there, as the
format has no escape for it. Repeated rows give repeated rows, an empty table an empty result. Texts of any length are
encoded whole. Columns other than doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.common import slices_by_bytes

SPACE = "▁"
CACHE_WORDS, CACHE_PAIRS = 200_000, 300_000
SLICE_BYTES, SLICE_IDS = 1 << 20, 1 << 18
#: Types of pieces in a model file (fixed values of the format).
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
LOWEST = float("-inf")


def default_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass
class Pieces:
    """A model: its pieces in order of id, and how texts are normalised."""

    pieces: list[tuple[str, float, int]]
    kind: int = UNIGRAM
    byte_fallback: bool = False
    dummy_prefix: bool = True
    squeeze: bool = False
    by_white_space: bool = True

    @classmethod
    def load(cls, path: str) -> Pieces:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        norm, trained = model.normalizer_spec, model.trainer_spec
        if norm.precompiled_charsmap or not norm.escape_whitespaces or trained.treat_whitespace_as_suffix:
            raise ValueError("only identity normalisation with escaped, leading white space is built")
        return cls([(p.piece, p.score, p.type) for p in model.pieces], trained.model_type, trained.byte_fallback, norm.add_dummy_prefix, norm.remove_extra_whitespaces, trained.split_by_whitespace)


class AhoCorasick:
    """Automaton over strings: goto as one dict for each state, failure links, and output links to the next shorter match."""

    def __init__(self, words: list[tuple[str, int]]):
        self.next: list[dict[str, int]] = [{}]
        self.word: list[tuple[int, int] | None] = [None]
        for text, key in words:
            at = 0
            for c in text:
                to = self.next[at].get(c)
                if to is None:
                    to = self.next[at][c] = len(self.next)
                    self.next.append({})
                    self.word.append(None)
                at = to
            self.word[at] = (len(text), key)
        self.fail = [0] * len(self.next)
        self.output = [0] * len(self.next)
        queue = list(self.next[0].values())
        for at in queue:
            for c, to in self.next[at].items():
                back = self.fail[at]
                while back and c not in self.next[back]:
                    back = self.fail[back]
                self.fail[to] = self.next[back].get(c, 0) if self.next[back].get(c, 0) != to else 0
                queue.append(to)
            back = self.fail[at]
            self.output[at] = back if self.word[back] else self.output[back]

    def outputs(self, at: int) -> list[tuple[int, int]]:
        """(length, key) of all words that end in a state, longest first, along the output links."""
        found = []
        while at:
            if self.word[at]:
                found.append(self.word[at])
            at = self.output[at]
        return found


class Lattice:
    """For each position of a word: the automaton's state, the best score, and the last piece of the best segmentation."""

    def __init__(self) -> None:
        self.states, self.best, self.lengths, self.keys = [0], [0.0], [0], [-1]

    def cut(self, n: int) -> None:
        for x in (self.states, self.best, self.lengths, self.keys):
            del x[n + 1 :]


@dataclass
class Codec:
    model: Pieces
    #: Ids of words as packed 32-bit integers: a fifth of the memory of tuples, and texts are put together by one join.
    cache: dict[str, bytes] = field(default_factory=dict)
    pairs: dict[int, bool] = field(default_factory=dict)

    def __post_init__(self) -> None:
        pieces = self.model.pieces
        usable = [(text, key) for key, (text, _, kind) in enumerate(pieces) if kind in (NORMAL, USER)]
        self.automaton = AhoCorasick(usable)
        self.ids = dict(usable)
        self.bytes = {int(text[3:5], 16): key for key, (text, _, kind) in enumerate(pieces) if kind == BYTE}
        self.unknown = next((key for key, p in enumerate(pieces) if p[2] == UNKNOWN), 0)
        scores = [s for _, s, kind in pieces if kind == NORMAL]
        self.unknown_score = (min(scores) if scores else 0.0) - 10.0
        self.odd = np.array([p[2] not in (NORMAL, USER) for p in pieces] or [True])
        self.is_byte = np.array([p[2] == BYTE for p in pieces] or [False])
        self.scores = [p[1] for p in pieces]
        self.texts = [p[0].replace(SPACE, " ") for p in pieces]
        self.steps = [dict(x) for x in self.automaton.next]
        self.found: list[list[tuple[int, int]] | None] = [None] * len(self.steps)
        self.older: dict[str, bytes] = {}

    def __getstate__(self) -> Pieces:
        return self.model

    def __setstate__(self, model: Pieces) -> None:
        self.__init__(model)

    def normalise(self, text: str) -> str:
        if self.model.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        return (" " + text if self.model.dummy_prefix else text).replace(" ", SPACE)

    def words(self, text: str) -> list[str]:
        """Parts that no piece goes over: each run of spaces with the word behind it."""
        if not self.model.by_white_space:
            return [text]
        return re.findall(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+", text)

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text."""
        return [np.frombuffer(ids, np.int32).tolist() for ids in self.packed(texts)]

    def packed(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as 32-bit integers. New words are segmented in order, so that each starts where it leaves the one before."""
        parted = [self.words(self.normalise(text)) for text in texts]
        known = self.cache
        missing = set().union(*parted).difference(known)
        if missing:
            fresh = {word: ids for word in missing if (ids := self.older.get(word)) is not None}
            self.segment(sorted(missing.difference(fresh)), fresh)
            if len(known) + len(fresh) > CACHE_WORDS:
                self.older = known
                known = {word: known[word] for words in parted for word in words if word in known}
            known |= fresh
            self.cache = known if len(known) <= CACHE_WORDS else {}
        return [b"".join(map(known.__getitem__, words)) for words in parted]

    def segment(self, words: list[str], into: dict[str, bytes]) -> None:
        """Viterbi over sorted words; the positions of a prefix shared with the word before are kept as they are."""
        relax = self.relax_bpe if self.model.kind == BPE else self.relax_unigram
        lattice = Lattice()
        before = ""
        for word in words:
            same = 0
            for x, y in zip(word, before, strict=False):
                if x != y:
                    break
                same += 1
            lattice.cut(same)
            relax(word[same:], lattice)
            before = word
            out: list = []
            at, lengths, keys = len(word), lattice.lengths, lattice.keys
            while at:
                n, key = lengths[at], keys[at]
                out.append((key,) if key >= 0 else self.fallback(word[at - n : at]))
                at -= n
            into[word] = array("i", [x for ids in reversed(out) for x in ids]).tobytes()

    def step(self, state: int, c: str) -> int:
        """The automaton's next state, by failure links; remembered, so that the next such step is one lookup."""
        nxt, fail, at = self.automaton.next, self.automaton.fail, state
        to = nxt[at].get(c)
        while to is None and at:
            at = fail[at]
            to = nxt[at].get(c)
        self.steps[state][c] = to = to or 0
        return to

    def ending(self, state: int) -> list[tuple[int, int]]:
        """(length, key) of the pieces that end in a state, longest first; of a BPE model those that merging can make."""
        found = self.automaton.outputs(state)
        if self.model.kind == BPE:
            found = [(n, key) for n, key in found if self.merge(self.model.pieces[key][0]) == [key]]
        self.found[state] = found
        return found

    def relax_unigram(self, text: str, lattice: Lattice) -> None:
        steps, outputs, scores = self.steps, self.found, self.scores
        best, lengths, keys, states = lattice.best, lattice.lengths, lattice.keys, lattice.states
        state, end = states[-1], len(states) - 1
        for c in text:
            end += 1
            to = steps[state].get(c)
            state = self.step(state, c) if to is None else to
            found = outputs[state]
            if found is None:
                found = self.ending(state)
            top, length, piece = LOWEST, 1, -1
            for n, key in found:
                score = best[end - n] + scores[key]
                if score > top:
                    top, length, piece = score, n, key
            if not found or found[-1][0] > 1:  # no piece is this character: it may be unknown
                score = best[end - 1] + self.unknown_score
                if score > top:
                    top, length, piece = score, 1, -1
            best.append(top)
            states.append(state)
            lengths.append(length)
            keys.append(piece)

    def relax_bpe(self, text: str, lattice: Lattice) -> None:
        steps, outputs, pairs = self.steps, self.found, self.pairs
        lengths, keys, states = lattice.lengths, lattice.keys, lattice.states
        state, end = states[-1], len(states) - 1
        for c in text:
            end += 1
            to = steps[state].get(c)
            state = self.step(state, c) if to is None else to
            found = outputs[state]
            if found is None:
                found = self.ending(state)
            length, piece = 1, -1
            for n, key in found:
                left = keys[end - n]
                if left < 0:  # the word's start or a character that has no piece: nothing merges over it
                    length, piece = n, key
                    break
                apart = pairs.get(left << 20 | key)
                if apart is None:
                    apart = self.stays_apart(left, key)
                if apart:
                    length, piece = n, key
                    break
            states.append(state)
            lengths.append(length)
            keys.append(piece)

    def fallback(self, text: str) -> list[int]:
        if self.model.byte_fallback and len(self.bytes) == 256:
            return [self.bytes[b] for b in text.encode("utf-8", "surrogatepass")]
        return [self.unknown]

    def stays_apart(self, left: int, key: int) -> bool:
        """Whether merging the two pieces' characters leaves the boundary between them. left has no piece: nothing merges over it."""
        if len(self.pairs) >= CACHE_PAIRS:
            self.pairs.clear()
        pieces = self.model.pieces
        apart = self.pairs[left << 20 | key] = self.merge(pieces[left][0] + pieces[key][0]) == [left, key]
        return apart

    def merge(self, text: str) -> list[int]:
        """Byte-pair merging of a short text by definition: the best-scored pair first, of equal ones the leftmost."""
        parts = list(text)
        while len(parts) > 1:
            ranked = [(-self.model.pieces[key][1], at) for at in range(len(parts) - 1) if (key := self.ids.get(parts[at] + parts[at + 1])) is not None]
            if not ranked:
                break
            at = min(ranked)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ids.get(p, -1) for p in parts]

    def decode(self, ids: list[int] | np.ndarray) -> str:
        ids = np.asarray(ids, np.int32)
        odd = self.odd[ids].any()
        ids = ids.tolist()
        if not odd:
            text = "".join(map(self.texts.__getitem__, ids))
            return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text
        pieces, out, pending = self.model.pieces, [], bytearray()
        for key in ids:
            text, _, kind = pieces[key]
            if kind == BYTE:
                pending.append(int(text[3:5], 16))
                continue
            if pending:
                out.append(pending.decode("utf-8", "replace"))
                pending.clear()
            if kind != CONTROL:
                out.append(" ⁇ " if kind == UNKNOWN else text)
        if pending:
            out.append(pending.decode("utf-8", "replace"))
        text = "".join(out).replace(SPACE, " ")
        return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text


_CODECS: dict[str, Codec] = {}


def codec_of(model: Pieces, name: str) -> Codec:
    """The worker's codec of the model; what it remembers serves the worker's later tasks too."""
    if name not in _CODECS:
        _CODECS.clear()
        _CODECS[name] = Codec(model)
    return _CODECS[name]


def encode(spark: SparkSession, docs: DataFrame, model_path: str | None = None, with_ids: bool = True) -> DataFrame:
    """doc_id, ids (array of piece ids), n_pieces, n_bytes (byte pieces), ids_sha256 (of the ids as little-endian 32-bit integers), round_trip (decoding gives the text)."""
    path = model_path or default_model_path()
    shared = spark.sparkContext.broadcast(Pieces.load(path))
    names = ["doc_id", *["ids"] * with_ids, "n_pieces", "n_bytes", "ids_sha256", "round_trip"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared.value, path)
        for batch in batches:
            for part in slices_by_bytes(batch, 1, SLICE_BYTES):
                texts = part.column(1).to_pylist()
                coded = iter(codec.packed([t for t in texts if t is not None]))
                rows, packed = [], []
                for text in texts:
                    if text is None:
                        rows.append((0, 0, None, None))
                        packed.append(b"")
                        continue
                    packed.append(next(coded))
                    ids = np.frombuffer(packed[-1], np.int32)
                    rows.append((len(ids), int(codec.is_byte[ids].sum()), hashlib.sha256(packed[-1]).hexdigest(), codec.decode(ids) == text))
                n, n_bytes, sha, same = zip(*rows, strict=True)
                columns = [part.column(0), pa.array(n, pa.int64()), pa.array(n_bytes, pa.int64()), pa.array(sha, pa.string()), pa.array(same, pa.bool_())]
                if with_ids:
                    ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                    columns.insert(1, pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), np.int32)), mask=pa.array([t is None for t in texts])))
                yield pa.RecordBatch.from_arrays(columns, names)

    kinds = {"doc_id": "long", "ids": "array<int>", "n_pieces": "long", "n_bytes": "long", "ids_sha256": "string", "round_trip": "boolean"}
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in names))


def decode(spark: SparkSession, encoded: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id and the text of ids; null ids give a null text."""
    path = model_path or default_model_path()
    shared = spark.sparkContext.broadcast(Pieces.load(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared.value, path)
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).cumsum()
            at = 0
            while at < batch.num_rows:
                done = int(sizes[at - 1]) if at else 0
                part = batch.slice(at, max(1, int(sizes.searchsorted(done + SLICE_IDS, "right")) - at))
                at += part.num_rows
                texts = [None if ids is None else codec.decode(ids) for ids in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def op10(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return encode(spark, docs, with_ids=False)
