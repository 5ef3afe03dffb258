"""Operator 5: benchmark decontamination by a generalised suffix automaton of the test items.

The items' words (normalised) form one generalised suffix automaton, made on the driver and sent to the executors
once. Documents are streamed through it, each as a whole, and the length of the longest match that ends at each word is
tracked. Where it reaches the window, the window that ends there is in some item. Items shorter than the window are
matched as wholes. No shuffle.

What is broadcast is bounded by its own size: AUTOMATON_WORDS words of items (about 0.8 KB each in a worker). Items
beyond that go into further automata, one pass over the documents each; an item larger than an automaton is cut into
parts that overlap, so that each of its windows lies in a part. The passes' hits, and nothing else, are then joined.

Null, empty and wordless texts have no words and are never hit. Null item ids count as the word null in the list of
items; items without words match nothing; repeated items with one id count once. An empty benchmark hits nothing.
Repeated documents are judged each and alike; a null doc_id is an id of its own. Texts of any length are streamed
whole, one at a time. Columns of the documents other than doc_id and text are ignored by op5 and kept as they are by
clean(), whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.common import numbered, place_of, slices, written
from sparkloom.llm.word_automaton import SuffixAutomaton

WINDOW = 10
#: Words of the items that one automaton holds.
AUTOMATON_WORDS = 200_000
#: Of the pipeline's stage: a document of which more than this share is hit goes, else its hit words go.
MAX_COVERAGE = 0.5

#: Bytes that are not 0-9, a-z or part of a character beyond ASCII become spaces; A-Z become a-z.
TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))



def normal_words(text: bytes | None) -> list[bytes]:
    return text.translate(TO_WORDS).split() if text else []


class ItemMatcher:
    def __init__(self, items: list[tuple[str, bytes | None]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.automaton = SuffixAutomaton()
        self.items: dict[tuple[int, ...], set[str]] = {}
        ends: list[tuple[int, int]] = []
        for item_id, text in items:
            words = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in normal_words(text)]
            if not words:
                continue
            self.automaton.add(words)
            n = min(window, len(words))
            for at in range(len(words) - n + 1):
                self.items.setdefault(tuple(words[at : at + n]), set()).add(str(item_id))
            if len(words) < window:
                ends.append((len(words), words))
        self.short: dict[int, list[int]] = {}
        if ends:
            self._mark_short(ends)

    def _mark_short(self, short: list) -> None:
        """For each state the lengths of the short items that are suffixes of its strings."""
        a, whole = self.automaton, {}
        for n, words in short:
            state = 0
            for w in words:
                state = a.next[state][w]
            whole[state] = n
        for v in sorted(range(1, len(a.len)), key=a.len.__getitem__):
            found = ([whole[v]] if v in whole else []) + self.short.get(a.link[v], [])
            if found:
                self.short[v] = found

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans [start, end) of the words inside occurrences, merged, and the items that occur."""
        nxt, link, length, window, short = self.automaton.next, self.automaton.link, self.automaton.len, self.window, self.short
        ids = list(map(self.vocabulary.get, words))
        spans: list[list[int]] = []
        items: set[str] = set()
        state = matched = 0
        root = nxt[0]
        for at, word in enumerate(ids):
            if word is None:
                state = matched = 0
                continue
            to = nxt[state].get(word)
            if to is None:
                while state:
                    state = link[state]
                    to = nxt[state].get(word)
                    if to is not None:
                        break
                matched = length[state]
                if to is None:
                    to = root[word]
            state = to
            matched += 1
            if matched >= window:
                self._found(ids, at, window, spans, items)
            if short and state in short:
                for n in short[state]:
                    if n <= matched:
                        self._found(ids, at, n, spans, items)
        merged: list[tuple[int, int]] = []
        for start, end in sorted(map(tuple, spans)):
            if merged and start <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
            else:
                merged.append((start, end))
        return merged, items

    def _found(self, ids: list, at: int, n: int, spans: list[list[int]], items: set[str]) -> None:
        found = self.items.get(tuple(ids[at - n + 1 : at + 1]))
        if not found:
            return
        items |= found
        if spans and spans[-1][1] >= at - n + 1 and spans[-1][0] <= at - n + 1:
            spans[-1][1] = at + 1
        else:
            spans.append([at - n + 1, at + 1])


def matchers(benchmark: DataFrame, window: int = WINDOW, most: int = AUTOMATON_WORDS) -> Iterator[ItemMatcher]:
    """The items' automata, made one after another, each of most words or fewer; one without items for an empty benchmark."""
    held: list[tuple[str, bytes]] = []
    n = made = 0
    for item_id, text in benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("binary")).toLocalIterator():
        words = normal_words(None if text is None else bytes(text))
        most_here = max(most, window)
        for at in range(0, max(1, len(words) - window + 1), most_here - window + 1):
            part = words[at : at + most_here]
            if held and n + len(part) > most:
                yield ItemMatcher(held, window)
                held, n, made = [], 0, made + 1
            held.append(("null" if item_id is None else item_id, b" ".join(part)))
            n += len(part)
    if held or not made:
        yield ItemMatcher(held, window)


FOUND = "doc_id long, hash long, n_words long, spans array<struct<s:int,e:int>>, items array<string>"
SPANS = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))


def _scan(docs: DataFrame, items: ItemMatcher, every: bool) -> DataFrame:
    """FOUND: of each row, or of the rows that are hit, the hit words as [s, e), and the ids of the items that occur."""
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        for batch in batches:
            for part in slices(batch, 2):
                out = []
                for text in part.column(2).to_pylist():
                    words = normal_words(text)
                    spans, ids = found.hits(words)
                    out.append((len(words), [{"s": s, "e": e} for s, e in spans], list(ids)))
                n, spans, ids = zip(*out, strict=True)
                rows = pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(n, pa.int64()), pa.array(spans, SPANS), pa.array(ids, pa.list_(pa.string()))], ["doc_id", "hash", "n_words", "spans", "items"])
                yield rows if every else rows.filter(pa.array([bool(x) for x in spans]))

    text = F.col("text").cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("hash"), text.alias("text")).mapInArrow(scan, FOUND)


def _found(docs: DataFrame, benchmark: DataFrame, window: int, most: int) -> DataFrame:
    """FOUND of each row, from as many passes as there are automata."""
    first, *rest = [_scan(docs, m, k == 0) if k == 0 else written(_scan(docs, m, False), "hits") for k, m in enumerate(matchers(benchmark, window, most))]
    if not rest:
        return first
    hits = rest[0]
    for more in rest[1:]:
        hits = hits.unionByName(more)
    key = [F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), "hash"]
    # Repeated rows are hit alike, so each pass counts once.
    hits = hits.select(*key, "spans", "items").groupBy("id", "hash").agg(F.flatten(F.collect_set("spans")).alias("more"), F.flatten(F.collect_set("items")).alias("others"))
    both = first.select("*", key[0]).join(hits.hint("merge"), ["id", "hash"], "left")
    none = lambda c, kind: F.coalesce(c, F.array().cast(kind))
    spans = F.array_sort(F.concat("spans", none("more", "array<struct<s:int,e:int>>")))
    return both.select("doc_id", "hash", "n_words", spans.alias("spans"), F.array_distinct(F.concat("items", none("others", "array<string>"))).alias("items"))


def covered(spans: Column) -> Column:
    """Words in the union of spans, which are sorted and may overlap."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    step = lambda a, x: F.struct(F.greatest(a["end"], x["e"]).alias("end"), (a["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(a["end"], x["s"]))).alias("n"))
    return F.aggregate(spans, start, step)["n"]


def find(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most: int = AUTOMATON_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and spans: the hit words as [s, e)."""
    hits = _found(docs, benchmark, window, most)
    return hits.select(
        "doc_id", "n_words", covered(F.col("spans")).alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"), "spans",
    )


def op5(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return find(spark, docs, benchmark).drop("spans")


def _byte_spans(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of words as spans of bytes of the text as it is."""
    starts, ends, inside = [], [], False
    for at, b in enumerate(text.translate(TO_WORDS)):
        if (b != 32) != inside:
            (starts if not inside else ends).append(at)
            inside = not inside
    if inside:
        ends.append(len(text))
    return [(starts[s], ends[e - 1]) for s, e in spans]


def _without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """text without the words of spans, which are sorted and may overlap."""
    pieces, at = [], 0
    for s, e in _byte_spans(text, spans):
        pieces.append(text[at : max(s, at)])
        at = max(e, at)
    return b"".join([*pieces, text[at:]])


def clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE, most: int = AUTOMATON_WORDS) -> DataFrame:
    """docs with its own columns, without the hit spans of its texts and without the documents of which more than max_coverage is hit.

    n_chars, where there is one, is counted anew (in its own type) for texts that change. Documents that aren't hit stay as they are.
    """
    rows = numbered(docs)
    at = docs.columns.index("text")
    count_at = docs.columns.index("n_chars") if "n_chars" in docs.columns else None
    own = rows.columns
    automata = matchers(benchmark, window, most)
    first = next(automata)
    several = next(automata, None) is not None
    if several:  # the spans come from as many passes as there are automata
        text = F.col(place_of(docs, "text")).cast("binary")
        key = (F.coalesce(F.col(place_of(docs, "doc_id")).cast("long"), F.lit(-(1 << 63))), F.xxhash64(text))
        hits = _found(docs, benchmark, window, most).where("size(spans) > 0").select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), "hash", "spans").dropDuplicates(["id", "hash"])
        rows = rows.withColumns({"id": key[0], "hash": key[1]}).join(hits.hint("merge"), ["id", "hash"], "left").select(*own, "spans")
    shared = spark.sparkContext.broadcast(None if several else first)

    def scrub(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        for batch in batches:
            for part in slices(batch, at):
                given = part.column(len(own)).to_pylist() if several else None
                texts, stays, changed = [], [], False
                for k, text in enumerate(part.column(at).cast(pa.binary()).to_pylist()):
                    if several and not given[k]:
                        texts.append(text)
                        stays.append(True)
                        continue
                    words = normal_words(text)
                    spans = [(x["s"], x["e"]) for x in given[k]] if several else found.hits(words)[0]
                    n_hit = len(set().union(*(range(s, e) for s, e in spans)))
                    stays.append(n_hit <= max_coverage * len(words))
                    if spans:
                        changed = True
                        if stays[-1]:
                            text = _without(text, spans)
                    texts.append(text)
                columns = part.columns[: len(own)]
                if changed:
                    before = columns[at]
                    columns[at] = pa.array(texts, pa.binary()).cast(before.type)
                    if count_at is not None:
                        same = pc.fill_null(pc.equal(before, columns[at]), True)
                        columns[count_at] = pc.if_else(same, columns[count_at], pc.utf8_length(columns[at]).cast(columns[count_at].type))
                yield pa.RecordBatch.from_arrays(columns, own).filter(pa.array(stays))

    schema = numbered(docs).schema
    return rows.mapInArrow(scrub, schema).toDF(*docs.columns)


ORACLE = r"""
WITH item AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS g, least(10, len(w)) AS n
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)
), doc AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), place AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)
), hit AS (
  SELECT doc_id, i, n, item_id FROM place JOIN win USING (g, n)
), word AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc d LEFT JOIN word ON word.doc_id = d.doc_id LEFT JOIN found ON found.doc_id = d.doc_id
"""
