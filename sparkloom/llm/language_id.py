"""Operator 8: language identification by Bayesian evidence fusion.

Four kinds of evidence are added up as log-odds for each language:

* the text: hashed byte 3-grams, each language's distribution counted over all labelled documents by grouped
  aggregation (no sample), add-one smoothed and mixed with the uniform one; tempered, as overlapping n-grams repeat each other;
* the language that markup declares, trusted with DECLARED_TRUST;
* the address suffix: how often each language comes with the host's last label, smoothed towards the whole;
* the host: a prior smoothed hierarchically, the host's votes on top of its parent domain's, that on top of the
  suffix's, that on top of all. The votes are what text and declaration say of each page, added up by host.

No evidence counts twice: a page's own vote is taken out of the votes of its host, parent, suffix and the whole before
they become its prior, and where labelled documents are judged themselves, their texts are judged by what the other
fold of the documents (by hash of the text) has taught.

An unknown language competes by a uniform distribution over 3-grams, so that texts which no language explains are
rejected. Only the table of 3-gram counts (languages x BUCKETS numbers) is brought to the driver and broadcast; the
tables of hosts are joined, hot hosts, parents and suffixes apart from the rest.

A text without 3-grams (null, empty or without letters) is decided by the other evidence, and rejected where there is
none. Null or malformed urls have no host; all such rows share the whole table's prior. Of equally likely languages the
first by name is taken. Labels that are null are left out of the training; repeated rows count each, in training, in
votes and in the result. Texts of any length are counted whole, one at a time. Without labelled texts every row is
rejected, language null. Empty tables give empty results. Other columns are ignored, and kept by keep_identified()
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from sparkloom.llm.common import SLICE_ROWS, join_groups, numbered, place_of, slices, written

BUCKETS = 4096
#: Languages whose totals a task holds at once.
HELD_LANGUAGES = 256
DECLARED_TRUST = 0.9
#: Text evidence of n 3-grams counts as TEMPER * n / (TEMPER + n) of them.
TEMPER = 200.0
#: Share of the uniform distribution in each language's: keys, numbers and names in a text speak for no language, and little against one.
BACKGROUND = 0.2
#: Votes that a prior of the next wider kind is worth.
PRIOR_WEIGHT = 10.0
LEAST_CONFIDENCE = 0.5
UNKNOWN_PRIOR = 1 / 20
#: A label is wrong where another language is at least as sure as this.
SURE = 0.99
#: Parts of the labelled documents: each is judged by what the others teach.
FOLDS = 2
#: Bytes that aren't letters (or parts of characters beyond ASCII) are one kind; A-Z become a-z.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def gram_counts(text: bytes | None) -> np.ndarray:
    """How often each bucket of byte 3-grams occurs in a whole text, words set apart by one space."""
    words = (text or b"").translate(FOLD).split()
    if not words:
        return np.zeros(BUCKETS, np.int64)
    codes = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    grams = (codes[:-2] * np.uint32(0x9E3779B1) + codes[1:-1] * np.uint32(0x85EBCA77) + codes[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(20)
    return np.bincount(grams, minlength=BUCKETS)


def _gram_totals(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, and how often each bucket comes in each fold and language; labelled has lang and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[str, int], np.ndarray] = {}

        def drain() -> Iterator[pa.RecordBatch]:
            for (lang, fold), counts in totals.items():
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array([fold] * len(at), pa.int32()), pa.array(at.astype(np.int32)), pa.array(counts[at].astype(np.int64))], ["lang", "fold", "bucket", "n"])
            totals.clear()

        for batch in batches:
            for part in slices(batch, 2):
                for lang, fold, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    totals[lang, fold] = totals.get((lang, fold), 0) + gram_counts(text)
                if len(totals) > HELD_LANGUAGES:  # Spark adds up what is given out more than once
                    yield from drain()
        yield from drain()

    rows = labelled.where("lang IS NOT NULL").select("lang", fold_of(F.col("text")).alias("fold"), F.col("text").cast("binary").alias("text")).mapInArrow(run, "lang string, fold int, bucket int, n long")
    counts = rows.groupBy("lang", "fold", "bucket").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(counts.column("lang").unique().to_pylist())
    totals = np.zeros((FOLDS, len(languages), BUCKETS))
    of = pc.index_in(counts.column("lang"), pa.array(languages, pa.string())).to_numpy()
    totals[counts.column("fold").to_numpy(), of, counts.column("bucket").to_numpy()] = counts.column("n").to_numpy()
    return languages, totals


def _log_probabilities(counts: np.ndarray) -> np.ndarray:
    table = counts + 1
    return np.log((1 - BACKGROUND) * table / table.sum(-1, keepdims=True) + BACKGROUND / BUCKETS)


def fold_of(text: Column) -> Column:
    """Equal texts lie in one fold."""
    return F.pmod(F.xxhash64(F.coalesce(text, F.lit(""))), F.lit(FOLDS)).cast("int")


def train(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, and log probability of each bucket under each; labelled has lang and text."""
    languages, totals = _gram_totals(labelled)
    return languages, _log_probabilities(totals.sum(0))


def train_folds(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, and for each fold what train() gives for all others."""
    languages, totals = _gram_totals(labelled)
    return languages, _log_probabilities(totals.sum(0) - totals)


def text_evidence(rows: DataFrame, languages: list[str], table: np.ndarray) -> DataFrame:
    """rows (row, text, fold, said): row, n_grams, own and vote.

    said is the number of the declared language, or null. own has the log-odds of each language against none, by tempered
    likelihood of the text and by declaration; vote is the number of the best, null where neither says anything.
    table: what train() or train_folds() gives; the fold counts with the latter only.
    """
    tables = table if table.ndim == 3 else np.repeat(table[None], FOLDS, 0)
    shared = rows.sparkSession.sparkContext.broadcast(tables + np.log(BUCKETS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odds = shared.value
        for batch in batches:
            for part in slices(batch, 1):
                counts = np.stack([gram_counts(t) for t in part.column(1).to_pylist()])
                n, fold, said = counts.sum(1), part.column(2).to_numpy(), _numbers(part.column(3))
                own = np.zeros((len(n), odds.shape[1]))
                for f in np.unique(fold):
                    own[fold == f] = counts[fold == f] @ odds[f].T
                own *= (TEMPER / (TEMPER + n))[:, None]
                declared = said >= 0
                own[declared] += np.log((1 - DECLARED_TRUST) / max(1, own.shape[1] - 1))
                own[declared, said[declared]] += np.log(DECLARED_TRUST) - np.log((1 - DECLARED_TRUST) / max(1, own.shape[1] - 1))
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * own.shape[1], pa.int32()), pa.array(own.ravel()))
                vote = pa.array(own.argmax(1), pa.int32(), mask=(n == 0) & ~declared)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n.astype(np.int64)), flat, vote], ["row", "n_grams", "own", "vote"])

    return rows.mapInArrow(run, StructType([rows.schema["row"]]).add("n_grams", "long").add("own", ArrayType(DoubleType())).add("vote", "integer"))


def _numbers(column: pa.Array) -> np.ndarray:
    """A column of languages' numbers, -1 for null."""
    return pc.fill_null(column, -1).to_numpy(zero_copy_only=False)


def _host_votes(found: DataFrame) -> tuple[DataFrame, list[tuple[int, int]]]:
    """host, size, and the votes (vote, n) of the host, of its parent domain and of its suffix; the votes of all.

    A group has one vote for each language at most.
    """
    suffix = F.substring_index("host", ".", -1)
    parent = F.when(F.size(F.split("host", r"\.")) > 2, F.substring_index("host", ".", -2)).otherwise(F.col("host"))
    counted = written(found.groupBy("host", "vote").agg(F.count(F.lit(1)).alias("n")).withColumns({"suffix": suffix, "parent": parent}), "votes")
    packed = F.collect_list(F.when(F.col("vote").isNotNull(), F.struct("vote", "n")))
    hosts = counted.groupBy("host", "parent", "suffix").agg(packed.alias("votes"), F.sum("n").alias("size"))
    n = counted.count()
    for key in ("parent", "suffix"):
        wider = counted.groupBy(key, "vote").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("hosts"))
        wider = wider.groupBy(key).agg(packed.alias(f"votes_of_{key}"), F.sum("hosts").alias("hosts"))
        hosts = join_groups(written(hosts, "host-votes"), written(wider, f"{key}-votes"), key, "hosts", n).drop("hosts")
    total = counted.where("vote IS NOT NULL").groupBy("vote").agg(F.sum("n")).collect()
    return written(hosts.select("host", "size", "votes", "votes_of_parent", "votes_of_suffix"), "host-priors"), [tuple(r) for r in total]


def _fused(rows: DataFrame, languages: list[str], total: list[tuple[int, int]]) -> DataFrame:
    """rows (row, n_grams, own, vote, host and the three kinds of votes): row, n_grams, lang, confidence, accepted."""
    width = len(languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, whole = pa.array(languages, pa.string()), np.zeros(width)
        for vote, n in total:
            whole[vote] = n
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                vote, own = _numbers(part.column("vote")), part.column("own").flatten().to_numpy().reshape(-1, width)
                some, lines = vote >= 0, np.arange(part.num_rows)
                # The page's own vote is in the votes of its host and all that is wider: it comes off each.
                mine = np.zeros(own.shape)
                mine[lines[some], vote[some]] = 1
                base = whole - mine + 1
                base /= base.sum(1, keepdims=True)
                prior = base
                for kind in ("votes_of_suffix", "votes_of_parent", "votes"):
                    lists = part.column(kind)
                    of, n = lists.flatten().flatten()
                    others = -mine
                    others[np.repeat(lines, pc.list_value_length(lists).to_numpy()), of.to_numpy()] += n.to_numpy()
                    prior = (others + PRIOR_WEIGHT * prior) / (others.sum(1, keepdims=True) + PRIOR_WEIGHT)
                nowhere = pc.equal(part.column("host"), "").to_numpy(zero_copy_only=False)
                logs = own + np.log(np.where(nowhere[:, None], base, prior))
                top = logs.max(1)
                with np.errstate(over="ignore"):  # beyond all numbers: no confidence at all
                    # The unknown language has no evidence for it and the prior of one vote among the host's.
                    rest = np.exp(np.log(UNKNOWN_PRIOR) - top) + np.exp(logs - top[:, None]).sum(1)
                confidence = np.where(some, 1 / rest, 0.0)
                lang = names.take(pa.array(logs.argmax(1), pa.int32(), mask=~some))
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("n_grams"), lang, pa.array(confidence), pa.array(some & (confidence >= LEAST_CONFIDENCE))], ["row", "n_grams", "lang", "confidence", "accepted"])

    return rows.mapInArrow(run, StructType([rows.schema["row"]]).add("n_grams", "long").add("lang", "string").add("confidence", "double").add("accepted", "boolean"))


def identify(rows: DataFrame, languages: list[str], table: np.ndarray) -> DataFrame:
    """rows: row (any), text, declared, host. Returns row, n_grams, lang, confidence, accepted.

    lang is the likeliest language, confidence its posterior probability with the unknown language among the rivals.
    """
    if not languages:
        return rows.select("row", F.lit(0).cast("long").alias("n_grams"), F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("confidence"), F.lit(False).alias("accepted"))
    names = F.array(*[F.lit(x) for x in languages])
    # A declaration "de-AT" declares "de". One that names none of the languages says nothing.
    place = F.array_position(names, F.substring_index(F.lower(F.coalesce("declared", F.lit(""))), "-", 1)).cast("int")
    host = F.coalesce(F.col("host"), F.lit(""))
    kept = rows.select(F.struct("row", host.alias("host")).alias("row"), F.col("text").cast("binary").alias("text"), fold_of(F.col("text")).alias("fold"), F.when(place > 0, place - 1).alias("said"))
    found = written(text_evidence(kept, languages, table).select("row.row", "row.host", "n_grams", "own", "vote"), "language-evidence")
    votes, total = _host_votes(found)
    return _fused(join_groups(found, votes, "host", "size", found.count()), languages, total)


def host_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    return F.lower(F.regexp_extract(rest, r"^[^/?#:]*", 0))


def html_text(html: Column) -> Column:
    """Text of a page: no scripts, styles, comments or tags."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.regexp_replace(bare, r"(?s)<[^>]*>|&[#\w]{1,10};", " ")


def identify_pages(pages: DataFrame, labelled: DataFrame) -> DataFrame:
    """page_id, declared (of the html element), host, n_grams, lang, confidence, accepted for each page."""
    languages, table = train(labelled)
    declared = F.regexp_extract(F.coalesce("html", F.lit("")), r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([a-z]+)""", 1)
    rows = pages.select(F.struct("page_id", declared.alias("declared"), host_of(F.col("url")).alias("host")).alias("row"), html_text(F.col("html")).alias("text"), declared.alias("declared"), host_of(F.col("url")).alias("host"))
    found = identify(rows, languages, table)
    return found.select("row.page_id", F.lower("row.declared").alias("declared"), F.coalesce("row.host", F.lit("")).alias("host"), "n_grams", "lang", F.round("confidence", 6).alias("confidence"), "accepted")


def op8(spark: SparkSession, pages: DataFrame, docs: DataFrame) -> DataFrame:
    return identify_pages(pages, docs)


def keep_identified(docs: DataFrame) -> DataFrame:
    """docs with its own columns, without those whose language can't be told and those whose lang is wrong for sure.

    Texts are judged by what the other fold's labels teach, and by their source's prior (source takes the host's place);
    a document's own label is no evidence. Where the label names one of the languages and another one is found with
    a confidence of SURE, the label is wrong. Null labels and labels that no other document has can't be wrong. Verdicts
    are a function of text, lang and source, so rows are named by doc_id and a hash of these; the rejected are anti-joined.
    """
    languages, tables = train_folds(docs)
    rows = numbered(docs)
    at = lambda name: F.col(place_of(docs, name)).cast("string")
    text = lambda name: F.coalesce(at(name), F.lit("\0"))
    own = F.coalesce(F.col(place_of(docs, "doc_id")).cast("long"), F.lit(-(1 << 63)))
    keyed = rows.withColumn("key", F.struct(own.alias("id"), F.xxhash64(text("text"), text("lang"), text("source")).alias("hash")))
    asked = keyed.select(F.struct("key", at("lang").alias("label")).alias("row"), at("text").alias("text"), F.lit(None).cast("string").alias("declared"), at("source").alias("host"))
    found = identify(asked, languages, tables)
    wrong = F.col("row.label").isin(languages) & (F.col("row.label") != F.col("lang")) & (F.col("confidence") >= SURE)
    gone = found.where(~F.col("accepted") | F.coalesce(wrong, F.lit(False))).select("row.key").distinct()
    return keyed.join(written(gone, "unidentified").hint("merge"), "key", "left_anti").select(*rows.columns).toDF(*docs.columns)
