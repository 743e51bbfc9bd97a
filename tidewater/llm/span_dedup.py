"""Repeated passages: sliding runs of sentences are hashed, joined globally, and what repeats is removed.

A run starts at every sentence and takes in the next ones until it has at least ``SENTENCES`` sentences and ``LEAST_WORDS``
words, so that short stock sentences don't make a passage; where a run ends depends on its text alone, so equal passages
have equal runs wherever they stand. A run also ends at every sentence and takes in the ones before it in the
same way: each sentence of a longer repeated run is then in one of its shortest runs from a start or to an end, so all of it is found. A
sentence of more than ``LONG`` words counts as several: it is parted after words that a hash picks, one in ``PART``, and after ``PART`` words
at most, so a passage that starts or ends inside a long sentence, or is one, is found but for the pieces at its ends. The first place of a run is the one with the least id, then the least position. Every
sentence in a run at any other place is removed.

Runs are combined by hash before the exchange; the many places of a hot run join its single first place as the large
side of a sort-merge join, which adaptive execution splits. Only hashes and positions travel, never texts.

Defined cases: null and empty texts have no sentences; white space and letter case don't tell runs apart; letters
of scripts without spaces count as a word each; a text of fewer
sentences or words than a run needs has none and stays; repeated rows share an id and so their places, and are
left alone as one; a null id counts as the least id. Other columns, whatever their names, are left alone.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import map_arrow
from .naming import fresh
from .scratch import Scratch

#: A passage of over 50 words is covered whole by runs of at least 25.
SENTENCES, LEAST_WORDS = 2, 25
LONG, PART = 32, 16
_WORD = re.compile(r"\S+\s*")
_BREAK = re.compile(r"((?<=[.!?。！？])\s+|\n+)")
#: For texts with full-width marks: these, and up to two closing quotation marks behind them, end a sentence without white space too.
_MARK, _CLOSE = "[。！？｡]", "[」』）”’】》]"
_AFTER = f"(?:(?<={_MARK})|(?<={_MARK}{_CLOSE})|(?<={_MARK}{_CLOSE}{{2}}))"
_WIDE = re.compile(rf"((?<=[.!?])\s+|\n+|{_AFTER}\s+|{_AFTER}(?![。！？｡」』）”’】》\s]))")
_MARKS = re.compile(_MARK)
#: Letters of scripts without spaces: Thai, Lao, Myanmar, Khmer, kana, Han. Each counts as a word.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")


def sentences(text: str) -> list[str]:
    """The sentences, long ones in pieces, with the white space after them; joined, they are the text."""
    parts = (_WIDE if _MARKS.search(text) else _BREAK).split(text)
    out = []
    for a, b in zip(parts[::2], [*parts[1::2], ""], strict=True):
        if a.count(" ") < LONG and len(a.split(None, LONG)) <= LONG:
            out.append(a + b)
        else:
            out += _pieces(a + b)
    return [s for s in out if s]


def _pieces(sentence: str) -> list[str]:
    """A long sentence, parted after picked words; where it is parted depends on the words around alone."""
    words = _WORD.findall(sentence)
    out, start, held = [], 0, len(sentence) - sum(map(len, words))
    size = 0
    for w in words:
        held += len(w)
        size += 1
        if size >= PART or zlib.crc32(w.strip().lower().encode()) % PART == 0:
            out.append(sentence[start:held])
            start, size = held, 0
    return [*out, sentence[start:]]


def word_count(words: list[str]) -> int:
    return sum(max(1, len(_UNSPACED.findall(w))) for w in words)


def runs(text: str, least_sentences: int = SENTENCES, least_words: int = LEAST_WORDS) -> tuple[int, list[int], list[int], list[bytes]]:
    """The number of sentences; and the first and last sentence and the hash of each run."""
    digests, counts = [], [0]
    count = word_count if _UNSPACED.search(text) else len
    parts = sentences(text)
    for s in parts:
        words = s.lower().split()
        digests.append(xxhash.xxh3_128_digest(" ".join(words)))
        counts.append(counts[-1] + count(words))
    n = len(parts)
    if n < least_sentences or counts[-1] < least_words:
        return n, [], [], []
    totals = np.array(counts)
    ends = np.maximum(np.searchsorted(totals, totals[:-1] + least_words), np.arange(n) + least_sentences)
    places = [(i, e) for i, e in enumerate(ends.tolist()) if e <= n]
    # a text is a shortest run from its start wherever it stands or nowhere, and so to its end: one that is both has one row
    begins = np.minimum(np.searchsorted(totals, totals[1:] - least_words, side="right") - 1, np.arange(1, n + 1) - least_sentences)
    places = sorted({*places, *((i, e) for e, i in enumerate(begins.tolist(), 1) if i >= 0)})
    joined = b"".join(digests)
    return n, [i for i, _ in places], [e - 1 for _, e in places], [xxhash.xxh3_128_digest(joined[16 * i : 16 * e]) for i, e in places]


def run_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_sentences: int = SENTENCES, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc, n (sentences), first, last, hash of every run."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, sizes, firsts, lasts, hashes = [], [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                n, a, b, h = runs(text or "", least_sentences, least_words)
                index += [i] * len(a)
                sizes += [n] * len(a)
                firsts += a
                lasts += b
                hashes += h
            yield pa.RecordBatch.from_arrays([batch.column("doc").take(pa.array(index, pa.int64())), pa.array(sizes, pa.int32()), pa.array(firsts, pa.int32()), pa.array(lasts, pa.int32()), pa.array(hashes, pa.binary())], names=["doc", "n", "first", "last", "hash"])

    source = docs.select(docs[id_col].alias("doc"), docs[text_col].alias("text"))
    return map_arrow(source, make, f"doc {source.schema['doc'].dataType.simpleString()}, n int, first int, last int, hash binary")


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_sentences: int = SENTENCES, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc, n, first, last, origin, origin_first: each run at a place that isn't its first, and where that is."""
    scratch = Scratch(docs.sparkSession, "spans")
    table = scratch.write(run_table(docs, id_col, text_col, least_sentences, least_words), "runs")
    place = F.struct("doc", "first", "last")
    firsts = table.groupBy("hash").agg(F.min(place).alias("origin"), F.count(F.lit(1)).alias("times")).where("times > 1").select(F.col("hash").alias("same"), "origin")
    firsts = scratch.write(firsts, "firsts")  # so that the join meets two plain exchanges and a hot run can be split
    found = table.join(firsts, F.col("hash") == F.col("same")).where(~place.eqNullSafe(F.col("origin")))
    return found.select("doc", "n", "first", "last", F.col("origin.doc").alias("origin"), F.col("origin.first").alias("origin_first"))


def repeated_sentences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_sentences: int = SENTENCES, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc, n, removed (sorted sentence numbers), origins (sorted ids): each document that loses sentences."""
    found = repeated_runs(docs, id_col, text_col, least_sentences, least_words)
    spans = found.select("doc", "n", "first", "last", "origin").distinct()
    covered = F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.sequence("first", "last")))))
    return spans.groupBy("doc").agg(F.max("n").alias("n"), covered.alias("removed"), F.array_sort(F.collect_set("origin")).alias("origins"))


def remove_repeated_sentences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_sentences: int = SENTENCES, least_words: int = LEAST_WORDS) -> DataFrame:
    """All rows and columns of ``docs``; texts without the sentences that repeat others."""
    of, gone = fresh(docs.columns, "of", "gone")
    found = repeated_sentences(docs, id_col, text_col, least_sentences, least_words).select(F.col("doc").alias(of), F.col("removed").alias(gone))
    joined = docs.join(found, docs[id_col].eqNullSafe(F.col(of)), "left").drop(of)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, last = batch.schema.get_field_index(text_col), batch.num_columns - 1
            texts = []
            for text, removed in zip(batch.column(at).to_pylist(), batch.column(last).to_pylist(), strict=True):
                skip = set(removed or ())
                texts.append("".join(s for i, s in enumerate(sentences(text)) if i not in skip) if skip else text)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(last)], names=batch.schema.names[:last])

    return map_arrow(joined, clean, docs.schema)
