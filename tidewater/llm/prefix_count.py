"""Token counts of every prefix by dynamic programming, without encoding a prefix again.

A sequence of BPE tokens is the encoding of its bytes exactly if each two neighbours, encoded together, stay as they
are. So the encoding of a word's prefix is the encoding of a shorter prefix plus one last token, and that token is the
only vocabulary suffix that fits what the shorter prefix ends with: one step for each byte gives the last token and the
count of every prefix. Words are counted once a worker; a text's prefix counts are its words' counts, carried on.

A prefix can end where the splitting of the text would go differently: in white space, after ``'r``, ``'v`` or ``'l``, in a special
string. ``PrefixCounter.prefixes`` counts these tails as the library would, so each entry equals the count of the cut text.

Defined cases: null counts as empty (0 bytes, 0 tokens); the empty prefix has 0 tokens; texts of any length are counted
whole. Special strings inside texts count 1, as the library does. Repeated rows and null ids are rows like any other; where a table
has a column of the name of the result's own column already, the result's has underscores before it, so none is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import kept, map_arrow
from .bpe import _schema, _texts
from .naming import fresh
from .pretoken import Splitter, Vocabulary, chunks, distinct_words

#: Words whose counts a worker remembers; beyond, it starts afresh. Bounds memory, never results.
REMEMBERED = 400_000
#: Pairs of tokens whose fit a worker remembers; beyond, it starts afresh.
REMEMBERED_FITS = 700_000


class PrefixCounter:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.splitter = vocabulary, Splitter(vocabulary)
        special = set(vocabulary.special.values())
        self.ids = {t: i for i, t in enumerate(vocabulary.tokens) if t and i not in special}
        self.longest = max(map(len, self.ids))
        self.special = {s.encode() for s in vocabulary.special}
        self.fits: dict[tuple[int, int], bool] = {}
        self.totals: dict[bytes, int] = {}
        self.alone = {i: vocabulary.merge(t) == [i] for t, i in self.ids.items()}

    def _fit(self, left: int, right: int) -> bool:
        """Whether two tokens can stand side by side."""
        found = self.fits.get((left, right))
        if found is None:
            tokens = self.vocabulary.tokens
            found = self.vocabulary.merge(tokens[left] + tokens[right]) == [left, right]
            if len(self.fits) >= REMEMBERED_FITS:
                self.fits.clear()
            self.fits[left, right] = found
        return found

    def word(self, word: bytes) -> list[int]:
        """The token count of each of the word's prefixes, the empty one included."""
        if word in self.special:
            return [0] * len(word) + [1]
        n, ids, alone, fits = len(word), self.ids, self.alone, self.fits
        counts, last = [0] * (n + 1), [-1] * (n + 1)
        for end in range(1, n + 1):
            for start in range(max(0, end - self.longest), end):
                token = ids.get(word[start:end])
                if token is None or not alone[token]:
                    continue
                if start:
                    left = last[start]
                    ok = fits.get((left, token))
                    if not (self._fit(left, token) if ok is None else ok):
                        continue
                counts[end], last[end] = counts[start] + 1, token
                break
        return counts

    def word_total(self, word: bytes) -> int:
        found = self.totals.get(word)
        if found is None:
            if len(self.totals) >= REMEMBERED:
                self.totals.clear()
            found = self.totals[word] = self.word(word)[-1]
        return found

    def counts(self, texts: list[str]) -> np.ndarray:
        """The count of each whole text: its last prefix."""
        ends, numbers, data, offsets = distinct_words(self.splitter, texts)
        raw, cuts, total = data.tobytes(), offsets.tolist(), self.word_total
        each = np.array([total(raw[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)], np.int64)
        sums = np.concatenate([[0], np.cumsum(each[numbers])]) if len(numbers) else np.zeros(1, np.int64)
        return np.diff(sums[ends])

    def prefixes(self, text: str) -> np.ndarray:
        """The exact count of text[:n] for each n from 0 to its length."""
        out = np.zeros(len(text) + 1, np.int64)
        at = before = floor = 0
        for word in self.splitter.words(text):
            raw = word.encode()
            counts, place = self.word(raw), 0
            for i, char in enumerate(word, 1):
                place += len(char.encode())
                out[at + i] = before + counts[place]
            if raw in self.special or (len(word) > 2 and word[0] == "'" and word[1:3] in ("re", "ve", "ll")):
                self._cut_tails(text, out, floor, at, at + len(word))
            at += len(word)
            floor = at if raw in self.special else floor
            before += counts[-1]
        self._blank_tails(text, out)
        return out

    def _cut_tails(self, text: str, out: np.ndarray, floor: int, start: int, end: int) -> None:
        """Prefixes that end inside a special string or contraction are split as they stand, from the run of marks and blanks before on.

        The run doesn't reach before ``floor``, where the last whole special string ends.
        """
        back = start
        while back > floor and not text[back - 1].isalnum():
            back -= 1
        for n in range(start + 1, end):
            tail = text[back:n]
            out[n] = out[back] + sum(self.word_total(w.encode()) for w in self.splitter.words(tail))

    def _blank_tails(self, text: str, out: np.ndarray) -> None:
        """A prefix that ends in white space ends in one word of all of it."""
        start = 0
        while start < len(text):
            if not self._blank(text[start]):
                start += 1
                continue
            end = start
            while end < len(text) and self._blank(text[end]):
                end += 1
            counts, place = self.word(text[start:end].encode()), 0
            for n in range(start + 1, end + 1):
                place += len(text[n - 1].encode())
                out[n] = out[start] + counts[place]
            start = end

    def _blank(self, char: str) -> bool:
        return char.isspace() and not "\x1c" <= char <= "\x1f"

    def truncated(self, text: str, budget: int) -> int:
        """The longest prefix, in characters, of at most ``budget`` tokens."""
        return int(np.nonzero(self.prefixes(text) <= budget)[0][-1]) if budget >= 0 else 0


class _Shared:
    """Broadcasts the vocabulary (bounded by its file) and opens one counter a worker."""

    def __init__(self, spark, path: str):
        self.path, self.shared = path, spark.sparkContext.broadcast(Vocabulary(path))

    def counter(self) -> PrefixCounter:
        return kept(f"counts {self.path}", lambda: PrefixCounter(self.shared.value))


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_tokens of every whole text."""
    shared = _Shared(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = shared.counter()
        for batch in batches:
            texts = _texts(batch, "text")
            for a, b in chunks(texts):
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in ("id", "n_bytes")), pa.array(counter.counts(texts[a:b]), pa.int64())], names=["id", "n_bytes", "n_tokens"])

    size = F.coalesce(F.octet_length(docs[text_col]), F.lit(0)).cast("long")
    source = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), size.alias("n_bytes"))
    return map_arrow(source, run, _schema(source, ["id"], "n_bytes long, n_tokens long"), keeps=True).withColumnRenamed("id", id_col)


def prefix_counts(docs: DataFrame, path: str, text_col: str = "text", counts_col: str = "prefix_tokens") -> DataFrame:
    """``docs`` with the array of exact counts of every prefix, by characters from 0 on."""
    (counts_col,) = fresh(docs.columns, counts_col)
    return _with_counter(docs, path, text_col, f"`{counts_col}` array<int>", counts_col, lambda c, t: pa.array(c.prefixes(t).tolist(), pa.int32()).to_pylist(), pa.list_(pa.int32()))


def truncate(docs: DataFrame, path: str, budget: int, text_col: str = "text", cut_col: str = "cut") -> DataFrame:
    """``docs`` with the longest prefix of each text that has at most ``budget`` tokens."""
    (cut_col,) = fresh(docs.columns, cut_col)
    return _with_counter(docs, path, text_col, f"`{cut_col}` string", cut_col, lambda c, t: t[: c.truncated(t, budget)], pa.string())


def _with_counter(docs: DataFrame, path: str, text_col: str, field: str, name: str, of, kind: pa.DataType) -> DataFrame:
    shared = _Shared(docs.sparkSession, path)
    keep = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = shared.counter()
        for batch in batches:
            made = pa.array([of(counter, t) for t in _texts(batch, text_col)], kind)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), made], names=[*keep, name])

    source = docs.select(*[docs[c] for c in keep])
    return map_arrow(source, run, _schema(source, keep, field), keeps=True)
