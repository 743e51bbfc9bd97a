"""Toxicity scores by a factorization machine over hashed terms.

*Terms*: the words of a text and the beginnings of its words (4 to 6 letters), lower-cased and hashed into ``BUCKETS``; a text has a term
or not. *Choice*: buckets are counted by label over the training texts, in one distributed sum, and the ``TERMS`` most telling ones (by the
log-likelihood ratio) are kept. *Machine*: a bias, a weight a term and ``FACTORS`` factors a term, whose inner products weigh pairs of terms that
meet in a text, such as an insult and the mention of a group, which weights alone can't. It is fitted on the driver by full-batch
gradient steps with fixed seeds, so results repeat.

The model is fitted on at most ``MOST_LABELLED`` labelled rows (those of least hash of their id; a documented bound on the sample). Everything else covers all
rows; the model that executors get has a fixed size.

Inputs of a score are words alone. Defined cases: null and empty texts have no terms and score the bias; rows with a
null id or label don't train; an id labelled more than once trains with its highest label, an id that stands on several rows with its least
text; repeated rows are scored each; where a table has a column of the score's name
already, the score's has underscores before it; without both labels in
training, every text scores the (smoothed) share of toxic labels. Texts of any length count whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import map_arrow
from .naming import fresh
from .pretoken import chunks, string_bytes
from .scratch import Scratch

BUCKETS, TERMS, FACTORS = 2**20, 2048, 6
#: The sample the model may be fitted on: rows of the label table.
MOST_LABELLED = 30_000
_WORDS = regex.compile(r"[\p{L}\p{N}]+").findall
_PREFIXES = (4, 5, 6)


def _buckets_of(words: pa.Array) -> np.ndarray:
    """The buckets of each distinct word: itself and its beginnings; -1 where a word is too short for one."""
    data, offsets = string_bytes(words)
    raw, cuts = data.tobytes(), offsets.tolist()
    out = np.full((len(words), 1 + len(_PREFIXES)), -1, np.int64)
    texts = words.to_pylist()
    for i, word in enumerate(texts):
        out[i, 0] = zlib.crc32(raw[cuts[i] : cuts[i + 1]]) % BUCKETS
        for j, n in enumerate(_PREFIXES, 1):
            if len(word) < n:
                break
            out[i, j] = zlib.crc32(b"^" + word[:n].encode()) % BUCKETS
    return out


def text_terms(texts: list[str], chosen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of text number and term, distinct and sorted. ``chosen``: each bucket's number or -1; else buckets themselves."""
    words: list[str] = []
    ends = np.zeros(len(texts) + 1, np.int64)
    for i, text in enumerate(texts):
        words += _WORDS(text.lower())
        ends[i + 1] = len(words)
    coded = pa.array(words, pa.large_string()).dictionary_encode()
    terms = _buckets_of(coded.dictionary)
    if chosen is not None:
        terms = np.where(terms >= 0, chosen[terms], -1)
    used = np.nonzero((terms >= 0).any(axis=1))[0]
    numbers = coded.indices.to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(texts)), np.diff(ends))
    keep = np.isin(numbers, used) if len(used) < len(terms) else np.ones(len(numbers), bool)
    rows = np.repeat(owner[keep], terms.shape[1])
    flat = terms[numbers[keep]].reshape(-1)
    both = np.unique(rows[flat >= 0] * BUCKETS + flat[flat >= 0])
    return both // BUCKETS, both % BUCKETS


class FactorizationMachine:
    """score = sigmoid(bias + sum of weights + sum over pairs of <v, v'>), over the terms a text has."""

    def __init__(self, bias: float, weights: np.ndarray, factors: np.ndarray):
        self.bias, self.weights, self.factors = bias, weights, factors

    def logits(self, rows: np.ndarray, terms: np.ndarray, n: int) -> np.ndarray:
        out = self.bias + np.bincount(rows, self.weights[terms], n)
        for f in range(self.factors.shape[1]):
            v = self.factors[terms, f]
            out += 0.5 * (np.bincount(rows, v, n) ** 2 - np.bincount(rows, v * v, n))
        return out

    def scores(self, rows: np.ndarray, terms: np.ndarray, n: int) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(rows, terms, n), -30, 30)))

    @classmethod
    def fit(cls, rows: np.ndarray, terms: np.ndarray, labels: np.ndarray, size: int, factors: int = FACTORS, steps: int = 150, decay: float = 2e-4, pace: float = 0.08) -> FactorizationMachine:
        n, rate = len(labels), (labels.sum() + 0.5) / (len(labels) + 1)
        seeds = np.random.default_rng(11)
        self = cls(float(np.log(rate / (1 - rate))), np.zeros(size), seeds.normal(0, 0.01, (size, factors)))
        if not n or not len(rows) or labels.min() == labels.max():
            self.factors[:] = 0
            return self
        state = [np.zeros((2, size)), np.zeros((2, size, factors)), np.zeros(2)]
        for step in range(1, steps + 1):
            error = (self.scores(rows, terms, n) - labels) / n
            per = error[rows]
            gw = np.bincount(terms, per, size) + decay * self.weights
            gv = np.empty_like(self.factors)
            for f in range(factors):
                v = self.factors[terms, f]
                sums = np.bincount(rows, v, n)
                gv[:, f] = np.bincount(terms, per * (sums[rows] - v), size)
            gv += decay * self.factors
            new = []
            for value, grad, (m, s) in zip((self.weights, self.factors, self.bias), (gw, gv, error.sum()), state, strict=True):
                m = 0.9 * m + 0.1 * grad
                s = 0.99 * s + 0.01 * grad**2
                new.append((value - pace * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8), (m, s)))
            (self.weights, state[0]), (self.factors, state[1]), (self.bias, state[2]) = new
        return self


class Model:
    """The chosen buckets and the machine; its size is fixed by ``TERMS`` and ``BUCKETS``."""

    def __init__(self, chosen: np.ndarray, machine: FactorizationMachine):
        self.chosen, self.machine = chosen, machine

    def score(self, texts: list[str]) -> np.ndarray:
        numbers = np.full(BUCKETS, -1, np.int64)
        numbers[self.chosen] = np.arange(len(self.chosen))
        rows, terms = text_terms(texts, numbers)
        return self.machine.scores(rows, terms, len(texts))


def _training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """text, label of at most ``MOST_LABELLED`` rows; ``labels``: id, label."""
    known = labels.where("id IS NOT NULL AND label IS NOT NULL").groupBy("id").agg(F.max("label").alias("label"))
    sample = known.orderBy(F.xxhash64("id"), "id").limit(MOST_LABELLED)
    # broadcast: two numbers a row, at most MOST_LABELLED rows
    source = docs.select(docs[id_col].alias("doc"), docs[text_col].alias("text"))
    found = source.join(F.broadcast(sample), F.col("doc") == F.col("id"))
    # an id that stands on many rows trains once, with its least text
    return found.groupBy("id").agg(F.min("text").alias("text"), F.first("label").cast("int").alias("label")).select("text", "label")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learns from ``labels`` (id, label 0 or 1) and the texts they name."""
    scratch = Scratch(docs.sparkSession, "toxic")
    train = scratch.write(_training_rows(docs, labels, id_col, text_col), "train")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            texts, marks = [t or "" for t in batch.column(0).to_pylist()], np.array(batch.column(1).to_pylist())
            for a, b in chunks(texts):
                rows, terms = text_terms(texts[a:b])
                for mark in (0, 1):
                    sums[mark] += np.bincount(terms[marks[a:b][rows] == mark], minlength=BUCKETS)
        at = np.nonzero(sums.any(axis=0))[0]
        for part in np.array_split(at, max(1, len(at) // 50_000)):
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(sums[0, part]), pa.array(sums[1, part])], names=["bucket", "n0", "n1"])

    totals = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    t0, t1 = float(totals.get(0, 0)), float(totals.get(1, 0))
    if not t0 or not t1:
        rate = (t1 + 0.5) / (t0 + t1 + 1)
        return Model(np.zeros(0, np.int64), FactorizationMachine(float(np.log(rate / (1 - rate))), np.zeros(0), np.zeros((0, FACTORS))))
    counts = map_arrow(train, count, "bucket long, n0 long, n1 long").groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).where("n0 + n1 >= 5")
    term = lambda n, expected: F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)
    n, whole = F.col("n0") + F.col("n1"), t0 + t1
    gain = term(F.col("n0"), n * t0 / whole) + term(F.col("n1"), n * t1 / whole) + term(t0 - F.col("n0"), (whole - n) * t0 / whole) + term(t1 - F.col("n1"), (whole - n) * t1 / whole)
    best = counts.select("bucket", gain.alias("gain")).where("gain > 8").orderBy(F.desc("gain"), "bucket").limit(TERMS)
    chosen = np.array(sorted(r["bucket"] for r in best.collect()), np.int64)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = np.full(BUCKETS, -1, np.int64)
        numbers[chosen] = np.arange(len(chosen))
        for batch in batches:
            rows, terms = text_terms([t or "" for t in batch.column(0).to_pylist()], numbers)
            ends = np.searchsorted(rows, np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(terms, pa.int32()))], names=["label", "terms"])

    sample = map_arrow(train, pick, "label int, terms array<int>").toArrow()
    lists = sample["terms"].combine_chunks()
    sizes, flat, labels = lists.value_lengths().to_numpy(), lists.flatten().to_numpy().astype(np.int64), sample["label"].to_numpy()
    ends = np.cumsum(sizes)
    texts = [flat[end - size : end] for end, size in zip(ends, sizes, strict=True)]
    # sums repeat in any fixed order of the sample, whichever tasks it came from
    order = sorted(range(len(texts)), key=lambda i: (labels[i], texts[i].tobytes()))
    rows, terms = np.repeat(np.arange(len(order)), sizes[order]), np.concatenate([texts[i] for i in order])
    return Model(chosen, FactorizationMachine.fit(rows, terms, labels[order].astype(float), len(chosen)))


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text: from 0 to 1, higher where a toxic label is likelier."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    (score_col,) = fresh(docs.columns, score_col)
    keep = list(docs.schema)
    at = [f.name for f in keep].index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            scores = np.concatenate([model.score(texts[a:b]) for a, b in chunks(texts)]) if texts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*(f.name for f in keep), score_col])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keep), f"`{score_col}` double"])
    return map_arrow(docs.select(*[docs[f.name] for f in keep]), run, schema)


def drop_toxic(docs: DataFrame, labelled: DataFrame, labels: DataFrame, limit: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score under ``limit``, with all their columns; learns from ``labelled`` texts."""
    (name,) = fresh(docs.columns, "score")
    scored = score(docs, fit(labelled, labels, id_col, text_col), text_col, name)
    return scored.where(F.col(name) < limit).drop(name)
