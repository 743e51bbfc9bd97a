"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

*Lexicon*: frequent words, each at least ``MIN_SHARE`` of all words (so at most 1/``MIN_SHARE`` of them, whatever the corpus),
are counted over all texts and compiled into a minimal automaton whose arcs carry numbers: the sum along a word's path
is its index into a table of id sequences. Words share prefixes and suffixes, so the automaton is small. It is broadcast, so Spark
puts one file of it on each host, and removes it; the workers of the host all map that file into memory, read-only, and none loads a copy.

*Encoding*: the distinct words of a chunk of texts walk the automaton together, one array step for each byte. Words it
doesn't hold are merged exactly, pair by pair in rank order, all words of a chunk together. *Decoding* joins the bytes of the ids.

Defined cases: null counts as the empty text, which has no ids; special strings inside texts get their special ids, as
the library does; texts of any length are cut only between words. Unknown ids can't be decoded and raise. Repeated rows and null
ids are rows like any other; where a table has a column of the
name of the result's own column already, the result's has underscores before it, so none is lost.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrow import kept, map_arrow
from .naming import fresh
from .pretoken import Splitter, Vocabulary, chunks, distinct_words, gather
from .scratch import Scratch

#: A word is in the lexicon if it makes up this share of all words: at most 400,000 words.
MIN_SHARE = 2.5e-6
#: Longer words are left to merging.
MAX_WORD_BYTES = 32
#: Partial counts a task holds; beyond, they are passed on. Bounds memory, never results.
HELD_COUNTS = 200_000
#: Stands at the start of a lexicon's bytes.
MAGIC = b"tidewater lexicon"


class Lexicon:
    """Minimal acyclic transducer from words (bytes) to id sequences, in flat arrays."""

    FIELDS = (("arc", np.int64), ("to", np.int32), ("number", np.int32), ("final", np.uint8), ("first", np.int64), ("ids", np.int32))

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.__dict__.update(arrays)

    @classmethod
    def build(cls, words: Iterable[bytes], encode) -> Lexicon:
        """Adds the sorted words one by one and merges equal suffixes as soon as they can't change any more."""
        words = sorted(set(words))
        finals: list[bool] = [False]
        arcs: list[dict[int, int]] = [{}]
        known: dict[tuple, int] = {}
        path: list[tuple[int, int, int]] = []  # (state, byte, child) along the last word

        def settle(depth: int) -> None:
            while len(path) > depth:
                state, byte, child = path.pop()
                same = known.setdefault((finals[child], tuple(arcs[child].items())), child)
                arcs[state][byte] = same

        last = b""
        for word in words:
            common = 0
            while common < min(len(last), len(word)) and last[common] == word[common]:
                common += 1
            settle(common)
            state = path[-1][2] if path else 0
            for byte in word[common:]:
                finals.append(False)
                arcs.append({})
                child = len(arcs) - 1
                arcs[state][byte] = child
                path.append((state, byte, child))
                state = child
            finals[state] = True
            last = word
        settle(0)

        order, number, stack = [], {}, [0]
        seen = {0}
        while stack:  # states reached, children after parents
            s = stack.pop()
            order.append(s)
            for t in arcs[s].values():
                if t not in seen:
                    seen.add(t)
                    stack.append(t)
        below: dict[int, int] = {}

        def count(s: int) -> int:
            todo = [s]
            while todo:
                x = todo[-1]
                wait = [t for t in arcs[x].values() if t not in below]
                if wait:
                    todo += wait
                else:
                    below[x] = finals[x] + sum(below[t] for t in arcs[x].values())
                    todo.pop()
            return below[s]

        count(0)
        number = {s: i for i, s in enumerate(order)}
        key, to, num = [], [], []
        for s in order:
            passed = int(finals[s])
            for byte in sorted(arcs[s]):
                key.append(number[s] * 256 + byte)
                to.append(number[arcs[s][byte]])
                num.append(passed)
                passed += below[arcs[s][byte]]
        encoded = [encode(w) for w in words]
        first = np.zeros(len(words) + 1, np.int64)
        np.cumsum([len(e) for e in encoded], out=first[1:])
        return cls({
            "arc": np.array(key, np.int64), "to": np.array(to, np.int32), "number": np.array(num, np.int32),
            "final": np.array([finals[s] for s in order], np.uint8), "first": first, "ids": np.array([i for e in encoded for i in e], np.int32),
        })

    def blob(self) -> bytes:
        """All arrays; padded so that they stand at multiples of 8 in the file of a broadcast of these bytes."""
        parts = [np.ascontiguousarray(getattr(self, n), t) for n, t in self.FIELDS]
        sizes = np.array([len(p) for p in parts], np.int64).tobytes()
        body = sizes + b"".join(p.tobytes() + b"\0" * (-p.nbytes % 8) for p in parts)
        ahead = pickle.dumps(MAGIC + bytes(8) + body, pickle.HIGHEST_PROTOCOL)[:64].find(MAGIC) + len(MAGIC) + 1
        return MAGIC + bytes([-ahead % 8]) + bytes(-ahead % 8) + body

    @classmethod
    def opened(cls, data: np.ndarray) -> Lexicon:
        """A lexicon on bytes that hold a blob, mapped or not."""
        at = data[:64].tobytes().find(MAGIC) + len(MAGIC)
        at += 1 + int(data[at])
        sizes, arrays = data[at : at + 8 * len(cls.FIELDS)].view(np.int64), {}
        at += 8 * len(cls.FIELDS)
        for (name, kind), n in zip(cls.FIELDS, sizes, strict=True):
            nbytes = int(n) * np.dtype(kind).itemsize
            arrays[name] = data[at : at + nbytes].view(kind)
            at += nbytes + -nbytes % 8
        return cls(arrays)

    @classmethod
    def mapped(cls, shared: Broadcast) -> Lexicon:
        """Maps the broadcast's own file of this host; where there is none to read (encrypted broadcasts), takes its value."""
        path = getattr(shared, "_path", None)
        if path:
            data = np.memmap(path, np.uint8, "r")
            if data[:64].tobytes().find(MAGIC) >= 0:
                return cls.opened(data)
        return cls.opened(np.frombuffer(shared.value, np.uint8))

    def find(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The index of each word data[offsets[i] : offsets[i + 1]], -1 where the lexicon has it not."""
        lengths = np.diff(offsets)
        found = np.full(len(lengths), -1, np.int64)
        if not len(self.arc):
            return found
        at = np.nonzero(lengths <= MAX_WORD_BYTES)[0]
        state, total = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        arc, to, number, final = map(np.asarray, (self.arc, self.to, self.number, self.final))
        for j in range(MAX_WORD_BYTES + 1):
            done = lengths[at] == j
            ends = at[done]
            found[ends] = np.where(final[state[done]] == 1, total[done], -1)
            at, state, total = at[~done], state[~done], total[~done]
            if not len(at):
                break
            key = state * 256 + data[offsets[at] + j]
            place = np.minimum(np.searchsorted(arc, key), len(arc) - 1)
            ok = arc[place] == key
            at, place = at[ok], place[ok]
            state, total = to[place].astype(np.int64), total[ok] + number[place]
        return found


class Encoder:
    """Texts to ids and back."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.splitter = Splitter(vocabulary)
        self.token_bytes = np.frombuffer(b"".join(vocabulary.tokens), np.uint8)
        self.token_lengths = np.array([len(t) for t in vocabulary.tokens], np.int64)
        self.token_starts = np.cumsum(self.token_lengths) - self.token_lengths

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and each text's end."""
        ends, numbers, data, offsets = distinct_words(self.splitter, texts)
        found = self.lexicon.find(data, offsets)
        first, ids = np.asarray(self.lexicon.first), np.asarray(self.lexicon.ids)
        new = np.nonzero(found < 0)[0]
        merged, sizes = self.vocabulary.merge_many(data, offsets[new], np.diff(offsets)[new])
        known = np.maximum(found, 0)
        starts = first[known]
        lengths = (first[known + 1] if len(first) > 1 else starts) - starts
        lengths[new] = sizes
        starts[new] = len(ids) + np.cumsum(sizes) - sizes
        table = np.concatenate([ids, merged])
        lengths_in_order = lengths[numbers]
        out = gather(table, starts[numbers], lengths_in_order)
        sums = np.concatenate([[0], np.cumsum(lengths_in_order)])
        return out, sums[ends]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of id runs ids[ends[i] : ends[i + 1]]; bytes that aren't UTF-8 become replacement characters."""
        lengths = self.token_lengths[ids]
        raw = gather(self.token_bytes, self.token_starts[ids], lengths).tobytes()
        cuts = np.concatenate([[0], np.cumsum(lengths)])[ends].tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:], strict=False)]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """word, n: space-led words of letters, and how many words there are in all (under the empty word), for each part of the input.

    A task passes on what it holds whenever that is ``HELD_COUNTS`` words, so a word may come more than once.
    """
    held: list[pa.Table] = []

    def merged() -> pa.Table:
        t = pa.concat_tables(held).group_by("word").aggregate([("n", "sum")])
        return pa.table({"word": t["word"], "n": t["n_sum"]})

    for batch in batches:
        texts = batch.column(0).cast(pa.large_string())
        for a in range(0, len(texts), 512):
            words = pc.list_flatten(pc.split_pattern(pc.fill_null(texts[a : a + 512], ""), " "))
            counts = pc.value_counts(words)
            words, n = counts.field(0), counts.field(1)
            total = pa.table({"word": pa.array([""], pa.large_string()), "n": pa.array([pc.sum(n).as_py() or 0], pa.int64())})
            keep = pc.and_(pc.match_substring_regex(words, r"^[\p{L}]+$"), pc.less(pc.binary_length(words), MAX_WORD_BYTES))
            held += [total, pa.table({"word": words.filter(keep), "n": n.filter(keep)})]
            if sum(t.num_rows for t in held) > HELD_COUNTS:
                held = [merged()]
                if held[0].num_rows > HELD_COUNTS // 2:
                    yield from held.pop().to_batches(100_000)
    if held:
        yield from merged().to_batches(100_000)


def frequent_words(docs: DataFrame, text_col: str = "text", min_share: float = MIN_SHARE) -> list[str]:
    """Words of at least ``min_share`` of all words, counted over every whole text; at most 1/``min_share`` of them."""
    scratch = Scratch(docs.sparkSession, "words")
    counts = map_arrow(docs.select(docs[text_col]), _count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = scratch.write(counts.where("n > 1 OR word = ''"), "counts")  # written: a lost executor costs no count
    words = counts.where("word = ''").agg(F.max("n").alias("n")).first()["n"] or 0
    found = [r["word"] for r in counts.where((F.col("n") >= max(2, words * min_share)) & (F.col("word") != "")).select("word").collect()]
    scratch.drop()
    return found


class Codec:
    """What executors need to encode and decode: the vocabulary, which each worker opens once, and the lexicon, which all workers of a host share."""

    def __init__(self, spark: SparkSession, path: str, words: Iterable[str]):
        vocabulary = Vocabulary(path)
        # the words stand after a space most of the time; the form at the start of a text or line is frequent too
        lexicon = Lexicon.build([f for w in words for f in (b" " + w.encode(), w.encode())] + [t for t in vocabulary.tokens[: len(vocabulary.tokens)] if self._whole(vocabulary, t)], vocabulary.merge)
        blob = lexicon.blob()
        self.key = hashlib.sha256(blob + path.encode()).hexdigest()
        self.shared, self.lexicon = spark.sparkContext.broadcast(vocabulary), spark.sparkContext.broadcast(blob)

    @staticmethod
    def _whole(vocabulary: Vocabulary, token: bytes) -> bool:
        """Whether a token is a word by itself that the lexicon may hold: marks and digits, which the corpus count leaves out."""
        return 0 < len(token) <= 8 and token.isascii() and not token.strip().isalpha()

    def encoder(self) -> Encoder:
        return kept(self.key, lambda: Encoder(self.shared.value, Lexicon.mapped(self.lexicon)))

    def __getstate__(self) -> dict:
        return {"key": self.key, "shared": self.shared, "lexicon": self.lexicon}


def _texts(batch: pa.RecordBatch, column: str) -> list[str]:
    return [t or "" for t in batch.column(column).to_pylist()]


def encode(docs: DataFrame, path: str, codec: Codec | None = None, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` without the text, with its ids as array<int>."""
    (ids_col,) = fresh(docs.columns, ids_col)
    codec = codec or Codec(docs.sparkSession, path, frequent_words(docs, text_col))
    keep = [c for c in docs.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = codec.encoder()
        for batch in batches:
            texts = _texts(batch, text_col)
            for a, b in chunks(texts):
                ids, ends = encoder.encode(texts[a:b])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in keep), lists], names=[*keep, ids_col])

    source = docs.select(*[docs[c] for c in keep], docs[text_col])
    return map_arrow(source, run, _schema(source, keep, f"`{ids_col}` array<int>"), keeps=True)


def decode(encoded: DataFrame, codec: Codec, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``encoded`` without the ids, with their text; null ids count as none."""
    (text_col,) = fresh(encoded.columns, text_col)
    keep = [c for c in encoded.columns if c != ids_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = codec.encoder()
        for batch in batches:
            runs = [np.array(x or [], np.int64) for x in batch.column(ids_col).to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int64)
            texts = encoder.decode(np.concatenate(runs) if runs else np.zeros(0, np.int64), ends)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(texts, pa.string())], names=[*keep, text_col])

    source = encoded.select(*[encoded[c] for c in keep], encoded[ids_col])
    return map_arrow(source, run, _schema(source, keep, f"`{text_col}` string"), keeps=True)


def _schema(df: DataFrame, keep: list[str], more: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in keep), more])


def round_trip_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit), decoded_sha256: encodes, decodes and digests in one pass."""
    codec = Codec(docs.sparkSession, path, frequent_words(docs, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = codec.encoder()
        for batch in batches:
            texts = _texts(batch, "text")
            for a, b in chunks(texts):
                ids, ends = encoder.encode(texts[a:b])
                flat, cuts = ids.astype("<u4").tobytes(), ends.tolist()
                of_ids = [hashlib.sha256(flat[4 * x : 4 * y]).hexdigest() for x, y in zip(cuts, cuts[1:], strict=False)]
                of_text = [hashlib.sha256(t.encode()).hexdigest() for t in encoder.decode(ids, ends)]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(a, b - a), pa.array(np.diff(ends), pa.int64()), pa.array(of_ids), pa.array(of_text)], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    source = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return map_arrow(source, run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string", keeps=True).withColumnRenamed("id", id_col)
