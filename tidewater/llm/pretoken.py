"""Byte-level BPE vocabularies and the splitting of texts into the words that merges stay within."""

from __future__ import annotations

import functools
import heapq
import json
import unicodedata
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex

#: The pattern where both sides' Unicode tables agree, and the same with classes to fill in.
PLAIN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?{L}+| ?{N}+| ?[^\s{l}{n}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies: bytes that print stand for themselves, the others follow from 256 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.cache
def split_pattern(path: str) -> tuple[str, frozenset[str]]:
    """The library's splitting pattern with its own Unicode tables, and the characters for which it isn't ``PLAIN``.

    Code points whose class differs between this Python's two Unicode tables are put to the library itself.
    """
    from tokenizers import Tokenizer

    cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    classes = {"L": regex.compile(r"\p{L}"), "N": regex.compile(r"\p{N}")}
    wrong: dict[str, list[list[str]]] = {"L": [[], []], "N": [[], []]}
    for point in range(0x80, 0x110000):
        if 0xD800 <= point < 0xE000:
            continue
        char = chr(point)
        kind = unicodedata.category(char)
        mine = "L" if classes["L"].match(char) else "N" if classes["N"].match(char) else ""
        if mine == (kind[0] if kind[0] in "LN" else "") and kind != "Cn":
            continue
        if not mine and kind == "Cn":
            continue
        theirs = "L" if len(cut("a" + char)) == 1 else "N" if len(cut("1" + char)) == 1 else ""
        if mine != theirs:
            if mine:
                wrong[mine][0].append(char)
            if theirs:
                wrong[theirs][1].append(char)
    parts = {}
    for k, (out, more) in wrong.items():
        out_set, more_set = "".join(map(regex.escape, out)), "".join(map(regex.escape, more))
        parts[k] = rf"[[\p{{{k}}}{more_set}]--[{out_set}]]" if out else rf"[\p{{{k}}}{more_set}]"
    odd = frozenset(c for lists in wrong.values() for chars in lists for c in chars)
    return SPLIT.replace("{L}", parts["L"]).replace("{N}", parts["N"]).replace("[^\\s{l}{n}]", rf"[^\s{parts['L']}{parts['N']}]"), odd


class Vocabulary:
    """A byte-level BPE vocabulary read from a tokenizers file; small enough to broadcast (bounded by the file)."""

    #: Longer words are merged one by one.
    WIDEST = 48

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, ids = _byte_letters(), spec["model"]["vocab"]
        size = max([*ids.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens: list[bytes] = [b""] * size
        for token, i in ids.items():
            self.tokens[i] = bytes(letters[c] for c in token) if token not in self.special else token.encode()
        for token, i in self.special.items():
            self.tokens[i] = token.encode()
        #: The rank of each pair that can be joined, by left * 2 ** 32 + right; and by rank the id it becomes.
        self.ranks: dict[int, int] = {}
        self.joined: list[int] = []
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[ids[a] << 32 | ids[b]] = rank
            self.joined.append(ids[a + b])
        self.single = [ids[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        self.pattern, self.odd = split_pattern(path)

    def merge(self, word: bytes) -> list[int]:
        """The ids of one word: the pair of least rank, leftmost first, is joined until none is left."""
        ids = [self.single[b] for b in word]
        if len(ids) > self.WIDEST:
            return self._merge_long(ids)
        rank, joined, none = self.ranks.get, self.joined, len(self.joined)
        ranks = [rank(a << 32 | b, none) for a, b in zip(ids, ids[1:], strict=False)]
        while ranks:
            least = min(ranks)
            if least == none:
                break
            i = ranks.index(least)
            ids[i : i + 2] = [joined[least]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank(ids[i - 1] << 32 | ids[i], none)
            if i < len(ranks):
                ranks[i] = rank(ids[i] << 32 | ids[i + 1], none)
        return ids

    @functools.cached_property
    def _tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """As arrays: the id of each byte; the rank of each pair of bytes; all pairs, sorted, and their ranks."""
        single = np.array(self.single, np.int64)
        keys = np.fromiter(self.ranks, np.int64, len(self.ranks))
        order = np.argsort(keys)
        pairs, ranks = keys[order], np.fromiter(self.ranks.values(), np.int32, len(keys))[order]
        return single.astype(np.int32), self._ranks_of(pairs, ranks, np.repeat(single, 256), np.tile(single, 256)).reshape(256, 256), pairs, ranks

    def _ranks_of(self, pairs: np.ndarray, ranks: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids; of those that can't be joined, the number of ranks."""
        if not len(pairs):
            return np.zeros(len(left), np.int32)
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)
        return np.where(pairs[at] == key, ranks[at], np.int32(len(self.joined)))

    def merge_many(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words data[start : start + length], one after the other, and how many each has.

        Each step joins in every word its pair of least rank, the leftmost of equals, as ``merge`` does. Special strings become their ids.
        """
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # words, their ids in rows, how many are ids
        plain = np.ones(len(starts), bool)
        for text, i in self.special.items():
            raw = np.frombuffer(text.encode(), np.uint8)
            same = np.nonzero(lengths == len(raw))[0]
            same = same[(data[starts[same][:, None] + np.arange(len(raw))] == raw).all(axis=1)]
            plain[same] = False
            done.append((same, np.full((len(same), 1), i, np.int32), np.ones(len(same), np.int64)))
        for i in np.nonzero(plain & (lengths > self.WIDEST))[0].tolist():
            ids = np.array([self.merge(data[starts[i] : starts[i] + lengths[i]].tobytes())], np.int32)
            done.append((np.array([i]), ids, np.array([ids.shape[1]])))
        for least, most in ((-1, 6), (6, 10), (10, 16), (16, 28), (28, self.WIDEST)):
            words = np.nonzero(plain & (lengths > least) & (lengths <= most))[0]
            if len(words):
                self._merge_rows(data, starts[words], lengths[words], words, done)
        counts = np.zeros(len(starts), np.int64)
        for words, _, sizes in done:
            counts[words] = sizes
        ends = np.cumsum(counts)
        out = np.zeros(int(ends[-1]) if len(ends) else 0, np.int32)
        for words, rows, sizes in done:
            at = np.arange(rows.shape[1])
            real = at < sizes[:, None]
            out[((ends - counts)[words][:, None] + at)[real]] = rows[real]
        return out, counts

    def _merge_rows(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, words: np.ndarray, done: list) -> None:
        single, of_bytes, pairs, of_pairs = self._tables
        joined, none = np.array(self.joined, np.int32), np.int32(len(self.joined))
        width = max(int(lengths.max()), 1)
        at = np.arange(width + 1)
        raw = data[np.minimum(starts[:, None] + at, max(len(data) - 1, 0))] if len(data) else np.zeros((len(words), width + 1), np.uint8)
        ids = np.where(at < lengths[:, None], single[raw], np.int32(-1))
        ranks = np.where(at[1:] < lengths[:, None], of_bytes[raw[:, :-1], raw[:, 1:]], none)
        ranks = np.concatenate([ranks, np.full((len(words), 1), none, np.int32)], axis=1)
        while len(words):
            best = ranks.argmin(axis=1)
            row = np.arange(len(words))
            least = ranks[row, best]
            live = least < none
            if not live.all():
                out = ~live
                done.append((words[out], ids[out], lengths[out]))
                words, ids, ranks, lengths, best, least = words[live], ids[live], ranks[live], lengths[live], best[live], least[live]
                row = row[: len(words)]
                if not len(words):
                    return
            after = np.minimum(at + (at > best[:, None]), width)
            ids = np.take_along_axis(ids, after, axis=1)
            ranks = np.take_along_axis(ranks, np.minimum(at + (at >= best[:, None]), width), axis=1)
            lengths = lengths - 1
            ids[row, best] = joined[least]
            inner = best > 0
            ranks[row[inner], best[inner] - 1] = self._ranks_of(pairs, of_pairs, ids[row[inner], best[inner] - 1], ids[row[inner], best[inner]])
            inner = best < lengths - 1
            ranks[row[inner], best[inner]] = self._ranks_of(pairs, of_pairs, ids[row[inner], best[inner]], ids[row[inner], best[inner] + 1])

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap and links: n log n, for words of any length."""
        n = len(ids)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        rank = self.ranks.get
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            least, i, a, b = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if not alive[i] or j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j], after[i] = self.joined[least], False, after[j]
            if after[i] < n:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (r := rank(ids[left] << 32 | ids[right])) is not None:
                    heapq.heappush(heap, (r, left, ids[left], ids[right]))
        return [x for x, keep in zip(ids, alive, strict=True) if keep]


class Splitter:
    """Cuts texts into words; special strings are words of their own."""

    def __init__(self, vocabulary: Vocabulary):
        special = vocabulary.special
        self.plain, self.odd = regex.compile(PLAIN).findall, vocabulary.odd
        self.exact = regex.compile(vocabulary.pattern, regex.V1).findall
        self.special = sorted(special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split if self.special else None

    def find(self, text: str) -> list[str]:
        return self.plain(text) if text.isascii() or self.odd.isdisjoint(text) else self.exact(text)

    def words(self, text: str) -> list[str]:
        if self.cut and any(s in text for s in self.special):
            return [w for i, part in enumerate(self.cut(text)) for w in ([part] if i % 2 else self.find(part))]
        return self.find(text)


def chunks(texts: list[str], most: int = 500_000):
    """Slices (from, to) of about ``most`` characters; a text is never cut."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def distinct_words(splitter: Splitter, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For a chunk: each text's end in words, each word's number, and the distinct words as bytes and offsets."""
    words: list[str] = []
    ends = np.zeros(len(texts) + 1, np.int64)
    for i, t in enumerate(texts):
        words += splitter.words(t)
        ends[i + 1] = len(words)
    coded = pa.array(words, pa.large_string()).dictionary_encode()
    del words
    numbers = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return ends, numbers, *string_bytes(coded.dictionary)


def string_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and offsets of a large_string array."""
    _, offsets, data = array.buffers()
    off = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1] if len(array) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), off


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs values[start : start + length], one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]
