import hashlib

import numpy as np
import pytest
from tidewater.llm import bpe
from tidewater.llm.pretoken import Vocabulary
from tidewater.llm.queries import tokenizer_path
from tokenizers import Tokenizer

from .conftest import AWKWARD


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(tokenizer_path())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def test_lexicon_holds_its_words_only():
    words = [b"nation", b"station", b"stations", b"ration", b"a", b""]
    lexicon = bpe.Lexicon.build(words, lambda w: list(w))
    asked = sorted(words) + [b"stat", b"nations", b"b", b"x" * 99]
    data = np.frombuffer(b"".join(asked), np.uint8)
    found = bpe.Lexicon.opened(np.frombuffer(lexicon.blob(), np.uint8)).find(data, np.concatenate([[0], np.cumsum([len(w) for w in asked])]))
    assert found.tolist() == [0, 1, 2, 3, 4, 5, -1, -1, -1, -1]
    assert [list(lexicon.ids[lexicon.first[i] : lexicon.first[i + 1]]) for i in range(6)] == [list(w) for w in sorted(words)]
    assert len(lexicon.arc) < sum(map(len, words)) - 8  # "ation" is shared


def test_empty_lexicon_merges_everything(vocabulary, library):
    encoder = bpe.Encoder(vocabulary, bpe.Lexicon.build([], vocabulary.merge))
    ids, ends = encoder.encode(["hello world", ""])
    assert ids[: ends[1]].tolist() == library.encode("hello world", add_special_tokens=False).ids and ends[1] == ends[2]


def test_round_trip_equals_library(spark, awkward, library):
    got = {r["doc_id"]: r for r in bpe.round_trip_digests(awkward, tokenizer_path()).collect()}
    assert len(got) == len(AWKWARD)
    for i, text in AWKWARD.items():
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_encode_and_decode_frames(spark, awkward):
    codec = bpe.Codec(spark, tokenizer_path(), bpe.frequent_words(awkward))
    encoded = bpe.encode(awkward.withColumnRenamed("source", "ids "), tokenizer_path(), codec)
    assert encoded.columns == ["doc_id", "lang", "ids ", "n_chars", "ids"]
    back = {r["doc_id"]: r["text"] for r in bpe.decode(encoded, codec).collect()}
    assert back == {i: t or "" for i, t in AWKWARD.items()}


def test_clashing_names_repeated_rows_and_null_ids(spark):
    codec = bpe.Codec(spark, tokenizer_path(), ["word"])
    docs = spark.createDataFrame([(None, "a word", 7), (None, "a word", 7), (1, None, 8)], "doc_id long, text string, IDS int")
    encoded = bpe.encode(docs, tokenizer_path(), codec)
    assert encoded.columns == ["doc_id", "IDS", "_ids"]
    back = bpe.decode(encoded.withColumnRenamed("IDS", "Text"), codec, "_ids")
    assert back.columns == ["doc_id", "Text", "_text"]
    assert sorted((r["doc_id"] or 0, r["Text"], r["_text"]) for r in back.collect()) == [(0, 7, "a word"), (0, 7, "a word"), (1, 8, "")]
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in bpe.round_trip_digests(docs, tokenizer_path()).collect()) == [(0, 2), (0, 2), (1, 0)]


def test_lexicon_is_mapped_from_the_broadcast_file(spark):
    lexicon = bpe.Lexicon.build([b"nation", b"station"], lambda w: list(w) * 9)
    shared = spark.sparkContext.broadcast(lexicon.blob())

    def look(_):
        mine = bpe.Lexicon.mapped(shared)
        base = mine.ids
        while getattr(base, "base", None) is not None and not isinstance(base, np.memmap):
            base = base.base
        yield isinstance(mine.ids, np.memmap), mine.arc.flags.aligned, mine.ids.tolist() == lexicon.ids.tolist(), hasattr(shared, "_value")

    assert spark.sparkContext.parallelize([0], 1).mapPartitions(look).collect() == [(True, True, True, False)]


def test_words_merged_together_are_merged_as_one_by_one(vocabulary):
    pick = np.random.default_rng(2)
    letters = ["e", "t", "th", "ing", "é", "中", " ", "0", "x", "\n", "😀"]
    words = ["", "a", "<|endoftext|>", "<|endoftext", "z" * 49, "ab" * 300] + ["".join(pick.choice(letters, pick.integers(1, 40))) for _ in range(800)]
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(w) for w in raw])
    ids, counts = vocabulary.merge_many(np.frombuffer(b"".join(raw), np.uint8), ends - [len(w) for w in raw], np.array([len(w) for w in raw]))
    cuts = np.concatenate([[0], np.cumsum(counts)])
    for i, w in enumerate(words):
        want = [vocabulary.special[w]] if w in vocabulary.special else vocabulary.merge(raw[i])
        assert ids[cuts[i] : cuts[i + 1]].tolist() == want, w


def test_empty_table(spark, awkward):
    assert bpe.round_trip_digests(awkward.limit(0), tokenizer_path()).count() == 0
