import random

import pytest
from tidewater.llm import prefix_count
from tidewater.llm.pretoken import Vocabulary
from tidewater.llm.queries import tokenizer_path
from tokenizers import Tokenizer

from .conftest import AWKWARD


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(tokenizer_path())
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def counter():
    return prefix_count.PrefixCounter(Vocabulary(tokenizer_path()))


def test_every_prefix_equals_encoding_it(counter, library):
    pick = random.Random(5)
    alphabet = [*"abc 'srelvd \n\t12.!<|>é中 \x85\x1c😀", "<|endoftext|>", "'re", "'ll", " the", "  "]
    for _ in range(300):
        text = "".join(pick.choice(alphabet) for _ in range(pick.randrange(25)))
        assert counter.prefixes(text).tolist() == [library(text[:n]) for n in range(len(text) + 1)], text


def test_truncation_is_the_longest_prefix_in_budget(counter, library):
    text = "It's a truncation question, isn't it?  12345 ok"
    for budget in range(12):
        n = counter.truncated(text, budget)
        assert library(text[:n]) <= budget
        assert all(library(text[:m]) > budget for m in range(n + 1, len(text) + 1) if n < len(text)) or library(text) <= budget


def test_counts_over_awkward_rows(spark, awkward, library):
    got = {r["doc_id"]: r for r in prefix_count.token_counts(awkward, tokenizer_path()).collect()}
    assert {i: (r["n_bytes"], r["n_tokens"]) for i, r in got.items()} == {i: (len((t or "").encode()), library(t or "")) for i, t in AWKWARD.items()}
    assert prefix_count.token_counts(awkward.limit(0), tokenizer_path()).count() == 0


def test_frames_of_prefixes_and_cuts(spark, make_docs, library):
    docs = make_docs(["one two three", None, ""])
    rows = {r["doc_id"]: r for r in prefix_count.prefix_counts(docs, tokenizer_path()).collect()}
    assert rows[0]["prefix_tokens"] == [library("one two three"[:n]) for n in range(14)] and rows[1]["prefix_tokens"] == [0]
    cut = {r["doc_id"]: r["cut"] for r in prefix_count.truncate(docs, tokenizer_path(), 2).collect()}
    assert cut == {0: "one two", 1: "", 2: ""}
