import hashlib
import re

from tidewater.llm.exact_dedup import MergeIndex, drop_exact_duplicates, exact_duplicates

from .conftest import AWKWARD


def test_against_brute_force(spark, make_docs):
    texts = AWKWARD | {20: "o n e", 21: "\x0bone\r", 22: "One", 23: "on\xa0e", 24: "o n e", 25: "a" * 5000 + " "}
    got = {r["doc"]: (r["keep"], r["size"], bytes(r["digest"]).hex()) for r in exact_duplicates(make_docs(texts)).collect()}
    groups = {}
    for i, t in texts.items():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append(i)
    want = {i: (min(g, key=lambda j: (-len(texts[j] or ""), j)), len(g), hashlib.sha256(k.encode()).hexdigest()) for k, g in groups.items() for i in g}
    assert got == want
    assert {r["doc_id"] for r in drop_exact_duplicates(make_docs(texts)).collect()} == {k for k, _, _ in want.values()}


def test_runs_merge_over_batches(spark, make_docs):
    index = MergeIndex(spark)
    index.flush(make_docs({5: "a b", 6: "c"}))
    index.flush(make_docs({3: "ab", 9: "a  b"}))
    index.compact()
    assert {r["doc"]: (r["keep"], r["size"]) for r in index.members().collect()} == {5: (9, 3), 3: (9, 3), 9: (9, 3), 6: (6, 1)}


def test_colliding_digests_are_told_apart_by_their_bytes(spark, make_docs):
    class Weak(MergeIndex):
        def entries(self, docs):
            return super().entries(docs)

    from pyspark.sql import functions as F
    from tidewater.llm import exact_dedup

    whole = exact_dedup.F.sha2
    try:
        exact_dedup.F.sha2 = lambda c, n: whole(F.substring(c, 1, 1), n)  # equal digests for equal first letters
        got = {r["doc"]: (r["keep"], r["size"]) for r in exact_duplicates(make_docs({1: "ab", 2: "ac", 3: "a b", 4: "x"})).collect()}
    finally:
        exact_dedup.F.sha2 = whole
    assert got == {1: (3, 2), 3: (3, 2), 2: (2, 1), 4: (4, 1)}


def test_null_and_repeated_ids_and_empty_table(spark, make_docs):
    docs = spark.createDataFrame([(None, "a"), (2, "a"), (2, "a"), (2, "b")], "doc_id long, text string")
    assert sorted((r["doc"] or 0, r["keep"], r["size"]) for r in exact_duplicates(docs).collect()) == [(0, 2, 3), (2, 2, 1), (2, 2, 3), (2, 2, 3)]
    assert sorted((r["doc_id"], r["text"]) for r in drop_exact_duplicates(docs).collect()) == [(2, "a"), (2, "b")]
    assert exact_duplicates(make_docs([])).count() == 0
