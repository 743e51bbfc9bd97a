"""Columns of the user's that have the names operators use, repeated rows, null ids and empty tables, through every operator that returns documents."""

import corpus_pipeline
import pytest
from tidewater.llm import bpe, decontaminate, exact_dedup, near_dedup, prefix_count, sharding, span_dedup, toxicity
from tidewater.llm.naming import fresh
from tidewater.llm.queries import tokenizer_path

NAMES = ["doc", "spaced", "words", "term", "pos", "digest", "hit", "bands", "n", "Score", "_score", "_gone", "_hit", "_of", "_removed", "_twice", "_digest", "of", "gone", "same", "lost", "own", "bloom_at", "bloom_Mark", "_bloom_gone", "slot", "bits", "IDS", "removed", "chars", "whole", "id", "label"]
LONG = " ".join(f"word{i}" for i in range(60))
ROWS = [(1, LONG), (2, "x " + LONG), (3, LONG + "  "), (3, LONG + "  "), (4, "one two three"), (None, "four five six"), (None, None), (5, "seven. Eight nine ten. " + LONG)]


@pytest.fixture
def docs(spark):
    rows = [(i, t, *[f"{n}{k}" for n in NAMES]) for k, (i, t) in enumerate(ROWS)]
    return spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in NAMES))


def held(df, docs):
    """The rows of the result by number; every column must be as it was."""
    assert df.columns[: len(docs.columns)] == docs.columns or [c for c in df.columns if c in docs.columns] == [c for c in docs.columns if c != "text"]
    out = []
    for r in df.collect():
        k = int(r["doc"][3:])
        assert all(r[n] == f"{n}{k}" for n in NAMES)
        out.append(k)
    return sorted(out)


def test_own_names_never_clash():
    assert fresh(["a", "_B"], "A", "b", "b", "c") == ["_A", "b", "__b", "c"]


def test_filters_return_all_columns(spark, docs):
    items = spark.createDataFrame([(1, "four five six")], "item_id long, text string")
    assert held(exact_dedup.drop_exact_duplicates(docs), docs) in ([1, 2, 4, 5, 6, 7], [1, 3, 4, 5, 6, 7])
    assert held(near_dedup.drop_near_duplicates(docs), docs) == [0, 4, 5, 6]
    # null ids match each other
    assert held(decontaminate.decontaminate(docs, items), docs) == [0, 1, 2, 3, 4, 7]
    assert held(decontaminate.decontaminate(docs, items.limit(0)), docs) == list(range(8))


def test_added_columns_take_another_name(spark, docs):
    labels = spark.createDataFrame([(1, 0), (4, 1)], "id long, label int")
    assert held(toxicity.drop_toxic(docs, docs, labels, limit=1.1), docs) == list(range(8))
    assert toxicity.score(docs, toxicity.fit(docs, labels)).columns[-1] == "__score"
    codec = bpe.Codec(spark, tokenizer_path(), ["word"])
    encoded = bpe.encode(docs, tokenizer_path(), codec)
    assert encoded.columns[-1] == "_ids" and held(encoded, docs) == list(range(8))
    counted = prefix_count.prefix_counts(docs, tokenizer_path(), counts_col="n")
    assert counted.columns[-1] == "_n" and {r["doc"][3:]: r["_n"][-1] for r in counted.collect()}["6"] == 0


def test_spans_and_shards(spark, docs):
    cleaned = span_dedup.remove_repeated_sentences(docs)
    assert cleaned.columns == docs.columns and held(cleaned, docs) == list(range(8))
    assert sharding.shard(docs, 2).count() == 8


def test_pipeline_with_clashing_names_and_repeated_rows(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "four five six"), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(None, 1, 1), (1, 0, 0), (1, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", *NAMES, "_ids"]
    left = {r["doc_id"] for r in out.collect()}
    assert 4 in left and None not in left and 3 not in left


def test_pipeline_on_empty_tables(spark, docs, tmp_path):
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
