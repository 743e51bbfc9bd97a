from pyspark.sql import functions as F
from tidewater.llm import bloom
from tidewater.llm.scratch import Scratch


def test_what_was_added_always_passes_and_little_else(spark):
    scratch = Scratch(spark, "test")
    keys = spark.range(0, 20_000, 2).withColumnRenamed("id", "key")
    made = bloom.bloom(keys, "key", scratch, "filter")
    rows = spark.range(20_000).withColumn("bloom_at", F.lit("mine"))
    passed = bloom.passing(rows, F.col("id"), made)
    assert passed.columns == rows.columns
    found = {r["id"] for r in passed.collect()}
    assert found >= set(range(0, 20_000, 2)) and len(found) < 10_100
    assert bloom.marked(rows, F.col("id"), made, "mark").where("mark").count() == len(found)
    left = {r["id"] for r in bloom.without(rows, "id", keys, scratch, "gone").collect()}
    assert left == set(range(1, 20_000, 2))


def test_a_full_filter_only_costs_work(spark, monkeypatch):
    monkeypatch.setattr(bloom, "SLOTS", 2)
    scratch = Scratch(spark, "test")
    keys = spark.createDataFrame([(None,), *[(i,) for i in range(300)]], "key long")
    rows = spark.createDataFrame([(None,), (7,), (301,), (302,)], "id long")
    assert bloom.bloom(keys, "key", scratch, "full").count() <= 4
    assert {r["id"] for r in bloom.without(rows, "id", keys, scratch, "gone").collect()} == {301, 302}


def test_operators_are_the_same_with_a_full_filter(spark, make_docs, monkeypatch):
    from .test_decontaminate import brute as hits
    from .test_exact_dedup import exact_duplicates
    from .test_near_dedup import brute as near
    from tidewater.llm.decontaminate import PhraseIndex
    from tidewater.llm.near_dedup import NearDuplicates

    base = [f"w{i}" for i in range(80)]
    texts = {1: " ".join(base), 2: " ".join(base[1:]), 3: " ".join(base[:40]), 4: "  ".join(base), 5: "a b c d", 6: None}
    items = {1: "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13", 2: "c d"}
    benchmark = spark.createDataFrame(list(items.items()), "item_id long, text string")
    for slots in (20, 1):
        monkeypatch.setattr(bloom, "SLOTS", slots)
        got = {r["doc"]: (r["n_words"], r["n_hit"], r["items"]) for r in PhraseIndex(make_docs(texts), benchmark).report().collect()}
        assert got == hits(texts, items)
        assert {r["doc"]: (r["keep"], r["size"]) for r in exact_duplicates(make_docs(texts)).collect()} == {1: (4, 2), 2: (2, 1), 3: (3, 1), 4: (4, 2), 5: (5, 1), 6: (6, 1)}
        found = {r["doc"]: (r["n"], r["component"]) for r in NearDuplicates(make_docs(texts), words=2).components().collect()}
        assert found == near(texts, 2)


def test_whole_texts_are_not_exchanged(spark, make_docs):
    """In the plans, no exchange carries a text or its words: documents stay where they are."""
    import re

    from tidewater.llm.decontaminate import PhraseIndex
    from tidewater.llm.near_dedup import set_table

    docs = make_docs({1: "a b c", 2: "a b d"})
    scratch = Scratch(spark, "test")
    wanted = bloom.bloom(docs.select(F.col("doc_id").alias("doc")), "doc", scratch, "wanted")
    index = PhraseIndex(docs, docs.select(F.col("doc_id").alias("item_id"), "text"), near=False)
    for df in (set_table(docs, wanted, 2), bloom.passing(index._tokens(), F.col("term"), wanted)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"Exchange (hash|range|Round|Single)", plan), plan
