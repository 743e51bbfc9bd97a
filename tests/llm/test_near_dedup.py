import random
import re

import numpy as np
from pyspark.sql import functions as F
from tidewater.llm import near_dedup as nd
from tidewater.llm.components import connected_components
from tidewater.llm.scratch import Scratch

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = BLANK.findall((text or "").translate(LOW))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(texts, k, percent=80):
    sets = {d: shingles(t, k) for d, t in texts.items()}
    root = {d: d for d in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}


def texts(seed=2):
    pick = random.Random(seed)
    vocabulary = ["".join(pick.choice("abcdefgh") for _ in range(4)) for _ in range(400)]
    out = {0: None, 1: "", 2: " \x0b ", 3: "One", 4: "one", 5: "one two", 6: "ÉÈ x", 7: "éè x", 8: "a\xa0b c", 9: "two one"}
    for group in range(12):
        base = [pick.choice(vocabulary) for _ in range(pick.choice([8, 30, 90, 300]))]
        for _ in range(pick.randrange(1, 14)):
            copy = list(base)
            for _ in range(pick.randrange(0, 1 + len(base) // 14)):
                copy[pick.randrange(len(copy))] = pick.choice(vocabulary)
            if pick.random() < 0.3:
                base = copy  # chains
            out[len(out) + 3] = " ".join(w.upper() if pick.random() < 0.2 else w for w in copy)
    return out


def test_components_against_brute_force(spark, make_docs):
    rows = texts()
    for k in (2, 5):
        got = {r["doc"]: (r["n"], r["component"]) for r in nd.NearDuplicates(make_docs(rows), words=k).components().collect()}
        assert got == brute(rows, k)
    kept = {r["doc_id"] for r in nd.drop_near_duplicates(make_docs(rows)).collect()}
    assert kept == {d for d, (_, c) in brute(rows, 5).items() if c == d}


def test_sketches_fill_and_estimate():
    pick = np.random.default_rng(1)
    base = pick.integers(0, 2**63, 600).astype(np.uint64)
    sets = [np.sort(base[:500]), np.sort(base[100:600]), np.sort(base[:1]), np.zeros(0, np.uint64), np.sort(base[:3])]
    rows = nd.sketches(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
    assert (rows[[0, 1, 2, 4]] < np.iinfo(np.uint64).max).all() and (rows[3] == np.iinfo(np.uint64).max).all()
    assert abs((rows[0] == rows[1]).mean() - 400 / 600) < 0.12


def test_chain_components(spark):
    ids = list(range(40))
    random.Random(4).shuffle(ids)
    links = spark.createDataFrame(list(zip(ids, ids[1:])) + [(100, 101), (101, 101)], "a long, b long")
    got = {r["node"]: r["root"] for r in connected_components(links, Scratch(spark, "t"), "c").collect()}
    assert got == {i: 0 for i in range(1, 40)} | {101: 100}


def test_null_and_repeated_ids_and_empty_table(spark, make_docs):
    docs = spark.createDataFrame([(None, "a b c d"), (1, "a b c d"), (1, "a b c d"), (2, "a b c d")], "doc_id long, text string")
    got = sorted((r["doc"] or -1, r["component"] or -1) for r in nd.NearDuplicates(docs, words=2).components().collect())
    assert got == [(-1, -1), (1, 1), (1, 1), (2, 1)]
    assert nd.NearDuplicates(make_docs([]), words=2).components().count() == 0


def test_members_that_no_leader_joins_are_searched(spark, make_docs):
    """Families around a text that is never a leader, copies of copies, and pairs just under and over the limit."""
    pick = random.Random(12)
    rows, vocabulary = {}, [f"v{i}" for i in range(3000)]
    for family in range(4):
        base = [pick.choice(vocabulary) for _ in range(pick.choice([60, 110]))]
        for member in range(45):
            copy = list(base)
            for _ in range(pick.randrange(1, 1 + len(base) // 11)):
                at = pick.randrange(len(copy))
                copy[at : at + 1] = [pick.choice(vocabulary)] if pick.random() < 0.7 else []
            if member % 9 == 0:
                base = copy
            rows[1000 * family + member * 7 % 45] = " ".join(copy)
        rows[1000 * family + 500] = " ".join(base)
    found = nd.NearDuplicates(make_docs(rows), words=2)
    assert {r["doc"]: (r["n"], r["component"]) for r in found.components().collect()} == brute(rows, 2)
    assert spark.read.parquet(f"{found.scratch.path}/open").count() > 50
    # with nothing joined before, the search alone finds links enough for every component
    found = nd.NearDuplicates(make_docs(rows), words=2)
    group = found.nodes.select(F.lit(0).cast("long").alias("grp"), "rep", "n", F.col("rep").alias("root"))
    sets = found._sets(group.select(F.col("rep").alias("doc")), "alone")
    links = found._verified(found._open_pairs(group, sets).distinct(), "alone", sets)
    roots = {r["node"]: r["root"] for r in connected_components(links, Scratch(spark, "t"), "c").collect()}
    one = {min(i for i in rows if shingles(rows[i], 2) == shingles(rows[d], 2)) for d in rows}
    want = brute(rows, 2)
    assert {d: roots.get(d, d) for d in one} == {d: want[d][1] for d in one} and len(roots) > 20
