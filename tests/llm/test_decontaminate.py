import random
import re
from collections import Counter

import pytest

from tidewater.llm.decontaminate import PhraseIndex, decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOW))


def brute(texts, items):
    wins = {(tuple(w[i : i + 10]), item) for item, t in items.items() if (w := words(t)) for i in range(max(len(w) - 10, 0) + 1)}
    out = {}
    for doc, t in texts.items():
        w = words(t)
        at = [(i, len(win), item) for win, item in wins for i in range(len(w) - len(win) + 1) if tuple(w[i : i + len(win)]) == win]
        out[doc] = (len(w), len({p for i, n, _ in at for p in range(i, i + n)}), sorted({str(x) for _, _, x in at}) or None)
    return out


def test_against_brute_force(spark, make_docs):
    pick = random.Random(1)
    vocabulary = ["alpha", "Beta", "c3", "été", "中文", "the", "of", "the"]
    items = {i: " ".join(pick.choice(vocabulary) for _ in range(n)) for i, n in enumerate([0, 1, 3, 9, 10, 11, 14, 14, 10, 2])} | {20: None, 21: "the the the the the the the the the the"}
    items[7] = items[6].upper()
    texts = {i: "; ".join(pick.choice(vocabulary) for _ in range(pick.randrange(60))) for i in range(25)}
    texts |= {30: None, 31: "", 32: items[6], 33: "x " + items[5] + " y " + items[5], 34: "the " * 300, 35: items[4] + "\n" + items[8]}
    benchmark = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {r["doc"]: (r["n_words"], r["n_hit"], r["items"]) for r in PhraseIndex(make_docs(texts), benchmark).report().collect()}
    assert got == brute(texts, items)
    clean = {r["doc_id"] for r in decontaminate(make_docs(texts), benchmark).collect()}
    assert clean == {d for d, v in brute(texts, items).items() if not v[1]}


def test_proximity_matches(spark, make_docs):
    benchmark = spark.createDataFrame([(1, "rare common1 common2 odd")], "item_id long, text string")
    docs = make_docs(["rare common1 common2 odd", "rare common1 x common2 odd", "odd rare", "rare " + "x " * 20 + "odd", "common2 common1 " * 9])
    got = sorted((r["doc"], r["gap"]) for r in PhraseIndex(docs, benchmark).proximity(3).collect())
    assert got == [(0, 0), (1, 1)]


def test_empty_tables(spark, make_docs):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert [r["n_hit"] for r in PhraseIndex(make_docs(["a b"]), empty).report().collect()] == [0]
    assert PhraseIndex(make_docs([]), spark.createDataFrame([(1, "a")], "item_id long, text string")).report().count() == 0


def brute_near(texts, items, distance):
    split = {d: words(t) for d, t in texts.items()}
    counts = Counter(x for w in split.values() for x in w)
    wins = {(tuple(w[i : i + 10]), item) for item, t in items.items() if (w := words(t)) for i in range(max(len(w) - 10, 0) + 1)}
    out = {}
    for win, item in wins:
        rare = sorted((counts[x], x, win.index(x)) for x in set(win) if counts[x])[:2]
        for doc, w in split.items() if len(rare) == 2 else ():
            (_, a, i), (_, b, j) = rare
            gaps = [g for p, x in enumerate(w) if x == a for q, y in enumerate(w) if y == b and (p < q) == (i < j) and (g := abs((p - i) - (q - j))) <= distance]
            if gaps:
                n, gap, names = out.get(doc, (set(), 99, set()))
                out[doc] = (n | {win}, min(gap, min(gaps)), names | {str(item)})
    return {d: (len(out[d][0]), out[d][1], sorted(out[d][2])) if d in out else (0, None, None) for d in texts}


def test_near_report_against_brute_force(spark, make_docs):
    pick = random.Random(2)
    vocabulary = [f"v{i}" for i in range(40)] + ["the"] * 20
    items = {i: " ".join(pick.choice(vocabulary) for _ in range(pick.randrange(24))) for i in range(12)} | {20: None, 21: "the the the", 22: "never seen v1", 23: "one gone two never seen three gone"}
    texts = {i: " ".join(pick.choice(vocabulary) for _ in range(pick.randrange(50))) for i in range(25)} | {30: None, 31: "", 32: "the " * 300}
    passage = [f"p{i}" for i in range(30)]
    items[40] = " ".join("replaced" if i % 7 == 3 else w for i, w in enumerate(passage))  # every window has a word that no document has
    texts |= {40: " ".join("other" if i % 7 == 3 else w for i, w in enumerate(passage)), 41: " ".join(w + (" other" if i % 7 == 3 else "") for i, w in enumerate(passage))}
    benchmark = spark.createDataFrame(list(items.items()), "item_id long, text string")
    index = PhraseIndex(make_docs(texts), benchmark)
    got = {r["doc"]: (r["n_near"], r["least_gap"], r["near_items"]) for r in index.near_report(3).collect()}
    assert got == brute_near(texts, items, 3)
    assert "40" in got[40][2] and "40" in got[41][2]
    assert {r["doc"]: (r["n_words"], r["n_hit"], r["items"]) for r in index.report().collect()} == brute(texts, items)
    with pytest.raises(ValueError):
        PhraseIndex(make_docs(texts), benchmark, near=False).proximity(3)


def test_near_is_a_query(spark):
    from tidewater.llm.queries import oracle_sql, queries

    rows = queries()["op4_proximity"](spark, "/root/testdata/sf0.001").collect()
    assert any(r["n_near"] for r in rows) and "op4_decontaminate" in oracle_sql() and "op4_proximity" not in oracle_sql()
