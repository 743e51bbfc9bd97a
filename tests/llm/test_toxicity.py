import random

import numpy as np
from tidewater.llm import toxicity as tx

from .conftest import AWKWARD


def corpus(n=900, seed=4):
    pick = random.Random(seed)
    plain = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        words = [pick.choice(plain) for _ in range(pick.randrange(5, 120))]
        toxic = i % 6 == 0
        if toxic:
            words.insert(pick.randrange(len(words)), pick.choice(["idiot", "Moron", "loweiter", "loweisch"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_defined_cases(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows + [(10_000 + i, t) for i, t in AWKWARD.items()], "doc_id long, text string")
    train = spark.createDataFrame([x for x in labels if x[0] % 5] + [(None, 1), (5, None)], "id long, label int")
    model = tx.fit(docs, train)
    got = {r["doc_id"]: r["score"] for r in tx.score(docs, model).collect()}
    assert len(got) == len(rows) + len(AWKWARD) and all(0 <= s <= 1 for s in got.values())
    wrong = sum((got[i] >= 0.5) != bool(y) for i, y in labels if i % 5 == 0)
    assert wrong <= 3
    assert got[10_000] == got[10_001] < 0.5  # null as empty
    again = {r["doc_id"]: r["score"] for r in tx.score(docs.repartition(5), tx.fit(docs.repartition(3), train)).collect()}
    assert max(abs(got[i] - again[i]) for i in got) < 1e-9


def test_pairs_are_learned_that_weights_cannot_tell():
    pick = np.random.default_rng(0)
    a, b = pick.integers(0, 2, 800), pick.integers(0, 2, 800)
    y = ((a == 1) & (b == 1)).astype(float)
    rows = np.concatenate([np.nonzero(a)[0], np.nonzero(b)[0]])
    terms = np.concatenate([np.zeros(a.sum(), np.int64), np.ones(b.sum(), np.int64)])
    order = np.argsort(rows, kind="stable")
    machine = tx.FactorizationMachine.fit(rows[order], terms[order], y, 2)
    assert ((machine.scores(rows, terms, 800) >= 0.5) == (y == 1)).all()
    assert machine.factors[0] @ machine.factors[1] > 0.5


def test_one_label_only_and_empty_tables(spark):
    rows, labels = corpus(40)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = tx.fit(docs, spark.createDataFrame([x for x in labels if not x[1]], "id long, label int"))
    scores = {r["score"] for r in tx.score(docs, model).collect()}
    assert len(scores) == 1 and scores.pop() < 0.5
    none = tx.fit(docs, spark.createDataFrame([], "id long, label int"))
    assert tx.score(docs.limit(0), none).count() == 0
    clash = docs.withColumnRenamed("doc_id", "_score").selectExpr("_score", "text", "_score AS doc_id")
    assert tx.score(clash, model).columns == ["_score", "text", "doc_id", "score"]


def test_scores_equal_the_sum_over_pairs():
    """Written out: the bias, the weight of each term and the inner product of each pair of terms."""
    import math

    import numpy as np
    from tidewater.llm.toxicity import FactorizationMachine

    pick = np.random.default_rng(4)
    machine = FactorizationMachine(-0.4, pick.normal(size=12), pick.normal(size=(12, 3)))
    sets = [[], [3], [0, 5, 7], [1, 2, 3, 4, 11]]
    rows = np.repeat(np.arange(4), [len(s) for s in sets])
    got = machine.scores(rows, np.array([t for s in sets for t in s]), 4)
    for k, terms in enumerate(sets):
        z = machine.bias + sum(machine.weights[t] for t in terms)
        z += sum(sum(a * b for a, b in zip(machine.factors[t], machine.factors[u], strict=True)) for i, t in enumerate(terms) for u in terms[i + 1 :])
        assert abs(got[k] - 1 / (1 + math.exp(-z))) < 1e-12
