import zlib

import numpy as np
from tidewater.llm.sharding import pack, shard

from .conftest import AWKWARD


def test_law_slots_and_groups(spark, make_docs):
    texts = {i: "word " * (i * 37 % 101) + str(i % 900) for i in range(3000)} | {5000 + i: "hot text " * 40 for i in range(1500)} | {9000 + i: t for i, t in AWKWARD.items() if i < 9}
    rows = shard(make_docs(texts)).collect()
    assert sorted(r["doc"] for r in rows) == sorted(texts)
    total, slots, sizes = {}, {}, {}
    for r in rows:
        raw = (texts[r["doc"]] or "").encode()
        assert (r["size"], r["crc"]) == (len(raw) + 1, zlib.crc32(raw))
        slots.setdefault(r["shard"], []).append(r["slot"])
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
    assert sorted(sizes) == list(range(8)) and max(sizes.values()) < 1.02 * min(sizes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(s) for s in slots.values()]
    assert max(counts) < 1.3 * min(counts)
    again = {r["doc"]: (r["shard"], r["slot"]) for r in shard(make_docs(texts).repartition(7)).collect()}
    assert again == {r["doc"]: (r["shard"], r["slot"]) for r in rows}
    ordinary = {}
    for r in rows:
        if r["doc"] < 3000:
            ordinary.setdefault(texts[r["doc"]], set()).add(r["shard"])
    assert all(len(s) == 1 for s in ordinary.values())


def test_packing_balances_every_component():
    pick = np.random.default_rng(3)
    sizes = pick.lognormal(size=(2000, 3))
    of = pack(sizes, 8)
    sums = np.stack([sizes[of == s].sum(axis=0) for s in range(8)])
    assert (sums.max(axis=0) / sums.min(axis=0) < 1.05).all()


def test_packing_is_greedy_by_the_dot_product():
    """The rule written out: largest first, each to the shard whose residual capacity has the highest dot product with it."""
    pick = np.random.default_rng(6)
    sizes = pick.integers(1, 50, size=(60, 3)).astype(float)
    shares = [[x / t * 4 for x, t in zip(row, sizes.sum(axis=0), strict=True)] for row in sizes]
    left, want = [[1.0] * 3 for _ in range(4)], [0] * 60
    for i in sorted(range(60), key=lambda i: (-max(shares[i]), i)):
        want[i] = max(range(4), key=lambda s: (round(sum(a * b for a, b in zip(left[s], shares[i], strict=True)), 12), -s))
        left[want[i]] = [a - b for a, b in zip(left[want[i]], shares[i], strict=True)]
    assert pack(sizes, 4).tolist() == want


def test_empty_and_null_rows(spark, make_docs):
    assert shard(make_docs([])).count() == 0
    docs = spark.createDataFrame([(None, None), (None, ""), (3, "x"), (3, "x")], "doc_id long, text string")
    assert sorted(r["size"] for r in shard(docs, 2).collect()) == [1, 1, 2, 2]
