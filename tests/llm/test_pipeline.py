import random

import corpus_pipeline
from tidewater.llm.queries import tokenizer_path
from tokenizers import Tokenizer

from .test_decontaminate import brute as hits
from .test_near_dedup import brute as near


def test_stages_against_brute_force(spark, make_docs, tmp_path):
    pick = random.Random(8)
    vocabulary = [f"w{pick.randrange(10**6)}" for _ in range(600)]
    make = lambda n: [pick.choice(vocabulary) for _ in range(n)]
    texts, toxic = {}, {}
    for i in range(240):
        words = make(pick.randrange(20, 60))
        toxic[i] = int(i % 4 == 0)
        if toxic[i]:
            words.insert(3, pick.choice(["idiot", "moron"]))
        texts[i] = " ".join(words)
    base = make(80)
    items = {1: " ".join(make(12)), 2: " ".join(make(5)), 3: None}
    texts |= {300: " ".join(base), 301: "  ".join(base), 302: " ".join(base[:79]), 303: " ".join([*base[1:], "end"]), 310: "x " + items[1] + " y", 311: items[2], 320: None, 321: "", 322: " "}
    make_docs(texts).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(items.items()), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, y) for i, y in toxic.items()], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    left = {i: t for i, t in texts.items() if not toxic.get(i)}
    groups = {}
    for i, t in left.items():
        groups.setdefault("".join((t or "").split()), []).append(i)
    keep = {min(g, key=lambda i: (-len(left[i] or ""), i)) for g in groups.values()}
    left = {i: t for i, t in left.items() if i in keep}
    left = {i: left[i] for i, (_, root) in near(left, 5).items() if root == i}
    left = {i: left[i] for i, (_, n, _) in hits(left, items).items() if not n}

    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "ids"]
    library = Tokenizer.from_file(tokenizer_path())
    assert {r["doc_id"]: r["ids"] for r in out.collect()} == {i: library.encode(t or "", add_special_tokens=False).ids for i, t in left.items()}
    assert 301 in left and 300 not in left and 303 not in left and 310 not in left and 311 not in left
    assert len(corpus_pipeline.STAGES) == 5
