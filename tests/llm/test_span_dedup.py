import random

from tidewater.llm import span_dedup as sd

from .conftest import AWKWARD


def brute(texts, least=sd.LEAST_WORDS):
    """By the shortest run from each sentence and the shortest to each: what is removed and where it came from."""
    places = {}
    for doc in sorted(texts):
        words = [tuple(s.lower().split()) for s in sd.sentences(texts[doc] or "")]
        enough = lambda i, j: 0 <= i and j <= len(words) and j - i >= sd.SENTENCES and sum(map(len, words[i:j])) >= least  # noqa: B023, E731
        for k in range(len(words)):
            runs = [next(((k, j) for j in range(k + 1, len(words) + 1) if enough(k, j)), None), next(((i, k + 1) for i in range(k, -1, -1) if enough(i, k + 1)), None)]
            for i, j in filter(None, runs):
                places.setdefault(tuple(words[i:j]), set()).add((doc, i, j))
    out = {}
    for found in places.values():
        for doc, i, j in sorted(found)[1:]:
            removed, origins = out.setdefault(doc, (set(), set()))
            removed.update(range(i, j))
            origins.add(min(found)[0])
    return {d: (sorted(r), sorted(o)) for d, (r, o) in out.items()}


def test_against_brute_force(spark, make_docs):
    pick = random.Random(3)
    vocabulary = [f"w{i}" for i in range(50)]
    sentence = lambda: " ".join(pick.choice(vocabulary) for _ in range(pick.randrange(1, 9))).capitalize() + pick.choice([". ", "! ", ".\n", "\n", ".  "])
    passages = ["".join(sentence() for _ in range(pick.randrange(1, 8))) for _ in range(6)]
    texts = {i: "".join(pick.choice(passages) if pick.random() < 0.25 else sentence() for _ in range(pick.randrange(12))) for i in range(40)} | {50 + i: t for i, t in AWKWARD.items()}
    got = {r["doc"]: (r["removed"], r["origins"]) for r in sd.repeated_sentences(make_docs(texts), least_words=12).collect()}
    assert got == brute(texts, 12) and got
    cleaned = {r["doc_id"]: r["text"] for r in sd.remove_repeated_sentences(make_docs(texts), least_words=12).collect()}
    for d, t in texts.items():
        gone = set(got.get(d, ([],))[0])
        assert cleaned[d] == (t if not gone else "".join(s for i, s in enumerate(sd.sentences(t)) if i not in gone))


def test_empty_table_and_repeated_rows(spark, make_docs):
    assert sd.repeated_sentences(make_docs([])).count() == 0
    text = "One two three four five six. Seven eight nine ten eleven twelve. "
    docs = spark.createDataFrame([(1, text), (1, text), (None, text), (7, text)], "doc_id long, text string")
    got = {r["doc"]: r["origins"] for r in sd.repeated_sentences(docs, least_words=12).collect()}
    assert set(got) == {1, 7}


def brute_all_runs(texts):
    """The sentences in any run of enough sentences and words that stands at an earlier place too."""
    seen, out = set(), {}
    for doc in sorted(texts):
        words = [tuple(s.lower().split()) for s in sd.sentences(texts[doc])]
        for i in range(len(words)):
            for j in range(i + sd.SENTENCES, len(words) + 1):
                if sum(map(len, words[i:j])) >= 12:
                    if (run := tuple(words[i:j])) in seen:
                        out.setdefault(doc, set()).update(range(i, j))
                    seen.add(run)
    return {d: sorted(r) for d, r in out.items()}


def test_every_repeated_run_is_found_from_both_ends(spark, make_docs):
    pick = random.Random(4)
    sentence = lambda: " ".join(f"w{pick.randrange(40)}" for _ in range(pick.randrange(1, 9))) + ". "
    passages = ["".join(sentence() for _ in range(pick.randrange(2, 8))) for _ in range(6)]
    texts = {i: "".join(pick.choice(passages) if pick.random() < 0.3 else sentence() for _ in range(pick.randrange(12))) for i in range(40)}
    tail = "w " * 19 + "end. One two three four. Five six seven eight. "
    texts |= {90: tail, 91: tail, 92: tail + "more words follow here."}
    got = {r["doc"]: r["removed"] for r in sd.repeated_sentences(make_docs(texts), least_words=12).collect()}
    assert got == brute_all_runs(texts)
    assert got[91] == got[92] == [0, 1, 2]


def test_the_query_removes_whole_copies(spark, make_docs, tmp_path):
    from tidewater.llm.queries import op5_span_dedup

    tail = "w " * 19 + "end. One two three four. Five six seven eight. "
    assert len(sd.sentences(tail)) == 3
    make_docs([tail, tail + "other text. ", "lead. " + tail]).write.parquet(f"{tmp_path}/documents.parquet")
    assert {r["doc_id"]: r["removed_sentences"] for r in op5_span_dedup(spark, str(tmp_path)).collect()} == {1: [0, 1, 2], 2: [1, 2, 3]}


def test_scripts_without_spaces(spark, make_docs):
    passage = "今天天气很好。我们一起去公园散步！「你想去吗？」他问道。"
    assert sd.sentences(passage) == ["今天天气很好。", "我们一起去公园散步！", "「你想去吗？」", "他问道。"]
    assert sd.sentences("真的？！ 好。\n\n終。") == ["真的？！ ", "好。\n\n", "終。"]
    got = {r["doc"]: r["removed"] for r in sd.repeated_sentences(make_docs(["甲说。" + passage, "乙也说了别的话。" + passage + "完。", "短。句。"]), least_words=12).collect()}
    assert got == {1: [1, 2, 3, 4]}


def test_long_sentences_are_told_by_pieces(spark, make_docs):
    pick = random.Random(5)
    words = lambda n: " ".join(f"w{pick.randrange(10**6)}" for _ in range(n))
    passage, texts = words(90), {}
    for i in range(4):  # one long sentence that holds the passage between other words
        texts[i] = f"{words(20 + 7 * i)} {passage} {words(31 - 5 * i)}."
    for t in texts.values():
        assert "".join(sd.sentences(t)) == t
    cleaned = {r["doc_id"]: r["text"].split() for r in sd.remove_repeated_sentences(make_docs(texts)).collect()}
    assert cleaned[0] == texts[0].split()
    for i in (1, 2, 3):
        left = set(cleaned[i])
        assert len(left & set(passage.split())) <= 2 * sd.PART and not (set(texts[i].split()) - set(passage.split())) - left


def test_words_of_repeated_windows_are_found(spark, tmp_path):
    """At least 0.9 of the words in windows of 51 words that stand earlier too, over the documents of the smallest tables."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    removed = {r["doc"]: r["removed"] for r in sd.repeated_sentences(docs).collect()}
    seen, held, found = {}, 0, 0
    for doc in sorted(texts):
        words, inside = texts[doc].lower().split(), set()
        for i in range(len(words) - 50):
            if seen.setdefault(tuple(words[i : i + 51]), (doc, i)) != (doc, i):
                inside.update(range(i, i + 51))
        place, gone = 0, set()
        for k, s in enumerate(sd.sentences(texts[doc])):
            size = len(s.split())
            if k in set(removed.get(doc, ())):
                gone.update(range(place, place + size))
            place += size
        held, found = held + len(inside), found + len(inside & gone)
    assert held > 1000 and found >= 0.9 * held
