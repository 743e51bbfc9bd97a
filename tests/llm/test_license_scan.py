import random
import re

from pyspark.sql import functions as F

from tidewater.llm import license_scan as ls

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def blocks(text, span):
    text = re.sub(r"\r\n?", "\n", text or "")
    lines, paragraphs = [words(x) for x in text.split("\n")], [[]]
    for line in lines:
        if line:
            paragraphs[-1] += line
        elif paragraphs[-1]:
            paragraphs.append([])
    paragraphs = [p for p in paragraphs if p]
    if len(paragraphs) > 1:
        return paragraphs
    w = words(text)
    return lines + [w[k : k + 2 * span] for k in range(0, max(len(w) - span, 1), span)] if sum(map(bool, lines)) > 1 else lines


def contained(text):
    """The greatest containment of each label that reaches the threshold, over all blocks and templates."""
    out = {}
    for label, templates in ls.TEMPLATES.items():
        for t in templates:
            of = set(t.split())
            most = max((len(set(b) & of) for b in blocks(text, ls.block_span(ls.TEMPLATES))), default=0) / len(of)
            if most >= ls.THRESHOLD - 1e-12:
                out[label] = max(most, out.get(label, 0))
    return out


def test_phrases_and_templates_against_brute_force(spark, make_docs):
    mit = ls.TEMPLATES["mit"][0].split(" ")
    need = -(-len(set(mit)) * 7 // 10)
    texts = [
        None, "", "CC BY cc by. CC-BY!", "all rights; reserved", "rights reserved all", "x\n" + " ".join(mit[:10]) + "\n" + " ".join(mit[10:]), "intro\n" + " ".join(reversed(mit)) + " more words\nend",
        " ".join(list(dict.fromkeys(mit))[:need]), " ".join(list(dict.fromkeys(mit))[: need - 1]), "General\nPublic\nLicense é", "ccby cc bye", "cc by " * 20000, ls.TEMPLATES["cc-by-notice"][0].upper(),
    ]
    got = {r["doc_id"]: r for r in ls.scan(make_docs(texts)).collect()}
    for i, text in enumerate(texts):
        w = words(text)
        places = [(k, label) for p, label in ls.PHRASES.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        found = contained(text)
        r = got[i]
        assert (r["n_words"], r["n_base"]) == (len(w), len(places))
        assert (r["first_word"], r["last_word"]) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert r["labels"] == ",".join(sorted({x for _, x in places} | set(found)))
        assert abs(r["score"] - (1.0 if places else max(found.values(), default=0.0))) < 1e-12
    assert "mit" in got[7]["labels"] and "mit" not in got[8]["labels"] and got[5]["labels"] == "mit"


def test_empty_table_and_clashing_columns(spark, make_docs):
    assert ls.scan(make_docs([]).limit(0)).count() == 0
    docs = make_docs(["cc by", None]).withColumnsRenamed({"lang": "doc", "source": "template", "n_chars": "spaced"})
    assert ls.scan(docs).count() == 2


def test_null_and_repeated_ids(spark):
    docs = spark.createDataFrame([(None, "cc by"), (1, "cc by"), (1, "cc by")], "doc_id long, text string")
    assert [r["n_base"] for r in ls.scan(docs).collect()] == [1, 1, 1]


def test_wrapped_notices_against_brute_force(spark, make_docs):
    pick = random.Random(5)
    wrap = lambda t, n, mark="", end="\n": end.join(mark + " ".join(t.split(" ")[i : i + n]) for i in range(0, len(t.split(" ")), n))
    mit, bsd = ls.TEMPLATES["mit"][0], ls.TEMPLATES["bsd"][0]
    foreign = lambda n, each: "\n".join(" ".join(f"w{pick.randrange(999)}" for _ in range(each)) for _ in range(n))
    texts = [
        None, "", "\n\n\n", mit, wrap(mit, 8), wrap(mit.upper(), 5, " * ", "\r\n"), wrap(bsd, 1), "head\n\n" + wrap(mit, 9) + "\n \t*\n" + foreign(2, 5), foreign(40, 9) + "\n" + wrap(bsd, 6) + "\n" + foreign(40, 9),
        wrap(mit, 12, end="\n\n"), wrap(mit, 12, end="\r\n"), wrap(mit, 12, end="\r"), wrap(mit, 12, end="\n\r"), foreign(300, 3) + "\n" + wrap(mit, 3), "a\n" + " ".join(f"{x} y z q u" for x in mit.split(" ")), wrap(mit, 1, "x y z q u v ", "\n"), wrap(mit, 12, end="\n--- # ---\n"),
    ]
    for _ in range(30):
        t = pick.choice([t for texts in ls.TEMPLATES.values() for t in texts]).split(" ")
        kept = [w for w in t if pick.random() < 0.8]
        texts.append(foreign(pick.randrange(30), 7) + pick.choice(["\n", "\n\n"]) + wrap(" ".join(kept), pick.randrange(1, 9)) + pick.choice(["\n", "\n\n"]) + foreign(pick.randrange(30), 7))
    got = {r["doc"]: r["found"] for r in ls.containments(make_docs(texts)).groupBy("doc").agg(F.map_from_entries(F.collect_list(F.struct("label", "containment"))).alias("found")).collect()}
    for i, text in enumerate(texts):
        assert got.get(i, {}) == contained(text), i
    rows = {r["doc_id"]: r for r in ls.scan(make_docs(texts)).collect()}
    assert all("mit" in rows[i]["labels"].split(",") and rows[i]["score"] == 1 for i in (3, 4, 5, 7, 10, 11, 13)) and "bsd" in rows[8]["labels"] and not rows[9]["labels"]


def test_bodies_without_the_opening_are_found(spark, make_docs):
    _, grant, notice = ls.TEMPLATES["mit"]
    body = grant[grant.index("including") :]  # a third of the paragraph is missing, its opening
    rows = {r["doc_id"]: r["labels"] for r in ls.scan(make_docs(["Copyright 2020 A\n\n" + notice, body, "the software of the people is free", ls.TEMPLATES["as-is"][1]])).collect()}
    assert rows == {0: "mit", 1: "", 2: "", 3: "as-is"}
    assert ls.scan(make_docs(["one two three four"]), templates={"mine": ("one two three",), "other": ("nine",)}, threshold=1.0).first()["labels"] == "mine"
