import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts, extra=""):
        rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in (texts.items() if isinstance(texts, dict) else enumerate(texts))]
        return spark.createDataFrame(rows, SCHEMA)

    return make


AWKWARD = {0: None, 1: "", 2: " \n\t", 3: "one", 4: "one", 5: "One two three. Four five six. Seven.", 6: "wörter und 12 zahlen, é中文😀 \x85 x", 7: "tail\x00nul", 8: "a" * 5000, 9: "word " * 30000, 10: "<|endoftext|> it's we're  \n\n x"}


@pytest.fixture(scope="session")
def awkward(make_docs):
    return make_docs(AWKWARD)
