import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture()
def make_docs(spark):
    """Documents from (doc_id, text, source) rows, with further columns whose names clash with the operators' own."""
    def make(rows):
        full = [(d, t, "en", s, len(t) if t is not None else None, "x", 1) for d, t, s in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, key string, _id int")
    return make


def odd_rows():
    """Nulls, empty and long texts, repeated rows and ids, multi-byte text, no blanks at all."""
    import random
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 5)))
    body = [word() for _ in range(400)]
    text = " ".join(body)
    near = " ".join(body[:200] + ["changed"] + body[201:])
    long = " ".join(word() for _ in range(20_000))
    return [
        (5, text, "a"), (3, text, "a"), (9, near, "b"), (None, text, None), (None, None, None), (1, "", "a"), (2, None, "b"),
        (7, "  \n\t ", "b"), (8, "one two", "c"), (10, "One  TWO", "c"), (11, long, "a"), (11, long, "a"), (12, long[:60_000], "b"),
        (13, "x" * 5000, "a"), (14, "y" + "x" * 4000, None), (15, " ".join(body[100:180]) + " tail", "c"),
        (16, "head\n" + " ".join(body[100:180]), "c"), (17, "the\x0bcat\x1csat on <|endoftext|> 日本語 \n\n" * 30, "a"),
        (18, "Ab cD " * 40, "a"), (19, "ab cd " * 40, "a"), (20, text.upper(), "b"),
    ]
