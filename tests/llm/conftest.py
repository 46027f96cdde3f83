import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table from (doc_id, text) or (doc_id, text, lang), in two partitions."""

    def build(*rows, extra=()):
        data = [(i, t, *(rest or ("en",)), "s", len(t or "")) for i, t, *rest in rows]
        df = spark.createDataFrame(data, DOCS).repartition(2)
        # Columns whose names clash with those that the operators use inside.
        for name in extra:
            df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return build


#: Texts that every operator must survive.
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (5, "one"),
    (5, "one"),
    (None, "one two three four five six"),
    (None, None),
    (7, "word " * 20_000),
    (8, "no_space_" * 5_000),
    (9, "é́ 日本語 🎉  x \x00 <|endoftext|> </s> [INST] ▁"),
    (10, "Ärger, straße. 12 345's don't\r\n\r\n  x"),
]


@pytest.fixture
def odd(documents):
    return documents(*ODD, extra=["ids", "label", "name", "n", "count", "key", "start", "chunk"])


@pytest.fixture
def empty(documents, spark):
    return spark.createDataFrame([], DOCS)
