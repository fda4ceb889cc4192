import pytest

LONG = " ".join(f"word{i % 977}" for i in range(60_000))
LINE = "This line is shared by several documents."


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, and columns with the names
    that the operators add."""
    rows = [
        (1, "a b c d e f g", "s1"), (1, "a b c d e f g", "s1"), (1, "another text of one id", None), (2, None, "s1"), (3, "", "s2"),
        (4, LONG, "s2"), (5, LONG + " end", "s2"), (None, "no id here", "s1"), (None, None, None), (6, " \n\t ", "s3"),
        (7, f"{LINE}\nown seven", "s1"), (8, f"  {LINE.upper()}\nown eight\n", "s1"), (9, f"{LINE}\nown nine", "s1"),
        (10, "x" * 100_000, "s4"), (11, "ü <|im_end|> &amp; \x00 日本", "s4"),
    ]
    schema = "doc_id bigint, text string, source string"
    extra = "n_lines int, n_dropped string, copy int, shuffle_key int, n_words int, n_removed int, score double, shard int, key int, component_id int, start int, ids string"
    blank = [f"cast(null as {kind}) as {name}" for name, kind in (c.split() for c in extra.split(", "))]
    return spark.createDataFrame(rows, schema).selectExpr("*", *blank)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
