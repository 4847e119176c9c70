import pytest

SF = "/root/testdata/sf0.001"
EDGE = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, label int, rest string, id int"


@pytest.fixture
def edge(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and extra
    columns whose names clash with those that operators make."""
    long = " ".join(f"w{i % 977} x{i % 13}" for i in range(30_000))
    solid = "abcdefghij" * 6_000
    row = lambda i, t, lang="en", src="s": (i, t, lang, src, None, 0.5, 1, "r", 3)
    said = "one two three four five six seven eight nine ten\nshort\nthe same line over and over"
    return spark.createDataFrame([
        row(1, said), row(2, said), row(2, said), row(3, said + " eleven"), row(4, None), row(5, ""), row(6, " \n\t\n"),
        row(7, long), row(8, solid), row(9, long + " end", None, None), row(None, "a text without a number", None, None),
        row(10, "  THE SAME line over and over  \nÀ ÿ ß \U0001F600 mixed <|endoftext|> text", "de", "t"),
        row(11, "solo", "fr", "t"), row(12, "12 34 !!", None, "\U0001F600")], EDGE)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], EDGE)
