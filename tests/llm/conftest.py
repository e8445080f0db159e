import pytest

ROWS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, short texts."""
    long = " ".join(f"word{i % 977} tail" for i in range(60_000))
    passage = "a shared passage that is long enough to be found again " * 5
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", "a", 4), (4, "One", "en", None, 3), (None, "no id here", "en", "b", 10),
        (None, None, None, None, None), (5, long, "en", "b", len(long)), (6, "héllo wörld ß " * 40, "de", "c", 1), (7, passage + "seven", "en", "c", 1),
        (8, "eight " + passage, "en", "c", 1), (7, passage + "seven", "en", "c", 1), (9, "x" * 500, "en", "a", 500), (10, "x" * 300, None, "a", 300),
        (11, "The the THE the\nThe the THE the\nThe the THE the", "en", "a", 40), (12, "<|endoftext|> it's 9,99 € ok ¶ Ω ΟΔΟΣ é", "el", "z", 30),
        (12, "another text of the same id", "en", "a", 20), (13, "́combining first ́ alone", "en", "", 9)]
    return spark.createDataFrame(rows, ROWS)


@pytest.fixture(scope="session")
def extra(odd):
    """The same rows with columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    names = ["id", "row", "fp", "h", "score", "size", "batch", "part", "n", "key", "shard", "label", "text_", "segment", "term", "position", "kept", "id_", "label_", "score_", "row_key", "copy", "its", "body", "gone", "slice", "item", "rank", "w"]
    return odd.select("*", *[F.lit("clash").alias(n) for n in names])


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], ROWS)


def pairs(df, *columns):
    return [tuple(r) for r in df.select(*(columns or ("doc_id", "text"))).collect()]
