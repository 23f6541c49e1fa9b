import pytest
from pyspark.sql import functions as F


@pytest.fixture
def documents(spark):
    """Nulls in every column, empty, very long and repeated texts, ties, and columns with clashing names."""
    line = "the first line of a shared passage with more than a few words in it"
    rows = [
        (1, "a b c d e f g h i j\nk l m n o\n" + line, "s0"),
        (2, "a b c d e f g h i j\nk l m n o\n" + line, "s0"),
        (2, "a b c d e f g h i j\nk l m n o\n" + line, "s0"),
        (3, "", "s1"),
        (4, None, None),
        (None, "x y z " * 40, "s1"),
        (6, " \n\t \n", "s1"),
        (7, "word " * 30_000, "s0"),
        (8, "é" * 300, None),
        (9, "Licensed under CC BY-NC 4.0.\nplain text follows here", "s2"),
    ]
    clashing = ("row", "text_", "n", "digest", "id", "hash", "key", "size", "kept", "ids", "place", "host", "component_id")
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return df.withColumns({c: F.lit(c) for c in clashing})
