import pytest
from pyspark.sql import functions as F

LONG = "a very long text of many words " * 4000
EDGE = [
    (None, None, [1]), (1, "", [2]), (1, "", [2]), (2, "  \n\t", None), (None, "Hello there BIG world of words", [3]),
    (3, "hello there big world of words", [3]), (4, "Hello there BIG world of words", None), (5, LONG, [1]), (6, LONG, [1]),
    (7, "Größe naïve 你好 😀 ​ end", [0]), (8, "x" * 3000, [0]), (9, "9 " * 500, [0]),
]


@pytest.fixture()
def edge_docs(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, and extra columns whose names clash."""
    df = spark.createDataFrame(EDGE, "doc_id long, text string, key array<int>")
    for name in ("toxicity", "contamination", "fp", "features", "n_words", "kept", "KEY_", "part", "label", "id_"):
        df = df.withColumn(name, F.lit(None).cast("string") if name == "part" else F.lit("clash"))
    return df


@pytest.fixture()
def no_docs(edge_docs):
    return edge_docs.limit(0)
