import pandas as pd
import pytest
from pyspark.sql import functions as F

DOC_TYPE = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"word{i % 977} tail{i % 31}" for i in range(30_000))


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def docs_pdf(docs):
    return docs.toPandas().sort_values("doc_id").reset_index(drop=True)


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Missing values in every column, empty and very long texts, ties, repeated rows, extra columns whose names clash with inner ones."""
    rows = [
        (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, "   \n", None, None, 4), (4, "one two three", "en", None, 13),
        (5, LONG, "de", "b", len(LONG)), (6, "same text here with six words", "fr", "b", 29), (7, "same text here with six words", "fr", None, 29),
        (7, "same text here with six words", "fr", None, 29), (None, "no key at all in this row", "es", "c", 25), (None, None, None, None, None),
        (9, "1234 5678 !!!", "en", "\U0001f600", 13), (10, "ÀÉÎ İstanbul Σίσυφος ﬁn 日本語", "en", "c", 26), (11, "<|endoftext|> don't stop", "en", "z", 23),
        (12, "idiot you are a moron", "en", "z", 20), (-13, "negative key", "en", "z", 12),
    ]
    df = spark.createDataFrame(rows, DOC_TYPE)
    for name in ("size", "_order", "_source", "bucket", "shard", "score", "rid", "_document", "copies", "key", "term"):
        df = df.withColumn(name, F.lit("clash"))
    return df.repartition(3)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], DOC_TYPE)


def rows_of(df):
    return df.toPandas().astype(object).where(lambda x: pd.notna(x), None)
