"""Rows for the corpus tests; the session fixture is that of the parent folder."""
import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                    T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def corpus(spark):
    """The small documents table as a list of rows, by doc_id."""
    return spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()


LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(30_000))
ODD_TEXTS = [None, "", "   \n\t ", "a", "One two three four five.", "One two three four five.",
             "\U0001F600 éß中文 café <|endoftext|> x", "line\n\nline\nline\r\nend  double", LONG,
             "!!! *** 12345 ???"]


def documents(spark, texts, lang="en", source="s", clash=()):
    """A documents table of these texts; ids 0, 1, ... and one repeated row, one null id; ``clash``: further columns."""
    rows = [(i, t, lang if i % 3 else None, source if i % 4 else None, len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows + rows[-1:] + [(None, "no id here", lang, source, 10)], DOC)
    for name in clash:
        df = df.selectExpr("*", f"1 AS {name}")
    return df


def empty(spark, clash=()):
    df = spark.createDataFrame([], DOC)
    for name in clash:
        df = df.selectExpr("*", f"1 AS {name}")
    return df
