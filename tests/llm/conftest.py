"""Small documents with every odd case: nulls, empty and long texts, repeated rows, extra columns with clashing names."""

import pytest
from llm_samples import SF


@pytest.fixture(scope="session")
def documents(spark):
    odd = [(900001, None, "en", "s", 0), (900002, "", None, "s", 0), (900003, " \n\t ", "en", None, 4), (900004, "one", "en", "s", 3),
           (900005, "to be or not " * 20_000, "en", "s", None), (900006, "same text here twice", "en", "s", 20),
           (900006, "same text here twice", "en", "s", 20), (None, "a row without an id", "en", "s", 1), (900007, "12 34 !!", "en", "s", 8)]
    rows = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long")
    return spark.read.parquet(f"{SF}/documents.parquet").unionByName(rows).repartition(3).cache()


@pytest.fixture(scope="session")
def rows(documents):
    return [(r.doc_id, r.text) for r in documents.collect()]


@pytest.fixture(scope="session")
def empty(documents):
    return documents.limit(0)
