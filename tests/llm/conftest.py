from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                    T.StructField("n_chars", T.LongType())])

#: Empty and null texts, white space only, ties, repeated rows, null ids, one very long text.
ODD = [(1, "", "en", "a", 0), (2, None, None, None, None), (3, " \t\n ", "en", "a", 4),
       (4, "same words here and there", "en", "a", 25), (5, "same words here and there", "en", "b", 25),
       (5, "same words here and there", "en", "b", 25), (None, "same words here and there", "en", None, 25),
       (7, "Ünï çödé ΣΑΣ 1.2.3.4 a@b.cd\nline\n\nline", "de", "b", 40),
       (8, "word%d " * 3, "en", "a", 18), (9, "long text of some words\n" * 20_000, "en", "a", 480_000)]


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows):
        return spark.createDataFrame([r if len(r) == 5 else (*r, "en", "s", len(r[1] or "")) for r in rows], DOC)
    return make


@pytest.fixture(scope="session")
def odd(docs_of):
    return docs_of(ODD).cache()


@pytest.fixture(scope="session")
def empty(docs_of):
    return docs_of([])


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
