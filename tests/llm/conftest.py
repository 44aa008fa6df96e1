from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table from (doc_id, text[, lang, source]) rows, over a few partitions."""
    def make(rows, extra=()):
        full = [(r[0], r[1], *(r[2:4] if len(r) > 2 else ("en", "s")),
                 None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS).repartition(3)
        for name in extra:
            df = df.selectExpr("*", f"'clash' AS {name}")
        return df
    return make


@pytest.fixture(scope="session")
def sample(spark):
    """The smallest documents table, and its rows."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return df, df.collect()
