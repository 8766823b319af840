"""Small tables with the awkward rows that every operator must take."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, shard int, component_id string, k int, h int, spans string, ids string, t string, c0 string, size string, key string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text, lang, source); the other columns clash with names that operators use inside."""

    def make(rows):
        full = [(*r[:4], *([None] * (4 - len(r[:4]))), len(r[1]) if r[1] is not None else None, 1, 2, "x", 3, 4, "s", "i", "t", "c", "z", "y") for r in rows]
        return spark.createDataFrame([tuple(r) for r in full], SCHEMA)

    return make


@pytest.fixture(scope="session")
def small(spark):
    """The smallest documents table."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
