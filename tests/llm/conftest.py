from __future__ import annotations

import pytest

from llm.samples import CLASHING, ODD


@pytest.fixture(scope="session")
def docs_of(spark):
    """A frame of documents from (doc_id, text) rows, with other columns and clashing ones."""

    def make(rows, partitions=3):
        more = ("en", "src", 7, "x", 1, 2, 0.5, 3, 4, "k", 5, 6, "s")
        schema = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
        return spark.createDataFrame([(i, t, *more) for i, t in rows], schema).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def odd(docs_of):
    return docs_of(ODD).cache()


@pytest.fixture(scope="session")
def nothing(docs_of):
    return docs_of([])
