"""Fixtures of the operator tests (imported, since a second conftest would hide the first)."""

import pytest

from cartwheel.llm.common import keyed


@pytest.fixture()
def docs_of(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return make


@pytest.fixture()
def keyed_of(docs_of):
    return lambda rows: keyed(docs_of(rows))
