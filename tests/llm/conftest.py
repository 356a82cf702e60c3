import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from monthlens.llm.shared import ship_package  # noqa: E402

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture
def documents(spark):
    """A table of documents from texts, or from (doc_id, text) pairs."""

    def make(texts):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        rows = [(i, t, "en", f"s{(i or 0) % 2}", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(rows, DOCUMENTS)

    return make
