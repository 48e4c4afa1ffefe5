import os
import sys

import public_tokenizers
import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(os.path.dirname(HERE)))
sys.path.insert(0, os.path.dirname(HERE))
sys.path.insert(0, HERE)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def vocabulary():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def make(spark):
    """Documents from ``(doc_id, text)`` pairs."""

    def documents(rows):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, SCHEMA)

    return documents
