import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))


@pytest.fixture(scope="session")
def tokenizer():
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture
def docs(spark):
    """Builds a documents table from texts; ids count from 0."""
    def make(texts, **columns):
        rows = [(i, t, "en", "s", len(t) if t is not None else None) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return make

