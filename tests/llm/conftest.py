import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def tokenizer():
    from postmart.llm.queries import tokenizer
    return tokenizer()


@pytest.fixture(scope="session")
def frame(spark):
    """Small documents with extra columns whose names clash with the operators' own."""
    clash = ("doc", "row", "key", "node", "band", "parts", "words", "seeds", "rank", "length", "spans", "t", "block")

    def make(rows, id="doc_id", text="text"):
        df = spark.createDataFrame(rows, f"{id} long, {text} string")
        return df.selectExpr("*", *(f"'x' AS {c}" for c in clash))
    return make
