import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import pytest
from pyspark.sql import types as T

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A maker of documents tables from texts; extra columns clash with names the operators use."""

    def make(texts, ids=None, sources=None):
        ids = list(range(len(texts))) if ids is None else ids
        sources = ["s0"] * len(texts) if sources is None else sources
        rows = [
            (i, t, "en", s, None if t is None else len(t), 1, "x", 0, b"", [1])
            for i, t, s in zip(ids, texts, sources, strict=True)
        ]
        return spark.createDataFrame(rows, DOCS + ", node long, tie string, start long, ids binary, frame array<long>")

    return make


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], T.StructType.fromDDL(DOCS))
