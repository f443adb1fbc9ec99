from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n string, row string, id string, size string, key string"


@pytest.fixture(scope="session")
def docs(spark: SparkSession):
    """Documents with columns whose names the operators use themselves."""

    def make(texts, ids=None, langs=None, sources=None):
        ids = ids if ids is not None else range(len(texts))
        rows = [
            (i, text, langs[k] if langs else "en", sources[k] if sources else f"s{k % 3}", None if text is None else len(text), "x", "y", "z", "w", "v")
            for k, (i, text) in enumerate(zip(ids, texts))
        ]
        return spark.createDataFrame(rows, SCHEMA)

    return make
