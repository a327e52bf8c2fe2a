"""Small frames for the training-data operators."""

from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """Texts -> a documents table with ids from 0, over several partitions."""

    def make(texts, ids=None, langs=None, **more):
        rows = [(i, t, lang, "src", len(t or "")) for i, t, lang in zip(ids or range(len(texts)), texts, langs or [None] * len(texts))]
        return spark.createDataFrame(rows, DOCS).repartition(3)

    return make


@pytest.fixture
def save(tmp_path):
    """Write frames as the tables of a folder; the folder's path."""

    def put(**tables):
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return put
