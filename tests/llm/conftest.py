import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from texts or (id, text[, source]) rows, with columns whose names clash."""

    def build(*rows):
        full = []
        for k, row in enumerate(rows):
            row = row if isinstance(row, tuple) else (k, row)
            full.append((row[0], row[1], "en", row[2] if len(row) > 2 else "s", len(row[1] or "")))
        frame = spark.createDataFrame(full, DOCS)
        return frame.selectExpr("*", "'x' as shard", "'x' as n_words", "'x' as score", "'x' as kept")

    return build


@pytest.fixture
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
