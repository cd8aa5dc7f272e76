import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent), str(Path(__file__).resolve().parent.parent.parent)]

from edge_rows import EDGE_ROWS  # noqa: E402

@pytest.fixture(scope="session")
def edge_docs(spark):
    """Documents with awkward values and extra columns whose names the operators use themselves."""
    rows = [(i, t, "en", "s", None, 1, "k", 2, 3) for i, t in EDGE_ROWS]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, n_chars long, version int, key string, bucket int, fingerprint int",
    )


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
