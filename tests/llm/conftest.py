import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"

PROSE = "the quick brown fox jumps over the lazy dog while seven wizards make toxic brew for the evil queen and jack"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) pairs, with the other columns null."""

    def make(rows, extra=()):
        rows = [(i, t, None, None, None, *(7 for _ in extra)) for i, t in rows]
        ddl = DOC + "".join(f", `{c}` int" for c in extra)
        return spark.createDataFrame(rows, ddl)

    return make


@pytest.fixture(scope="session")
def prose():
    return PROSE
