"""Small documents with every awkward case, as frames."""

from __future__ import annotations

import pytest

from tabspine.llm.queries import workers_find_library

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, id string"


@pytest.fixture(scope="session")
def awkward(spark):
    """Null id, null and empty texts, no letters, repeated rows and ids, a very long text; columns with clashing names."""
    workers_find_library(spark)
    prose = " ".join(f"word{i} of the" for i in range(60))
    rows = [
        (1, prose, "en"), (2, prose, "en"), (3, prose + " end", None), (4, None, "en"), (5, "", "fr"), (6, "12 34 !!", "en"),
        (7, "under the MIT License", "en"), (7, "under the MIT License", "en"), (None, prose, "en"), (8, "ça va là-bas. " * 20_000, "fr"),
        (9, "one", "fr"), (10, "one", None), (11, "  \n\t ", "en"), (12, "der die das und " * 40, "de"),
    ]
    return spark.createDataFrame([(i, t, g, "s", 0, 0.5, "x") for i, t, g in rows], SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    workers_find_library(spark)
    return spark.createDataFrame([], SCHEMA)
