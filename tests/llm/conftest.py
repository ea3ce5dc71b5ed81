import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from helpers import TRICKY, documents  # noqa: E402


@pytest.fixture(scope="session")
def tricky(spark):
    """Null and empty cells, repeated rows, ties, very long texts, and names that operators use."""
    return documents(
        spark, TRICKY, id=1, folded="f", digest="d", shard=9, slot=9, cell="c", row="r", key="k", size="s",
        place=1, t=2, leaks="l", score="s", component_id=5, fp=6, kept="k", bucket=3, block=4, sid=5, hits="h",
    )


@pytest.fixture(scope="session")
def nothing(tricky):
    return tricky.filter("false")
