import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from awkward import EDGES, documents  # noqa: E402


@pytest.fixture(scope="session")
def edges(spark):
    return documents(spark, EDGES)


@pytest.fixture(scope="session")
def nothing(spark):
    return documents(spark, [])
