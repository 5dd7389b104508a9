import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from edge_cases import EDGE_TEXTS, frame  # noqa: E402


@pytest.fixture
def edge(spark):
    return frame(spark, EDGE_TEXTS)


@pytest.fixture
def none(spark):
    return frame(spark, [])
