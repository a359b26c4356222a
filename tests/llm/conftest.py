from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from util import DOCS, frame, odd_documents  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    return frame(spark, odd_documents()).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
