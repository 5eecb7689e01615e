import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from helpers import DOCS  # noqa: E402

from wavefold.session import ship_package  # noqa: E402


@pytest.fixture(scope="session")
def make(spark):
    """A DataFrame of documents from rows, over a few partitions."""
    ship_package(spark)

    def build(rows, schema=DOCS, parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts)

    return build
