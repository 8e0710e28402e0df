import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from sensorloom.session import ROWS_PER_BLOCK, build  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return build("local[4]", 4)


@pytest.fixture
def small_blocks(spark):
    """Force many blocks, so that ordered scans carry values between them."""
    spark.conf.set(ROWS_PER_BLOCK, "7")
    yield
    spark.conf.unset(ROWS_PER_BLOCK)
