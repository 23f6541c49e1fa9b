import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from check import session  # noqa: E402
from newsflow.session import prepare  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return prepare(session(8, **{"spark.driver.memory": "8g", "spark.sql.shuffle.partitions": "4"}))
