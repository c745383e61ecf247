import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from lodestone.session import local_session

    return local_session(os.environ.get("TEST_CPUS", "8"), **{"spark.sql.shuffle.partitions": "4"})
