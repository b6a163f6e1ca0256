import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from fitloom.session import session

    return session(cores=4, partitions=4, **{"spark.driver.memory": "4g"})
