import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from aftermath.session import open_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = open_session(
        "tests", "local[8]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    return session
