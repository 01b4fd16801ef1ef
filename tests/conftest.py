import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from foliozone.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[4]", "tests", **{"spark.sql.shuffle.partitions": "2", "spark.default.parallelism": "2", "spark.driver.memory": "4g", "spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
