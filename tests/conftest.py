import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from estrella.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # small test frames must still spread over several partitions
    conf = {"spark.sql.shuffle.partitions": "4", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    conf["spark.sql.codegen.wholeStage"] = "false"  # compiling costs more than it saves on tiny frames
    session = build_session("tests", "local[4]", **conf)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
