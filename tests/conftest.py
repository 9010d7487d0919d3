import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from footfall.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("spark")
    session = build_session(
        "footfall-tests",
        master="local[8]",
        shuffle_partitions=8,
        spark__checkpoint__dir=str(scratch / "checkpoints"),
        spark__sql__warehouse__dir=str(scratch / "warehouse"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
